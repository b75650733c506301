"""Sources and sinks (A1-A10).

Readers accept a table name or a DataFrame and project / cast into the
package's normal forms; Catalyst pushes the projections into the scan.
Writers overwrite and take the output file count as a parameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.indexing import global_index

__all__ = [
    "read_ratings", "read_transactions", "read_sequences", "read_behaviour", "read_i2i",
    "feature_index", "vectorize_bag", "write_neighbors", "save_table", "write_samples",
    "read_samples", "save_embeddings", "load_embeddings", "NEIGHBOR_SCHEMA",
]


def _df(spark: SparkSession | None, src) -> DataFrame:
    if isinstance(src, DataFrame):
        return src
    if spark is None:
        raise ValueError("a session is needed to read a table by name")
    return spark.table(src)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` over all cores, by ``keys``, when its input has fewer splits than there are cores; otherwise as it is.

    For work that is heavy per row: a file of one row group is one task, whatever its rows cost.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def read_ratings(spark, src, user: str = "user", item: str = "item",
                 rating: str = "rating") -> DataFrame:
    """A1: (user, item, rating double) from any table."""
    return _df(spark, src).select(F.col(user).alias("user"), F.col(item).alias("item"),
                                  F.col(rating).cast("double").alias("rating"))


def read_transactions(df: DataFrame, items: str = "items", sep: str = r"\s+") -> DataFrame:
    """A2: whitespace-separated string -> array of distinct non-empty items."""
    arr = F.array_distinct(F.filter(F.split(F.col(items), sep), lambda x: x != F.lit("")))
    return df.withColumn("items", arr)


def read_sequences(df: DataFrame, item_ids: str = "item_ids", sep: str = ",") -> DataFrame:
    """A3: comma-separated string -> array<string> (order kept, empty tokens dropped)."""
    return df.withColumn(item_ids, F.filter(F.split(F.col(item_ids), sep),
                                            lambda x: x != F.lit("")))


def read_behaviour(spark, src, user: str = "user", item: str = "item",
                   relevance: str = "relevance", timestamp: str = "timestamp") -> DataFrame:
    """A4: (user, item, relevance double, timestamp long seconds)."""
    df = _df(spark, src)
    ts = F.col(timestamp)
    if isinstance(df.schema[timestamp].dataType, (T.TimestampType, T.TimestampNTZType)):
        ts = F.unix_micros(ts.cast("timestamp"))
    return df.select(F.col(user).alias("user"), F.col(item).alias("item"),
                     F.col(relevance).cast("double").alias("relevance"),
                     ts.cast("long").alias("timestamp"))


def read_i2i(spark, src, item1: str = "item1", item2: str = "item2",
             score: str = "score") -> DataFrame:
    """A4: item-to-item table (item1, item2, score double)."""
    return _df(spark, src).select(F.col(item1).alias("item1"), F.col(item2).alias("item2"),
                                  F.col(score).cast("double").alias("score"))


def feature_key(name, term):
    """Feature key = name TAB term."""
    return F.concat_ws("\t", name, term)


def feature_index(df: DataFrame, key: str = "key") -> DataFrame:
    """A5: (key, idx) -- distinct keys with a dense 0-based index in key order."""
    keys = df.select(F.col(key).alias("key")).where(F.col("key").isNotNull()).distinct()
    return global_index(keys, ["key"], "idx")


def vectorize_bag(df: DataFrame, id_col: str, bag: str, index_df: DataFrame) -> DataFrame:
    """Bag of (name, term, value) -> (id, indices, values, n_features).

    Features missing from the index are dropped; repeated features are
    summed; indices ascend.  Rows whose bag has no known feature keep an
    empty vector.
    """
    n_features = index_df.agg(F.count(F.lit(1)).alias("n_features"))
    e = df.select(F.col(id_col).alias("id"), F.explode_outer(bag).alias("f"))
    e = e.select("id", feature_key(F.col("f.name"), F.col("f.term")).alias("key"),
                 F.col("f.value").cast("double").alias("value"))
    # the index's part of a partition is hashed: features need no sort by key
    j = e.join(index_df.select("key", "idx").hint("shuffle_hash"), "key", "left")
    # one exchange by id serves the sums of repeats and the vectors
    per = j.select("id", "idx", "value").repartition("id").groupBy("id", "idx").agg(F.sum("value").alias("value"))
    vec = per.groupBy("id").agg(
        F.sort_array(F.collect_list(F.when(F.col("idx").isNotNull(),
                                           F.struct("idx", "value")))).alias("kv"))
    return vec.crossJoin(F.broadcast(n_features)).select(
        F.col("id"), F.col("kv.idx").alias("indices"), F.col("kv.value").alias("values"),
        "n_features")


NEIGHBOR_SCHEMA = T.StructType([
    T.StructField("itemId", T.LongType(), False),
    T.StructField("candidateId", T.LongType(), False),
    T.StructField("distance", T.DoubleType(), False),
])


def write_neighbors(df: DataFrame, path: str, n_files: int = 100, fmt: str = "parquet") -> None:
    """Write (itemId, candidateId, distance), overwrite, ``n_files`` files."""
    out = df.select(F.col("itemId").cast("long"), F.col("candidateId").cast("long"),
                    F.col("distance").cast("double"))
    for c in out.columns:  # a null fails the job instead of losing its row
        out = out.withColumn(c, F.coalesce(F.col(c), F.raise_error(F.lit(f"{c} is null")).cast(out.schema[c].dataType)))
    out.repartition(n_files).write.mode("overwrite").format(fmt).save(path)


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Overwrite a managed table, or with ``path`` an external one whose files are there."""
    w = df.write.mode("overwrite")
    (w.option("path", path) if path else w).saveAsTable(name)


def write_samples(df: DataFrame, schema: T.StructType, path: str,
                  n_files: int | None = None) -> None:
    """Write samples under an explicit schema (checked, then cast)."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"sample columns missing: {missing}")
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    if n_files:
        out = out.repartition(n_files)
    out.write.mode("overwrite").parquet(path)


def read_samples(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 on_corrupt: str = "fail") -> DataFrame:
    """Read samples back; a corrupt file is an error unless ``on_corrupt='drop'`` asks to skip it."""
    r = spark.read.option("ignoreCorruptFiles", str(on_corrupt == "drop").lower())
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def save_embeddings(df: DataFrame, path: str, word: str = "word", vector: str = "vector",
                    bytes_per_file: int = 128 << 20) -> None:
    """A10: embedding table + one-row metadata (count, dim).

    The file count follows the approximate size ``count * dim * 8`` bytes.
    """
    meta = df.agg(F.count(F.lit(1)).alias("n_words"),
                  F.max(F.size(vector)).alias("dim"),
                  F.min(F.size(vector)).alias("min_dim")).first()
    if meta["n_words"] and meta["dim"] != meta["min_dim"]:
        raise ValueError("vectors of different sizes")
    approx = (meta["n_words"] or 0) * (meta["dim"] or 0) * 8
    n_files = max(1, approx // bytes_per_file + 1)
    (df.select(F.col(word).alias("word"), F.col(vector).cast("array<double>").alias("vector"))
     .repartition(int(n_files)).write.mode("overwrite").parquet(f"{path}/data"))
    spark = df.sparkSession
    (spark.createDataFrame([(int(meta["n_words"] or 0), int(meta["dim"] or 0))],
                           "n_words long, dim int")
     .coalesce(1).write.mode("overwrite").json(f"{path}/metadata"))


def load_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """A10: load and verify count and vector size against the metadata."""
    meta = spark.read.schema("n_words long, dim int").json(f"{path}/metadata").first()
    df = spark.read.parquet(f"{path}/data")
    got = df.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("vector")).alias("lo"),
                 F.max(F.size("vector")).alias("hi")).first()
    if got["n"] != meta["n_words"] or (got["n"] and (got["lo"] != meta["dim"] or got["hi"] != meta["dim"])):
        raise ValueError(f"embedding table does not match its metadata: {got} vs {meta}")
    return df
