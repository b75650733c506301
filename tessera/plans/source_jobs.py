"""Source queries."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from tessera.functions.scan import written
from tessera.plans import sqlparts as Q
from tessera.plans import standins as S
from tessera.plans.catalog import query
from tessera.session import ensure_checkpoint_dir
from tessera.sources import (NEIGHBOR_SCHEMA, feature_index, load_embeddings, read_ratings, read_samples, read_sequences,
                             save_embeddings, save_table, vectorize_bag, write_neighbors, write_samples)
from tessera.sources.io import feature_key


@query("read_ratings", f"""WITH {Q.RATINGS}
SELECT "user", item, rating FROM ratings""")
def q_read_ratings(spark, sf_dir):
    """A1: ratings projected and cast from the joined order lines."""
    return read_ratings(spark, S.ratings(spark, sf_dir).withColumnRenamed("user", "u"),
                        "u", "item", "rating")


_KEYS_SQL = f"""{Q.WORDS},
bag AS (SELECT doc_id, 'w' || chr(9) || word AS key, CAST(1.0 AS DOUBLE) AS value FROM words
        UNION ALL SELECT doc_id, 'lang' || chr(9) || lang, CAST(1.0 AS DOUBLE) FROM documents),
fidx AS (SELECT key, row_number() OVER (ORDER BY key) - 1 AS idx
         FROM (SELECT DISTINCT key FROM bag))"""


def _index(bags):
    keys = bags.select(F.explode("attributes").alias("f")).select(
        feature_key(F.col("f.name"), F.col("f.term")).alias("key"))
    return feature_index(keys, "key")


@query("feature_index", f"""WITH {_KEYS_SQL}
SELECT key, cast(idx AS bigint) AS idx FROM fidx""")
def q_feature_index(spark, sf_dir):
    """A5: dense 0-based index of distinct feature keys (range-partitioned)."""
    return _index(S.feature_bags(spark, sf_dir))


@query("vectorize_bag", f"""WITH {_KEYS_SQL},
v AS (SELECT b.doc_id, f.idx, sum(b.value) AS value FROM bag b JOIN fidx f USING (key)
      GROUP BY 1, 2)
SELECT doc_id, count(*) AS nnz, string_agg(cast(idx AS varchar), ',' ORDER BY idx) AS indices,
       round(sum(value), 6) AS total, round(sum(idx * value), 6) AS weighted
FROM v GROUP BY doc_id""")
def q_vectorize_bag(spark, sf_dir):
    """Feature bags -> sparse vectors (indices ascending, repeats summed)."""
    bags = written(S.feature_bags(spark, sf_dir))  # for the index and for the vectors: words are split once
    v = vectorize_bag(bags, "doc_id", "attributes", _index(bags))
    return v.select(
        F.col("id").alias("doc_id"), F.size("indices").cast("bigint").alias("nnz"),
        F.array_join(F.transform("indices", lambda x: x.cast("string")), ",").alias("indices"),
        F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
        F.round(F.aggregate(F.arrays_zip("indices", "values"), F.lit(0.0),
                            lambda a, z: a + z["indices"] * z["values"]), 6).alias("weighted"))


def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid4().hex}"


def _lines(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


@query("write_neighbors", """SELECT l_orderkey AS "itemId", l_partkey AS "candidateId", l_extendedprice AS distance FROM lineitem""")
def q_write_neighbors(spark, sf_dir):
    """Neighbours written as 5 files and read back."""
    path = _folder(spark, "neighbors")
    write_neighbors(_lines(spark, sf_dir).select(F.col("l_orderkey").alias("itemId"), F.col("l_partkey").alias("candidateId"),
                                                 F.col("l_extendedprice").alias("distance")), path, n_files=5)
    return spark.read.schema(NEIGHBOR_SCHEMA).parquet(path)


@query("save_table", """SELECT l_orderkey AS "itemId", l_partkey AS "candidateId", l_extendedprice AS distance FROM lineitem""")
def q_save_table(spark, sf_dir):
    """A table saved twice (the second time over the first) under a scratch name and folder, and read by its name."""
    name, path = f"tessera_saved_{uuid4().hex}", _folder(spark, "table")
    rows = _lines(spark, sf_dir).select(F.col("l_orderkey").alias("itemId"), F.col("l_partkey").alias("candidateId"),
                                        F.col("l_extendedprice").alias("distance"))
    save_table(rows.limit(0), name, path)
    save_table(rows, name, path)
    return spark.table(name)


@query("write_read_samples", """SELECT l_orderkey AS "itemId", l_partkey AS "candidateId", cast(l_quantity AS double) AS distance FROM lineitem""")
def q_samples(spark, sf_dir):
    """Samples written under a schema (cast to it) and read back."""
    path = _folder(spark, "samples")
    write_samples(_lines(spark, sf_dir).select(F.col("l_orderkey").alias("itemId"), F.col("l_partkey").alias("candidateId"),
                                               F.col("l_quantity").alias("distance")), NEIGHBOR_SCHEMA, path)
    return read_samples(spark, path, NEIGHBOR_SCHEMA)


@query("save_load_embeddings", """SELECT cast(vec_id AS varchar) AS word, unnest(range(0, len(embedding))) AS at,
  round(cast(unnest(embedding) AS double), 6) AS value FROM embeddings""")
def q_embeddings(spark, sf_dir):
    """A10: the embedding table saved, loaded and checked against its metadata, by component."""
    path = _folder(spark, "embeddings")
    save_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("word", F.col("vec_id").cast("string")), path,
                    "word", "embedding")
    return load_embeddings(spark, path).select("word", F.posexplode("vector").alias("at", "value")).select(
        "word", F.col("at").cast("long"), F.round("value", 6).alias("value"))


@query("read_sequences", """SELECT doc_id, unnest(range(0, len(x))) AS at, unnest(x) AS item FROM (
  SELECT doc_id, list_filter(string_split(text, ','), lambda x: x <> '') AS x FROM documents)""")
def q_read_sequences(spark, sf_dir):
    """A3: texts split at commas, order kept, empty items dropped."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("item_ids"))
    return read_sequences(df).select("doc_id", F.posexplode("item_ids").alias("at", "item")).select(
        "doc_id", F.col("at").cast("long"), "item")
