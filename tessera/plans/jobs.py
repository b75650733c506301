"""Job entry points with the shape of the reference's batch jobs.

Each job reads named tables (or DataFrames), runs the operators of this
package and returns the result DataFrame; when an output table or path is
given the result is also written (overwrite).  They are thin compositions
of ``sources`` + ``operators`` + sinks, so a user of the original jobs can
switch call for call.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import sources as IO
from tessera.operators import cf, embed, lsh, retrieval, rules
from tessera.session import ship_package


def item_cf_job(spark: SparkSession, table, user_col: str = "user", item_col: str = "item",
                rating_col: str = "rating", top_n: int = 10, lower: int = 2, upper: int | None = None,
                output_table: str | None = None) -> DataFrame:
    """Item-to-item CF: ratings table -> (item1, item2, sim), top ``top_n`` per item."""
    r = IO.read_ratings(spark, table, user_col, item_col, rating_col)
    out = cf.item_cf(r, top=top_n, lower=lower, upper=upper)
    if output_table:
        IO.save_table(out, output_table)
    return out


def fp_growth_job(spark: SparkSession, table, items_col: str = "items", min_support_count: int = 3,
                  min_confidence: float = 0.1, top_n: int = 10, partitions: int | None = None,
                  output_table: str | None = None) -> DataFrame:
    """Association rules: whitespace-separated baskets -> (antecedent, consequent, lift)."""
    df = table if isinstance(table, DataFrame) else spark.table(table)
    t = IO.read_transactions(df.select(items_col), items_col).select(F.col("items"))
    # the same rules as by FP-growth, without its itemsets of other sizes and its frequent items on the driver
    out = rules.pair_rules(t.repartition(partitions) if partitions else t, "items", min_support_count, min_confidence, top_n)
    if output_table:
        IO.save_table(out, output_table)
    return out


def recall_metrics_job(spark: SparkSession, ground_truth_table, i2i_table, ks: Sequence[int] = (1, 2, 4, 8),
                       user_col: str = "user", item_col: str = "item", relevance_col: str = "relevance",
                       timestamp_col: str = "timestamp", item1_col: str = "item1", item2_col: str = "item2",
                       score_col: str = "score") -> DataFrame:
    """Recall-stage metrics of an item-to-item table: (k, precision, recall, f1, mrr, ndcg, n_pairs)."""
    beh = IO.read_behaviour(spark, ground_truth_table, user_col, item_col, relevance_col, timestamp_col)
    i2i = IO.read_i2i(spark, i2i_table, item1_col, item2_col, score_col)
    return retrieval.retrieval_metrics(beh, i2i, ks)


def embedding_job(spark: SparkSession, table, user_col: str = "user_id", items_col: str = "item_ids",
                  vector_size: int = 100, window: int = 5, min_count: int = 5, max_iter: int = 10,
                  negative: int = 5, sample: float = 1e-3, num_partitions: int = 200, top_n: int = 100,
                  use_lsh: bool = False, num_hashes: int = 200, bucket_limit: int = 1000, seed: int = 42,
                  output_table: str | None = None):
    """Item embeddings from comma-separated sequences, then item-to-item top ``top_n``.

    Returns ``(vectors, i2i)``; ``use_lsh`` picks the LSH join instead of the
    exact blocked join.
    """
    ship_package(spark)
    df = table if isinstance(table, DataFrame) else spark.table(table)
    seq = IO.read_sequences(df.select(user_col, items_col), items_col, ",")
    model = embed.fit_embeddings(seq, items_col, user_col, vector_size=vector_size, window=window,
                                 min_count=min_count, max_iter=max_iter, negative=negative, hs=0,
                                 sample=sample, num_partitions=num_partitions, seed=seed)
    vectors = model.embedding_table()
    i2i = (embed.i2i_lsh(vectors, top_n, num_hashes, None, bucket_limit, seed) if use_lsh
           else embed.i2i_exact(vectors, top_n))
    if output_table:
        IO.save_table(i2i, output_table)
    return vectors, i2i


def nearest_neighbor_job(spark: SparkSession, src, pool=None, algorithm: str = "signRP", k: int = 100,
                         id_col: str = "id", bag_col: str | None = None, feature_index=None,
                         vec_col: str = "vector", metric: str | None = None, num_hashes: int = 256,
                         signature_length: int = 16, bucket_width: float = 1.0, bucket_limit: int = 1000,
                         seed: int | None = None, output_path: str | None = None,
                         n_files: int = 100) -> DataFrame:
    """k-NN join of item vectors (or feature bags turned into sparse index sets
    with a feature index): ``(itemId, candidateId, distance)``."""
    ship_package(spark)

    def load(x):
        d = x if isinstance(x, DataFrame) else spark.table(x)
        if bag_col is None:
            return d.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vector"))
        if feature_index is None:
            raise ValueError("a feature index is needed for feature bags")
        v = IO.vectorize_bag(d, id_col, bag_col, feature_index)
        return v.select("id", F.col("indices").alias("vector"))

    s = load(src)
    p = s if pool is None else load(pool)
    nn = lsh.nearest_neighbors(s, p, k, algorithm, "id", "vector", metric, num_hashes, signature_length,
                               bucket_width, bucket_limit, seed)
    out = nn.select(F.col("src").alias("itemId"), F.col("cand").alias("candidateId"), "distance")
    if output_path:
        IO.write_neighbors(out, output_path, n_files)
    return out
