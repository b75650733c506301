"""Stand-in inputs built from the driver's test tables.

These functions only select, rename and cast columns so that a table has the
schema an operator expects (see FIXTURES.md); they do none of an operator's
work.  Every operator is correct on any data of that schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.io import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, item, rating) = (o_custkey, l_partkey, l_quantity), one row per line."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"),
                    F.col("l_quantity").cast("double").alias("rating")))


RATINGS_SQL = """
ratings AS (
  SELECT o.o_custkey AS "user", l.l_partkey AS item, l.l_quantity AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tid, items string): the part keys of each order, space separated.

    Repeated parts inside an order are kept, as raw baskets would have them.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return (li.groupBy(F.col("l_orderkey").alias("tid"))
            .agg(F.concat_ws(" ", F.collect_list(F.col("l_partkey").cast("string"))).alias("items")))


def brand_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tid, items array<string>): the brands of each order's parts."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (li.join(part, li.l_partkey == part.p_partkey).groupBy(F.col("l_orderkey").alias("tid"))
            .agg(F.collect_list("p_brand").alias("items")))


def event_item():
    return F.get_json_object(F.col("props"), "$.k").cast("long")


def event_relevance():
    """purchase 3, click 2, view 1, anything else 0."""
    return (F.when(F.col("event_type") == "purchase", 3.0)
            .when(F.col("event_type") == "click", 2.0)
            .when(F.col("event_type") == "view", 1.0).otherwise(0.0))


def behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, item, relevance, timestamp) from events, through the A4 reader
    (relevance cast to double, timestamp to a long)."""
    from tessera.sources import read_behaviour
    ev = table(spark, sf_dir, "events").select(
        "user_id", event_item().alias("item"), event_relevance().alias("rel"), "ts")
    return read_behaviour(spark, ev, "user_id", "item", "rel", "ts")


def user_day_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tid, items string): event items of one user on one day."""
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.col("user_id"), F.to_date(F.col("ts").cast("timestamp")).alias("day"))
            .agg(F.concat_ws(" ", F.collect_list(event_item().cast("string"))).alias("items"))
            .select(F.concat_ws("|", F.col("user_id").cast("string"),
                                F.col("day").cast("string")).alias("tid"), "items"))


WORD_SPLIT = r"[^\p{L}\p{N}]+"


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, words array<string>): lower-cased word tokens of the whole text."""
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id")
    words = F.filter(F.split(F.lower(F.col("text")), WORD_SPLIT), lambda w: w != F.lit(""))
    return d.select("doc_id", "lang", words.alias("words"))


def feature_bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, attributes array<struct<name, term, value>>): one entry per token
    (name 'w') plus the language (name 'lang')."""
    dw = document_words(spark, sf_dir)
    bag = F.concat(
        F.transform("words", lambda w: F.struct(F.lit("w").alias("name"), w.alias("term"),
                                                F.lit(1.0).alias("value"))),
        F.array(F.struct(F.lit("lang").alias("name"), F.col("lang").alias("term"),
                         F.lit(1.0).alias("value"))))
    return dw.select(F.col("doc_id"), bag.alias("attributes"))


def ranking_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(list_id, item_id, label, score, weight, subtopic): one row per line item.

    list = order, label = floor(quantity / 10) - 1 (so small quantities are invalid
    items), weight = 1 + linenumber % 3, score = extended price, item id = (partkey,
    linenumber, suppkey) as one string; an order may hold an item twice.
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("list_id"),
        F.concat_ws(":", F.col("l_partkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_suppkey").cast("string")).alias("item_id"),
        (F.floor(F.col("l_quantity") / 10) - 1).cast("double").alias("label"),
        F.col("l_extendedprice").cast("double").alias("score"),
        (F.lit(1.0) + F.col("l_linenumber") % 3).alias("weight"),
        F.col("l_returnflag").alias("subtopic"),
        F.col("l_quantity").alias("quantity"))


def event_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_ids): a user's event items in time order, comma separated."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", event_item().alias("item"))
    seq = ev.groupBy("user_id").agg(
        F.sort_array(F.collect_list(F.struct("ts", "event_id", F.col("item").cast("string").alias("i"))))
        .alias("s"))
    return seq.select("user_id", F.array_join(F.col("s.i"), ",").alias("item_ids"))
