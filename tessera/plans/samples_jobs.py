"""Sample and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.stable import sql_stable_hash, sql_stable_u01
from tessera.operators import samples as I
from tessera.plans import standins as S
from tessera.plans.catalog import query

AGE_SQL = " + ".join(f"CASE WHEN age >= {b} THEN 1 ELSE 0 END" for b in I.AGE_BOUNDARIES)


def _event_samples(spark, sf_dir):
    """(sample_id, user, ts, item, label, age, gender) -- one sample per event."""
    ev = S.table(spark, sf_dir, "events")
    cu = S.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (ev.join(cu, ev.user_id == cu.c_custkey, "left")
            .select(F.col("event_id").alias("sample_id"), F.col("user_id").alias("user"), "ts",
                    S.event_item().cast("string").alias("item"),
                    (F.col("event_type") == "purchase").cast("long").alias("label"),
                    F.col("c_nationkey").alias("age"), F.col("c_mktsegment").alias("gender")))


def _click_log(spark, sf_dir):
    ev = S.table(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    return ev.select(F.col("user_id").alias("user"), "ts", S.event_item().alias("item"))


_SAMPLES_SQL = """smp AS (
  SELECT e.event_id AS sample_id, e.user_id AS "user", e.ts,
         json_extract_string(e.props, '$.k') AS item,
         CASE WHEN e.event_type = 'purchase' THEN 1 ELSE 0 END AS label,
         c.c_nationkey AS age, c.c_mktsegment AS gender
  FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey),
clk AS (SELECT user_id AS "user", ts, json_extract_string(props, '$.k') AS item
        FROM events WHERE event_type = 'click'),
hist AS (SELECT s.sample_id,
                string_agg(k.item, ',' ORDER BY epoch(k.ts)::bigint, k.item) AS history, count(*) AS n_hist,
                count(*) FILTER (WHERE k.item <> '0') AS n_nz
         FROM smp s JOIN clk k ON k."user" = s."user"
              AND epoch(k.ts)::bigint >= epoch(s.ts)::bigint - 15 * 86400
              AND epoch(k.ts)::bigint < epoch(s.ts)::bigint
         GROUP BY 1)"""


@query("click_history", f"""WITH {_SAMPLES_SQL}
SELECT s.sample_id, coalesce(h.history, '') AS history, coalesce(h.n_hist, 0) AS n_hist
FROM smp s LEFT JOIN hist h USING (sample_id)""")
def q_click_history(spark, sf_dir):
    """Clicked items of the 15 days before every event (day-bucketed range join)."""
    h = I.click_history(_event_samples(spark, sf_dir), _click_log(spark, sf_dir), 15,
                        "sample_id", "user", "ts", "item")
    return h.select("sample_id", F.array_join("history", ",").alias("history"),
                    F.size("history").cast("bigint").alias("n_hist"))


@query("pointwise_samples", f"""WITH {_SAMPLES_SQL}
SELECT cast(s.label AS bigint) AS label, cast(s."user" AS varchar) AS user_id,
       cast(s.age AS int) AS age, s.gender, s.item AS item_id,
       {sql_stable_hash('cast(s."user" AS varchar)')} % 10 AS user_bucket,
       {sql_stable_hash('s.item')} % 10 AS item_bucket,
       cast({AGE_SQL.replace('age', 's.age')} AS bigint) AS age_bucket,
       coalesce(h.n_hist, 0) AS n_hist
FROM smp s LEFT JOIN hist h USING (sample_id)""")
def q_pointwise(spark, sf_dir):
    """I2 + I4 + I5: point-wise samples under the fixed schema with hashed and
    bucketized features (history from I3)."""
    smp = _event_samples(spark, sf_dir)
    h = I.click_history(smp, _click_log(spark, sf_dir), 15, "sample_id", "user", "ts", "item")
    x = smp.join(h, "sample_id").withColumnRenamed("history", "clicked_items_15d") \
        .withColumn("user_id", F.col("user").cast("string")).withColumn("item_id", F.col("item"))
    p = I.pointwise_samples(x)
    return p.select("label", "user_id", "age", "gender", "item_id",
                    I.hash_bucket("user_id", 10).alias("user_bucket"),
                    I.hash_bucket("item_id", 10).alias("item_bucket"),
                    I.bucketize("age").alias("age_bucket"),
                    F.size("clicked_items_15d").cast("bigint").alias("n_hist"))


def _page_rows(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    o = S.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = S.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (li.join(o, li.l_orderkey == o.o_orderkey).join(cu, F.col("o_custkey") == cu.c_custkey, "left")
            .select(F.col("l_orderkey").alias("pv_id"), F.col("o_custkey").cast("string").alias("user_id"),
                    F.col("c_nationkey").cast("long").alias("age"), F.col("c_mktsegment").alias("gender"),
                    F.col("l_partkey").cast("string").alias("item_id"),
                    F.array().cast("array<string>").alias("clicked_items_15d"),
                    F.floor(F.col("l_quantity") / 10).cast("long").alias("relevance"),
                    F.struct(F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
                             F.col("l_extendedprice")).alias("position")))


_PAGES_SQL = """pv AS (
  SELECT l.l_orderkey AS pv_id, cast(o.o_custkey AS varchar) AS user_id, cast(c.c_nationkey AS bigint) AS age,
         c.c_mktsegment AS gender, cast(l.l_partkey AS varchar) AS item_id,
         cast(floor(l.l_quantity / 10) AS bigint) AS relevance, l.l_linenumber, l.l_partkey, l.l_suppkey,
         l.l_extendedprice
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
lw AS (
  SELECT pv_id, arg_min(user_id, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS user_id,
         arg_min(age, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS age,
         arg_min(gender, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS gender,
         string_agg(cast(relevance AS varchar), ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS relevance,
         string_agg(item_id, ',' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS item_id,
         count(*) AS n_items
  FROM pv GROUP BY pv_id HAVING max(CASE WHEN relevance <> 0 THEN 1 ELSE 0 END) = 1)"""


@query("listwise_samples", f"""WITH {_PAGES_SQL}
SELECT pv_id, user_id, age, gender, relevance, item_id, n_items FROM lw""")
def q_listwise(spark, sf_dir):
    """List-wise samples per order (page view), groups without relevance dropped."""
    lw = I.listwise_samples(_page_rows(spark, sf_dir), "pv_id", "position")
    return lw.select("pv_id", "user_id", "age", "gender",
                     F.array_join(F.transform("relevance", lambda x: x.cast("string")), ",").alias("relevance"),
                     F.array_join("item_id", ",").alias("item_id"),
                     F.size("item_id").cast("bigint").alias("n_items"))


@query("padded_batches", f"""WITH {_PAGES_SQL},
b AS (SELECT pv_id, n_items, floor((row_number() OVER (ORDER BY pv_id) - 1) / 4) AS batch_id FROM lw),
m AS (SELECT batch_id, max(n_items) AS mx FROM b GROUP BY 1)
SELECT pv_id, cast(batch_id AS bigint) AS batch_id, mx AS padded_len, mx - n_items AS n_pads,
       cast((mx - n_items) * -4294967296 AS bigint) AS pad_sum
FROM b JOIN m USING (batch_id)""")
def q_padded(spark, sf_dir):
    """I10 (+I1, I14): list-wise samples in batches of 4, arrays padded to the batch maximum."""
    lw = I.listwise_samples(_page_rows(spark, sf_dir), "pv_id", "position")
    lw = lw.withColumn("n_items", F.size("item_id"))
    b = I.padded_batches(lw, 4, ["pv_id"], {"relevance": I.RELEVANCE_PAD, "item_id": I.STRING_PAD},
                         {"clicked_items_15d": I.STRING_PAD})
    return b.select("pv_id", F.col("batch_id").cast("bigint"),
                    F.size("item_id").cast("bigint").alias("padded_len"),
                    (F.size("item_id") - F.col("n_items")).cast("bigint").alias("n_pads"),
                    F.aggregate(F.filter("relevance", lambda x: x == I.RELEVANCE_PAD), F.lit(0).cast("bigint"),
                                lambda a, x: a + x).alias("pad_sum"))


@query("expand_request", f"""WITH {_PAGES_SQL}
SELECT l.pv_id, l.l_linenumber, l.item_id
FROM (SELECT pv_id, item_id, l_linenumber, l_partkey, l_suppkey FROM pv) l
JOIN lw USING (pv_id)""")
def q_expand(spark, sf_dir):
    """List-wise rows expanded back to one row per candidate item."""
    lw = I.listwise_samples(_page_rows(spark, sf_dir).withColumn("ln", F.col("position.l_linenumber")),
                            "pv_id", "position", item_fields=("item_id", "ln"))
    lw = lw.withColumn("cand", F.arrays_zip("item_id", "ln")).drop("item_id", "ln")
    e = I.expand_request(lw, "cand", "c")
    return e.select("pv_id", F.col("c.ln").alias("l_linenumber"), F.col("c.item_id").alias("item_id"))


_SIZED = ("l_partkey", "l_suppkey", "l_returnflag", "l_orderkey")


@query("embedding_sizes", """WITH c AS (
""" + "\nUNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS cardinality FROM lineitem""" for c in _SIZED) + """)
SELECT "column", cardinality, cast(pow(2.0, ceil(log2(pow(cardinality, 0.25)))) AS bigint) AS embedding_size FROM c""")
def q_embedding_sizes(spark, sf_dir):
    """Cardinalities and embedding sizes of categorical columns."""
    return I.embedding_sizes(S.table(spark, sf_dir, "lineitem"), list(_SIZED))


_EMB_SQL = """ue AS (
  SELECT e.user_id, cast(json_extract_string(e.props, '$.k') AS bigint) AS item FROM events e),
ve AS (SELECT vec_id, list_sum(list_transform(embedding, lambda x: cast(x AS double))) AS vsum,
              len(embedding) AS dim FROM embeddings)"""


@query("pool_embedding", f"""WITH {_EMB_SQL}
SELECT ue.user_id, round(avg(vsum) + any_value(f.fsum), 6) AS pooled_sum, count(*) AS n_items
FROM ue JOIN ve ON ve.vec_id = ue.item
     JOIN (SELECT u.user_id, ve.vsum AS fsum FROM (SELECT user_id, min(item) AS fi FROM ue GROUP BY 1) u
           JOIN ve ON ve.vec_id = u.fi) f ON f.user_id = ue.user_id
GROUP BY ue.user_id""")
def q_pool(spark, sf_dir):
    """Per user, the mean embedding of the event items (shared item table),
    concatenated with the looked-up embedding of the user's lowest item id."""
    ev = S.table(spark, sf_dir, "events").select("user_id", S.event_item().alias("item"))
    emb = S.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"),
                                                      F.col("embedding").cast("array<double>").alias("vector"))
    known = ev.join(emb.select(F.col("id").alias("item")), "item").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_items"))
    first = ev.groupBy("user_id").agg(F.min("item").alias("first_item"))
    # the user's event items in long form: no per-user list is built
    p = I.pool_embedding_long(ev, "user_id", "item", emb)
    p = I.lookup_embedding(p.join(first, "user_id"), "first_item", emb, out="first_emb")
    p = I.assemble_features(p, ["pooled", "first_emb"], "features")
    return (p.join(known, "user_id")
            .select("user_id", F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6)
                    .alias("pooled_sum"), F.col("n_items").cast("bigint")))


@query("hash_list_feature", f"""WITH {_EMB_SQL},
l AS (SELECT l_orderkey, {sql_stable_hash('l_suppkey')} % 64 AS bucket FROM lineitem)
SELECT l_orderkey, round(avg(vsum), 6) AS pooled_sum, cast(sum(bucket) AS bigint) AS buckets
FROM l JOIN ve ON ve.vec_id = l.bucket GROUP BY 1""")
def q_hash_list(spark, sf_dir):
    """I4 on a list feature into I8: the suppliers of an order, each hashed to a bucket of a shared embedding table."""
    lists = S.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("items"))  # at most 7 lines
    emb = S.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    p = I.pool_embedding(lists.withColumn("buckets", I.hash_buckets("items", 64)), "l_orderkey", "buckets", emb, 1)
    return p.select("l_orderkey", F.round(F.aggregate("pooled", F.lit(0.0), lambda a, x: a + x), 6).alias("pooled_sum"), F.aggregate("buckets", F.lit(0).cast("long"), lambda a, x: a + x).alias("buckets"))


@query("shuffle_orders", f"""
SELECT o_orderkey, cast(row_number() OVER (ORDER BY {sql_stable_u01('o_orderkey')}, o_orderkey) - 1 AS bigint)
       AS position FROM orders""")
def q_shuffle(spark, sf_dir):
    """Deterministic seeded shuffle of orders with global positions."""
    from tessera.functions.indexing import global_index
    o = S.table(spark, sf_dir, "orders").select("o_orderkey")
    s = I.shuffle(o, "o_orderkey", 42)
    return global_index(s, ["shuffle_key", "o_orderkey"], "position").select("o_orderkey", "position")


@query("repeat_shard", f"""
SELECT o_orderkey, cast(e AS int) AS epoch FROM orders CROSS JOIN range(1, 4) t(e)
WHERE {sql_stable_hash('o_orderkey')} % 5 = 2""")
def q_repeat_shard(spark, sf_dir):
    """I12 + I13: shard 2 of 5 of the orders, repeated for 3 epochs."""
    o = S.table(spark, sf_dir, "orders").select("o_orderkey")
    return I.repeat(I.shard(o, "o_orderkey", 5, 2), 3).select("o_orderkey", F.col("epoch").cast("int"))


@query("dense_mask", f"""WITH {_SAMPLES_SQL}
SELECT s.sample_id, coalesce(h.n_hist, 1) AS n_slots,
       coalesce(h.n_nz, 0) AS n_true
FROM smp s LEFT JOIN hist h USING (sample_id)""")
def q_dense_mask(spark, sf_dir):
    """Empty histories -> ['0'] with mask false."""
    h = I.click_history(_event_samples(spark, sf_dir), _click_log(spark, sf_dir), 15,
                        "sample_id", "user", "ts", "item")
    d = I.dense_mask(h, "history")
    return d.select("sample_id", F.size("history").cast("bigint").alias("n_slots"),
                    F.size(F.filter("history_mask", lambda m: m)).cast("bigint").alias("n_true"))
