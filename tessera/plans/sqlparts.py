"""SQL fragments (DuckDB dialect) shared by the oracle queries."""

from __future__ import annotations

RATINGS = """ratings AS (
  SELECT o.o_custkey AS "user", l.l_partkey AS item, l.l_quantity AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

BEHAVIOUR = """beh AS (
  SELECT user_id AS "user", cast(json_extract_string(props, '$.k') AS bigint) AS item,
         CAST(CASE event_type WHEN 'purchase' THEN 3.0 WHEN 'click' THEN 2.0
                              WHEN 'view' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS relevance,
         epoch_us(ts) AS ts
  FROM events)"""

TRANSACTIONS = """tx AS (
  SELECT DISTINCT cast(l_orderkey AS varchar) AS tid, cast(l_partkey AS varchar) AS item
  FROM lineitem)"""

USER_DAY_TRANSACTIONS = """tx AS (
  SELECT DISTINCT cast(user_id AS varchar) || '|' || cast(cast(ts AS date) AS varchar) AS tid,
         json_extract_string(props, '$.k') AS item
  FROM events)"""

WORDS = r"""words AS (
  SELECT doc_id, lang, w.word AS word, w.pos AS pos
  FROM (SELECT doc_id, lang,
               list_filter(regexp_split_to_array(lower(text), '[^\pL\pN]+'), lambda x: x <> '') AS ws
        FROM documents) d,
       LATERAL (SELECT unnest(ws) AS word, generate_subscripts(ws, 1) AS pos) w)"""


def item_cf(src: str, top: int = 10, lower: int = 2, p: str = "cf") -> str:
    """CTEs from ``src(user, item, rating)`` to ``{p}_top(item1, item2, sim)``."""
    return f"""{p}_r AS (SELECT "user", item, max(rating) AS rating FROM {src} GROUP BY 1, 2),
{p}_act AS (SELECT "user", count(*) AS n_items FROM {p}_r GROUP BY 1
            HAVING count(*) >= {lower}),
{p}_c AS (SELECT r.*, a.n_items FROM {p}_r r JOIN {p}_act a USING ("user")),
{p}_pop AS (SELECT item, count(*) AS n_users FROM {p}_c GROUP BY item),
{p}_p AS (SELECT a.item AS item_lo, b.item AS item_hi,
                 1.0 / (1.0 + abs(a.rating - b.rating)) / ln(1.0 + a.n_items) AS ls
          FROM {p}_c a JOIN {p}_c b ON a."user" = b."user" AND a.item < b.item),
{p}_t AS (SELECT item_lo, item_hi, sum(ls) AS s, count(*) AS n FROM {p}_p GROUP BY 1, 2),
{p}_s AS (SELECT t.item_lo, t.item_hi,
                 t.s / t.n / sqrt(cast(pa.n_users AS double) * pb.n_users) AS sim
          FROM {p}_t t JOIN {p}_pop pa ON pa.item = t.item_lo JOIN {p}_pop pb ON pb.item = t.item_hi),
{p}_b AS (SELECT item_lo AS item1, item_hi AS item2, sim FROM {p}_s
          UNION ALL SELECT item_hi, item_lo, sim FROM {p}_s),
{p}_k AS (SELECT *, rank() OVER (PARTITION BY item1 ORDER BY (sim * 524289::DOUBLE - (sim * 524289::DOUBLE - sim)) DESC) AS rk FROM {p}_b),
{p}_top AS (SELECT item1, item2, sim FROM {p}_k WHERE rk <= {top})"""


def pair_rules(tx: str = "tx", min_count: int = 3, min_conf: float = 0.1, top: int = 10) -> str:
    """CTEs from ``tx(tid, item)`` (distinct) to ``rules_top(antecedent, consequent, lift)``."""
    return f"""rules_n AS (SELECT count(DISTINCT tid) AS n FROM {tx}),
rules_c AS (SELECT item, count(*) AS cnt FROM {tx} GROUP BY item),
rules_p AS (SELECT a.item AS x, b.item AS y, count(*) AS nxy
            FROM {tx} a JOIN {tx} b ON a.tid = b.tid AND a.item < b.item
            GROUP BY 1, 2 HAVING count(*) >= {min_count}),
rules_r AS (SELECT x AS antecedent, y AS consequent, nxy FROM rules_p
            UNION ALL SELECT y, x, nxy FROM rules_p),
rules_s AS (SELECT r.antecedent, r.consequent, cast(r.nxy AS double) / ca.cnt AS confidence,
                   cb.cnt AS n_b
            FROM rules_r r JOIN rules_c ca ON ca.item = r.antecedent
                           JOIN rules_c cb ON cb.item = r.consequent),
rules_l AS (SELECT antecedent, consequent, confidence,
                   confidence / (cast(n_b AS double) / (SELECT n FROM rules_n)) AS lift
            FROM rules_s WHERE confidence >= {min_conf}),
rules_k AS (SELECT *, rank() OVER (PARTITION BY antecedent ORDER BY (lift * 524289::DOUBLE - (lift * 524289::DOUBLE - lift)) DESC) AS rk
            FROM rules_l),
rules_top AS (SELECT antecedent, consequent, lift FROM rules_k WHERE rk <= {top})"""


LISTS = """base AS (
  SELECT l_orderkey AS list_id,
         cast(l_partkey AS varchar) || ':' || cast(l_linenumber AS varchar) || ':'
           || cast(l_suppkey AS varchar) AS item_id,
         floor(l_quantity / 10) - 1 AS raw_label, l_extendedprice AS raw_score, 1.0 + l_linenumber % 3 AS weight
  FROM lineitem),
prep AS (
  SELECT list_id, item_id,
         CASE WHEN raw_label >= 0 THEN raw_label ELSE 0.0 END AS label,
         CASE WHEN raw_label >= 0 THEN raw_score
              ELSE min(raw_score) OVER (PARTITION BY list_id) - 1e-6 END AS score,
         weight, raw_label >= 0 AS valid
  FROM base),
rk AS (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY score DESC, item_id) AS pos
       FROM prep)"""

DIVERSITY = """dbase AS (
  SELECT l_orderkey AS list_id,
         cast(l_partkey AS varchar) || ':' || cast(l_linenumber AS varchar) || ':'
           || cast(l_suppkey AS varchar) AS item_id,
         l_returnflag AS subtopic, CAST(CASE WHEN l_quantity >= 25 THEN 1.0 WHEN l_quantity < 5 THEN -1.0 ELSE 0.0 END AS DOUBLE) AS label,
         l_extendedprice AS score, 1.0 + l_linenumber % 3 AS weight
  FROM lineitem),
ditems_raw AS (
  SELECT list_id, item_id, max(score) AS raw_score, max(weight) AS weight,
         max(CASE WHEN label >= 0 THEN 1 ELSE 0 END) AS v,
         CAST(max(CASE WHEN label >= 1 THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS any_rel
  FROM dbase GROUP BY 1, 2),
ditems AS (
  SELECT list_id, item_id,
         CASE WHEN v = 1 THEN raw_score
              ELSE min(raw_score) OVER (PARTITION BY list_id) - 1e-6 END AS score,
         weight, v = 1 AS valid, any_rel
  FROM ditems_raw),
dcells AS (SELECT list_id, item_id, subtopic, CASE WHEN label >= 0 THEN label ELSE 0.0 END AS label
           FROM dbase),
drk AS (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY score DESC, item_id) AS pos
        FROM ditems)"""


def list_weights(name: str, rel: str, src: str = "prep") -> str:
    """CTEs ``{name}(list_id, weight)``: per-list weight for relevance ``rel``."""
    return f"""{name}_per AS (SELECT list_id, sum(weight * ({rel})) AS wr, sum({rel}) AS r
                 FROM {src} GROUP BY 1),
{name}_pw AS (SELECT list_id, r, CASE WHEN r > 0 THEN wr / r ELSE 0.0 END AS pw FROM {name}_per),
{name}_avg AS (SELECT CASE WHEN sum(CASE WHEN r > 0 THEN 1 ELSE 0 END) > 0
                      THEN sum(pw) / sum(CASE WHEN r > 0 THEN 1 ELSE 0 END) ELSE 0.0 END AS aw
               FROM {name}_pw),
{name} AS (SELECT list_id, CASE WHEN r > 0 THEN pw ELSE (SELECT aw FROM {name}_avg) END AS weight
           FROM {name}_pw)"""
