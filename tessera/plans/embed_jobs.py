"""Embedding queries (D1-D13) over document words and event item sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.scan import written
from tessera.functions.stable import sql_stable_u01_parts
from tessera.operators import corpus as C
from tessera.operators import embed as E
from tessera.operators import sgns
from tessera.plans import sqlparts as Q
from tessera.plans import standins as S
from tessera.plans.catalog import query
from tessera.sources import read_sequences


def _docs(spark, sf_dir):
    return S.document_words(spark, sf_dir).select(F.col("doc_id").alias("sid"), F.col("words").alias("tokens"))


def _seqs_long(spark, sf_dir):
    """Event items in long form: (sid = user, ts, event_id, word = item)."""
    ev = S.table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("sid"), "ts", "event_id",
                     S.event_item().cast("string").alias("word"))


ORDER = ["ts", "event_id"]


def _seqs(spark, sf_dir):
    s = read_sequences(S.event_sequences(spark, sf_dir), "item_ids", ",")
    return s.select(F.col("user_id").alias("sid"), F.col("item_ids").alias("tokens"))


_DOC_VOCAB = f"""{Q.WORDS},
dvi AS (SELECT word, cn, row_number() OVER (ORDER BY cn DESC, word) - 1 AS idx
        FROM (SELECT word, count(*) AS cn FROM words GROUP BY word HAVING count(*) >= 5)),
enc AS (SELECT w.doc_id AS sid, v.idx, v.cn,
               row_number() OVER (PARTITION BY w.doc_id ORDER BY w.pos) AS pos
        FROM words w JOIN dvi v USING (word))"""

_SEQ = """seqw AS (
  SELECT user_id AS sid, json_extract_string(props, '$.k') AS word,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS opos FROM events),
ev_vocab AS (SELECT word, cn, row_number() OVER (ORDER BY cn DESC, word) - 1 AS idx
             FROM (SELECT word, count(*) AS cn FROM seqw GROUP BY word HAVING count(*) >= 5)),
enc AS (SELECT s.sid, v.idx, row_number() OVER (PARTITION BY s.sid ORDER BY s.opos) AS pos
        FROM seqw s JOIN ev_vocab v USING (word)),
enc2 AS (SELECT sid, cast(floor((pos - 1) / 1000) AS bigint) AS chunk, pos, idx FROM enc)"""

_PAIRS = f"""cen AS (SELECT sid, chunk, pos, idx AS centre,
                5 - cast(floor({sql_stable_u01_parts(['sid', 'pos', "'w'"])} * 5) AS bigint) AS radius
         FROM enc2),
offs AS (SELECT c.*, o AS off FROM cen c CROSS JOIN range(-5, 6) t(o) WHERE o <> 0 AND abs(o) <= radius),
pr AS (SELECT offs.sid, offs.pos, offs.centre, e.idx AS context
       FROM offs JOIN enc2 e ON e.sid = offs.sid AND e.chunk = offs.chunk AND e.pos = offs.pos + offs.off)"""


@query("build_vocab", f"""WITH {_DOC_VOCAB}
SELECT word, cn, cast(idx AS bigint) AS idx FROM dvi""")
def q_vocab(spark, sf_dir):
    """Document vocabulary, min count 5, index by count desc then word."""
    return C.build_vocab(_docs(spark, sf_dir), "tokens", 5).select("word", "cn", "idx")


@query("encode_sentences", f"""WITH {_DOC_VOCAB}
SELECT sid AS doc_id, cast(floor((pos - 1) / 1000) AS bigint) AS chunk, count(*) AS n,
       cast(sum(idx) AS bigint) AS idx_sum, max(pos) AS max_pos FROM enc GROUP BY 1, 2""")
def q_encode(spark, sf_dir):
    """Documents encoded to vocabulary ids, chunks of 1000 words."""
    d = written(_docs(spark, sf_dir))  # read three times: words are split once
    e = C.encode_sentences(d, C.build_vocab(d, "tokens", 5), "tokens", "sid", 1000)
    return e.groupBy(F.col("sid").alias("doc_id"), "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.sum("idx").alias("idx_sum"), F.max("pos").cast("bigint").alias("max_pos"))


@query("subsample", f"""WITH {_DOC_VOCAB},
tot AS (SELECT sum(cn) AS total FROM dvi),
x AS (SELECT e.*, cast(e.cn AS double) / (cast(0.001 AS double) * tot.total) AS xx FROM enc e, tot),
k AS (SELECT * FROM x WHERE (sqrt(xx) + 1) / xx >= {sql_stable_u01_parts(['sid', 'pos'])})
SELECT sid AS doc_id, count(*) AS n_kept, cast(sum(idx) AS bigint) AS idx_sum FROM k GROUP BY 1""")
def q_subsample(spark, sf_dir):
    """D3: frequent-word subsampling at 1e-3 (published keep probability)."""
    d = written(_docs(spark, sf_dir))
    v = C.build_vocab(d, "tokens", 5)
    s = C.subsample(C.encode_sentences(d, v, "tokens", "sid", 1000), v, 1e-3, max_len=1000)
    return s.groupBy(F.col("sid").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_kept"),
                                                        F.sum("idx").alias("idx_sum"))


def _pairs(spark, sf_dir):
    s = _seqs_long(spark, sf_dir)
    v = C.vocab_from_words(s, "word", 5)
    return C.context_pairs(C.encode_long(s, v, "sid", ORDER, "word", 1000), 5), v


@query("context_pairs", f"""WITH {_SEQ}, {_PAIRS}
SELECT centre, context, count(*) AS n FROM pr GROUP BY 1, 2""")
def q_pairs(spark, sf_dir):
    """Dynamic-window skip-gram pairs over users' event sequences."""
    p, _ = _pairs(spark, sf_dir)
    return p.groupBy("centre", "context").agg(F.count(F.lit(1)).alias("n"))


_NOISE = """nz AS (SELECT idx, w / sum(w) OVER () AS prob,
              sum(w) OVER (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(w) OVER () AS cum
       FROM (SELECT idx, pow(cast(cn AS double), 0.75) AS w FROM ev_vocab))"""


@query("noise_distribution", f"""WITH {_SEQ}, {_NOISE}
SELECT cast(idx AS bigint) AS idx, round(prob, 6) AS prob, round(cum, 6) AS cum FROM nz""")
def q_noise(spark, sf_dir):
    """unigram^0.75 noise distribution of the event vocabulary."""
    v = C.vocab_from_words(_seqs_long(spark, sf_dir), "word", 5)
    n = C.noise_distribution(v)
    return n.select("idx", F.round("prob", 6).alias("prob"), F.round("cum", 6).alias("cum"))


@query("negative_samples", f"""WITH {_SEQ}, {_PAIRS}, {_NOISE},
dr AS (SELECT pr.*, {sql_stable_u01_parts(['sid', 'pos', 'context', 'd'])} AS u
       FROM pr CROSS JOIN range(0, 5) t(d)),
ng AS (SELECT dr.centre, coalesce((SELECT min(idx) FROM nz WHERE nz.cum > dr.u),
                                  (SELECT max(idx) FROM nz)) AS negative FROM dr)
SELECT cast(negative AS bigint) AS negative, count(*) AS n FROM ng WHERE negative <> centre GROUP BY 1""")
def q_negatives(spark, sf_dir):
    """5 negative draws per pair (draws equal to the centre skipped)."""
    p, v = _pairs(spark, sf_dir)
    ns = C.negative_samples(p, C.noise_distribution(v), 5)
    return ns.groupBy("negative").agg(F.count(F.lit(1)).alias("n"))


@query("fit_embeddings_sgns")
def q_fit_sgns(spark, sf_dir):
    """Skip-gram with 5 negatives, subsampling, 3 iterations, dim 16 on
    event sequences; rows-only (quality is tested in the unit tests)."""
    m = E.fit_embeddings(_seqs_long(spark, sf_dir), "word", "sid", vector_size=16, window=5, min_count=5,
                         max_iter=3, negative=5, hs=0, sample=1e-3, num_partitions=4, seed=7, order=ORDER)
    return m.embedding_table().select("word", F.round(F.sqrt(F.aggregate(
        "vector", F.lit(0.0), lambda a, x: a + x * x)), 6).alias("norm"))


_RATE, _PER_WORD, _DIM = 0.5, 20.0, 4


def _sgns_step(i: int) -> str:
    """SQL: scores of step ``i`` and both sides' vectors after it, one row a dimension."""
    def side(name, own, by):
        other = "o" if name == "i" else "i"
        return f"""g{name}{i} AS (SELECT s.{own} AS idx, v.d, sum(s.g * v.x) / greatest(1.0, sum(s.n) / {_PER_WORD}) AS u
       FROM s{i} s JOIN {other}{i - 1} v ON v.idx = s.{by} GROUP BY 1, 2),
{name}{i} AS MATERIALIZED (SELECT v.idx, v.d, v.x + coalesce(g.u, 0.0) AS x FROM {name}{i - 1} v LEFT JOIN g{name}{i} g ON g.idx = v.idx AND g.d = v.d)"""
    return f"""s{i} AS MATERIALIZED (SELECT e.centre, e.target, e.n, {_RATE}::DOUBLE * e.n * (e.label - 1.0 / (1.0 + exp(-sum(a.x * b.x)))) AS g
       FROM ex e JOIN i{i - 1} a ON a.idx = e.centre JOIN o{i - 1} b ON b.idx = e.target AND b.d = a.d
       GROUP BY e.centre, e.target, e.n, e.label),
{side('i', 'centre', 'target')},
{side('o', 'target', 'centre')}"""


@query("fit_embeddings_partitioned", f"""WITH {_SEQ}, {_PAIRS}, {_NOISE},
dr AS (SELECT pr.*, {sql_stable_u01_parts(['sid', 'pos', 'context', 'd'])} AS u FROM pr CROSS JOIN range(0, 5) t(d)),
ng AS (SELECT dr.centre, coalesce((SELECT min(idx) FROM nz WHERE nz.cum > dr.u), (SELECT max(idx) FROM nz)) AS negative FROM dr),
ex AS MATERIALIZED (SELECT centre, context AS target, 1 AS label, count(*) AS n FROM pr GROUP BY 1, 2
       UNION ALL SELECT centre, negative, 0, count(*) FROM ng WHERE negative <> centre GROUP BY 1, 2),
dd AS (SELECT idx, d FROM ev_vocab CROSS JOIN range(0, {_DIM}) t(d)),
i0 AS MATERIALIZED (SELECT idx, d, ({sql_stable_u01_parts(['idx', 'd'])} - 0.5) / {_DIM} AS x FROM dd),
o0 AS MATERIALIZED (SELECT idx, d, 0.0::DOUBLE AS x FROM dd),
{_sgns_step(1)},
{_sgns_step(2)},
{_sgns_step(3)}
SELECT w.word, cast(d AS int) AS d, round(x, 6) AS x FROM i3 JOIN ev_vocab w USING (idx)""")
def q_fit_partitioned(spark, sf_dir):
    """Three synchronous steps of skip-gram with 5 negatives on a partitioned model, every number exact."""
    p, v = _pairs(spark, sf_dir)
    ex = sgns.training_examples(p, C.noise_distribution(v), 5)
    m = sgns.fit_partitioned(ex, v, _DIM, 3, _RATE, _PER_WORD)
    return m.embedding_table().select("word", F.posexplode("vector").alias("d", "x")).select("word", "d", F.round("x", 6).alias("x"))


@query("fit_embeddings_cbow_hs")
def q_fit_cbow(spark, sf_dir):
    """CBOW with hierarchical softmax (own kernel), 2 iterations; rows-only."""
    m = E.fit_embeddings(_seqs_long(spark, sf_dir), "word", "sid", vector_size=16, window=3, min_count=5,
                         max_iter=2, negative=0, hs=1, cbow=1, num_partitions=4, seed=7, order=ORDER)
    return m.embedding_table().select("word", F.size("vector").alias("dim"))


@query("fit_embeddings_spark_ml")
def q_fit_ml(spark, sf_dir):
    """A3 + D6 default configuration (skip-gram, hierarchical softmax) via Spark ML,
    which takes sentences as arrays (the comma-separated sequence reader)."""
    m = E.fit_embeddings(_seqs(spark, sf_dir), "tokens", vector_size=16, window=5, min_count=5,
                         max_iter=1, num_partitions=4, seed=7)
    return m.embedding_table().select("word", F.size("vector").alias("dim"))


_EMB = """ve AS (SELECT vec_id, cast(vec_id AS varchar) AS word, label,
              list_transform(embedding, lambda x: cast(x AS double)) AS v FROM embeddings),
vn AS (SELECT *, list_sum(v) AS vsum, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS nrm FROM ve)"""


def _emb(spark, sf_dir):
    return S.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id"), F.col("vec_id").cast("string").alias("word"), "label",
        F.col("embedding").cast("array<double>").alias("vector"))


@query("average_parameters", f"""WITH {_EMB}
SELECT label, count(*) AS n, round(avg(vsum), 6) AS mean_sum FROM vn GROUP BY label""")
def q_average(spark, sf_dir):
    """Mean vector per group (embeddings averaged per label)."""
    e = _emb(spark, sf_dir)
    rows = e.select(F.col("label").alias("matrix"), F.lit(0).cast("long").alias("idx"), F.col("vector").alias("vec"))
    avg = E.average_parameters(rows)
    cnt = e.groupBy(F.col("label").alias("matrix")).agg(F.count(F.lit(1)).alias("n"))
    return avg.join(cnt, "matrix").select(
        F.col("matrix").alias("label"), "n",
        F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x), 6).alias("mean_sum"))


@query("embed_sentences", f"""WITH {_SEQ}, {_EMB}
SELECT s.sid AS user_id, round(sum(coalesce(vn.vsum, 0.0)) / count(*), 6) AS emb_sum
FROM seqw s LEFT JOIN vn USING (word) GROUP BY s.sid""")
def q_embed_sentences(spark, sf_dir):
    """A user's sequence vector = summed item vectors / sequence length."""
    out = E.embed_sentences_long(_seqs_long(spark, sf_dir), "sid", "word", _emb(spark, sf_dir), 64)
    return out.select(F.col("sid").alias("user_id"),
                      F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 6).alias("emb_sum"))


@query("find_synonyms", f"""WITH {_EMB},
q AS (SELECT v AS qv, nrm AS qn, word AS qw FROM vn ORDER BY vec_id LIMIT 1),
s AS (SELECT word, CASE WHEN nrm * qn > 0 THEN list_dot_product(v, qv) / (nrm * qn) ELSE 0.0 END AS sim
      FROM vn, q WHERE word <> qw)
SELECT word, round(sim, 6) AS similarity FROM s ORDER BY (sim * 524289::DOUBLE - (sim * 524289::DOUBLE - sim)) DESC, word LIMIT 10""")
def q_synonyms(spark, sf_dir):
    """10 synonyms of the lowest-id item by signed cosine (itself excluded)."""
    e = _emb(spark, sf_dir)
    w = e.orderBy("vec_id").select("word").first()[0]
    r = E.find_synonyms(e, w, 10)
    return r.select("word", F.round("similarity", 6).alias("similarity"))


@query("find_synonyms_vec", f"""WITH {_EMB},
q AS (SELECT v AS qv, nrm AS qn FROM vn ORDER BY vec_id LIMIT 1),
s AS (SELECT word, CASE WHEN nrm * qn > 0 THEN list_dot_product(v, qv) / (nrm * qn) ELSE 0.0 END AS sim
      FROM vn, q)
SELECT word, round(sim, 6) AS similarity FROM s ORDER BY (sim * 524289::DOUBLE - (sim * 524289::DOUBLE - sim)) DESC, word LIMIT 10""")
def q_synonyms_vec(spark, sf_dir):
    """10 items nearest to a given vector (the lowest-id item's), itself included."""
    e = _emb(spark, sf_dir)
    v = e.orderBy("vec_id").select("vector").first()[0]
    r = E.find_synonyms_vec(e, v, 10)
    return r.select("word", F.round("similarity", 6).alias("similarity"))


@query("i2i_exact", f"""WITH {_EMB},
p AS (SELECT a.word AS item1, b.word AS item2, 1 - abs(list_dot_product(a.v, b.v)) / (a.nrm * b.nrm) AS d
      FROM vn a JOIN vn b ON a.vec_id <> b.vec_id WHERE a.nrm > 0 AND b.nrm > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY item1 ORDER BY (d * 524289::DOUBLE - (d * 524289::DOUBLE - d)), cast(item2 AS bigint)) AS rk FROM p)
SELECT item1, item2, round(1 - d, 6) AS sim FROM r WHERE rk <= 10""")
def q_i2i_exact(spark, sf_dir):
    """Exact item-to-item top 10 by |cosine| from the embedding table."""
    e = _emb(spark, sf_dir).select(F.col("vec_id").alias("word"), "vector")
    r = E.i2i_exact(e, 10, block_size=128)
    return r.select(F.col("item1").cast("string").alias("item1"), F.col("item2").cast("string").alias("item2"),
                    F.round("sim", 6).alias("sim"))


def _i2i_lsh_sql():
    from tessera.plans.knn_jobs import _lsh_band_sql
    sig = "(SELECT cast(greatest(1, floor(ln(count(*)))) AS bigint) FROM embeddings)"
    return f"""WITH {_EMB},
nv AS (SELECT word AS id, v, nrm FROM vn),
{_lsh_band_sql("signrp", 64, 200, sig, 5)},
cand AS (SELECT DISTINCT a.id AS src, b.id AS cand FROM bk a JOIN bk b
         ON a.band = b.band AND a.key = b.key AND a.id <> b.id),
p AS (SELECT c.src, c.cand, 1 - abs(list_dot_product(a.v, b.v)) / (a.nrm * b.nrm) AS d
      FROM cand c JOIN nv a ON a.id = c.src JOIN nv b ON b.id = c.cand),
r AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY (d * 524289::DOUBLE - (d * 524289::DOUBLE - d)), cand) AS rk FROM p)
SELECT src AS item1, cand AS item2, round(1 - d, 6) AS sim FROM r WHERE rk <= 10"""


@query("i2i_lsh", _i2i_lsh_sql())
def q_i2i_lsh(spark, sf_dir):
    """LSH item-to-item top 10 (200 sign-projection hashes, signature
    length floor(ln n)); the SQL twin rebuilds the same buckets."""
    e = _emb(spark, sf_dir).select(F.col("word"), "vector")
    r = E.i2i_lsh(e, 10, num_hashes=200, bucket_limit=512, seed=5)
    return r.select("item1", "item2", F.round("sim", 6).alias("sim"))
