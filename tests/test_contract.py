"""Driver contract: entry smoke check, and every registered query against its
SQL twin on the smallest test tables (the same compare as the driver)."""
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()
QUERIES = E.queries()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["item1", "item2", "sim"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 80


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(SQL[name])
    cols = [d[0] for d in res.description]
    want = rows_of(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "float": "FLOAT"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_types_match_sql_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert spark_types == duck_types


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() > 0


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_same_rows_under_any_partitioning(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {n: sorted(map(tuple, QUERIES[n](spark, SF).collect()), key=repr)
               for n in ("item_cf", "rank_ndcg", "knn_cosine", "de_noise")}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    if not hasattr(test_same_rows_under_any_partitioning, "ref"):
        test_same_rows_under_any_partitioning.ref = got
    assert got == test_same_rows_under_any_partitioning.ref
