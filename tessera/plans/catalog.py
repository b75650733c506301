"""Registry of named queries: a Spark builder and (optionally) its SQL twin.

Each registered query reads whole test tables through ``standins`` (which
only select and rename columns into the schema an operator expects) and runs
the operator from ``tessera.operators`` on them.  The SQL twin, when present,
is an independent DuckDB formulation of the same semantics used as the
correctness oracle; queries without a SQL twin are checked by unit tests
against brute force on small fixtures.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    sql: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the job modules fills REGISTRY
    from tessera.plans import (cf_jobs, retrieval_jobs, rules_jobs,  # noqa: F401
                               source_jobs, ranking_jobs, lists_jobs, samples_jobs,
                               evaluate_jobs, knn_jobs, embed_jobs)
    return REGISTRY
