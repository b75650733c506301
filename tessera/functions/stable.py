"""Deterministic pseudo-randomness as plain column expressions.

``rand()`` changes under task retry and repartitioning, so every random
choice in this package (shuffles, subsampling, negative draws, hash
functions for LSH, bucket sampling) is a pure function of a key and a seed:

    stable_hash(key, seed) = first 52 bits of md5(seed || '|' || key)
    stable_u01(key, seed)  = stable_hash / 2^52          in [0, 1)

The same expression is written in DuckDB as
``cast('0x' || substr(md5(seed || '|' || key), 1, 13) as bigint)``, which makes
all seeded steps checkable against an SQL oracle bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_52 = float(2 ** 52)


def _key(*parts) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    cols = [c.cast("string") for c in cols]
    return cols[0] if len(cols) == 1 else F.concat_ws("|", *cols)


def stable_hash(key, seed: int = 42, *more) -> Column:
    """52-bit non-negative long from md5 of ``seed|key[|more...]``."""
    k = _key(key, *more)
    digest = F.md5(F.concat(F.lit(f"{seed}|"), k))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


def stable_u01(key, seed: int = 42, *more) -> Column:
    """Uniform double in [0, 1), a pure function of (seed, key)."""
    return stable_hash(key, seed, *more).cast("double") / F.lit(TWO_POW_52)


def stable_normal(key, seed: int = 42, *more) -> Column:
    """Standard normal by Box-Muller over two stable uniforms."""
    u1 = stable_u01(key, seed, *(list(more) + [F.lit("bm1")]))
    u2 = stable_u01(key, seed, *(list(more) + [F.lit("bm2")]))
    u1 = F.greatest(u1, F.lit(1e-300))
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * 3.141592653589793) * u2)


def sql_stable_hash(key_sql: str, seed: int = 42) -> str:
    """DuckDB twin of :func:`stable_hash` for a single key expression."""
    return (f"cast('0x' || substr(md5('{seed}|' || cast({key_sql} as varchar)), 1, 13) "
            f"as bigint)")


def sql_stable_u01(key_sql: str, seed: int = 42) -> str:
    return f"({sql_stable_hash(key_sql, seed)} / 4503599627370496.0)"


def sql_stable_u01_parts(parts: list[str], seed: int = 42) -> str:
    """DuckDB twin of ``stable_u01(part0, seed, part1, ...)`` for several key parts."""
    key = " || '|' || ".join(f"cast({p} as varchar)" for p in parts)
    return f"(cast('0x' || substr(md5('{seed}|' || {key}), 1, 13) as bigint) / 4503599627370496.0)"
