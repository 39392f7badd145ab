"""Portable randomness: the same bits in Spark and in plain SQL (DuckDB).

All randomness in the library derives from ``hash_int(seed, key)`` = the first
eight hex digits of ``md5('<seed>:<key>')`` read as an unsigned integer in
[0, 2^32). It is a pure function of the row key, so folds, splits, samples and
bootstrap weights do not depend on partitioning, executor count or retries.
Each Spark builder has a ``*_sql`` twin that produces the same value in DuckDB.
"""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 4294967296.0

def _poisson_cuts(resolution: float = TWO32) -> list[float]:
    """P(W <= j) = e^-1 * sum_{i<=j} 1/i! for every j that a uniform of this resolution can exceed.

    The largest uniform is 1 - 0.5/resolution, so the list ends at the first cut above it: the weight
    that follows the last cut can't be drawn, and no draw is capped.
    """
    cuts, acc, fact, j = [], 0.0, 1.0, 0
    while not cuts or cuts[-1] <= 1.0 - 0.5 / resolution:
        if j > 0:
            fact *= j
        acc += 1.0 / fact
        cuts.append(math.exp(-1.0) * acc)
        j += 1
    return cuts


POISSON_CUTS = _poisson_cuts()
POISSON_MAX = len(POISSON_CUTS)     # follows from the resolution of hash_int, never reached


def _as_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def hash_int(seed, key) -> Column:
    """Integer in [0, 2^32) from md5('<seed>:<key>'); seed may be a literal or a Column."""
    text = F.concat(_as_col(seed).cast("string"), F.lit(":"), _as_col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_int_sql(seed, key_sql: str) -> str:
    """SQL twin of hash_int. An int seed is a literal; a str seed is a SQL expression."""
    seed_sql = f"'{seed}'" if isinstance(seed, int) else f"CAST({seed} AS VARCHAR)"
    return f"('0x' || substr(md5({seed_sql} || ':' || CAST({key_sql} AS VARCHAR)), 1, 8))::BIGINT"


def unit(seed, key) -> Column:
    """Uniform in [0, 1): hash_int / 2^32."""
    return hash_int(seed, key) / F.lit(TWO32)


def unit_sql(seed, key_sql: str) -> str:
    return f"({hash_int_sql(seed, key_sql)} / {TWO32!r})"


def open_unit(seed, key) -> Column:
    """Uniform in (0, 1): (hash_int + 0.5) / 2^32, safe for log."""
    return (hash_int(seed, key) + F.lit(0.5)) / F.lit(TWO32)


def open_unit_sql(seed, key_sql: str) -> str:
    return f"(({hash_int_sql(seed, key_sql)} + 0.5::DOUBLE) / {TWO32!r})"


def fold(seed, key, k: int) -> Column:
    """Fold id in [0, k)."""
    return (hash_int(seed, key) % F.lit(k)).cast("int")


def fold_sql(seed, key_sql: str, k: int) -> str:
    return f"CAST({hash_int_sql(seed, key_sql)} % {k} AS INTEGER)"


def poisson1(u: Column) -> Column:
    """Poisson(1) draw from a uniform column by inverse CDF."""
    expr = F.lit(POISSON_MAX)
    for j in reversed(range(POISSON_MAX)):
        expr = F.when(u < F.lit(POISSON_CUTS[j]), F.lit(j)).otherwise(expr)
    return expr


def poisson1_sql(u_sql: str) -> str:
    parts = " ".join(f"WHEN {u_sql} < {c!r} THEN {j}" for j, c in enumerate(POISSON_CUTS))
    return f"(CASE {parts} ELSE {POISSON_MAX} END)"
