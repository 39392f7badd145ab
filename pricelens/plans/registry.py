"""Registry of named queries and their DuckDB oracle SQL."""
from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with optional oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, dp: int = 6) -> DataFrame:
    """Round every double column (the oracle SQL rounds the same columns the same way)."""
    return df.select(*[
        F.round(F.col(f.name), dp).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def sql_round(inner: str, cols: list[str], dp: int = 6) -> str:
    """Wrap a DuckDB query so the listed double columns are rounded like ``rounded``."""
    if not cols:
        return inner
    rep = ", ".join(f"round({c}, {dp}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) _r"
