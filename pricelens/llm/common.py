"""Small helpers shared by the corpus operators.

Words are maximal runs of anything but ASCII white space (``WORD``); Python's
``bytes.split()`` cuts at exactly the same six characters, so native and Arrow
operators agree on what a word is.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


READ = ("doc_id", "text", "source")


def aside(docs: DataFrame) -> DataFrame:
    """``docs`` with every column but ``READ`` named by its place: no working column can clash with an extra one.
    ``toDF(*docs.columns)`` gives the names back."""
    return docs.toDF(*[c if c in READ else f"extra_{i}" for i, c in enumerate(docs.columns)])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: its lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def word_array(text: Column) -> Column:
    """Lower-cased words of ``text``; empty for null or blank texts."""
    body = F.lower(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS)))
    return F.when(F.length(body) > 0, F.split(body, SPACE)).otherwise(F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def id_crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def text_key(text: Column) -> Column:
    """64-bit key that tells apart different texts under a repeated id."""
    return F.xxhash64(text)
