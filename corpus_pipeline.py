"""From raw documents to training shards.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a DataFrame; ``run`` writes it as Parquet to the shared folder and reads
it again as the next stage's input. All but the last return the columns of
``documents``; the last adds ``shard``.

In every stage an empty table stays empty, a null or empty text is a document like
any other, texts are read whole at any length, and columns that ``documents`` doesn't
have pass through under their names (``shard`` alone is replaced by the last stage).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricelens.llm import decontamination, mixing, sharding, simhash, toxicity
from pricelens.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity chain rejects go. A null or empty text is scored as a text without words; repeated
    rows share a decision; a document at the threshold goes; without labels of both kinds none goes."""
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, chain)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id (null last); ties go by fingerprint,
    then by hash of the text, then of the row. All texts without words share the fingerprint zero."""
    return simhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Null and blank texts hold none; repeated rows share a decision; an empty
    benchmark removes nothing."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. A null source is a source; texts without words have size 0; rows tied
    on the key stand in order of id, size and hash of the text."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents with their shard. A null text counts 16 bytes; of rows that agree in id and text it is fixed how
    many go to a shard, not which."""
    return sharding.exchange(docs)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates),
          ("benchmark_decontamination", drop_benchmark), ("source_mix", mix_sources), ("sharding", shard)]

#: Fitted classifier probabilities and 64-bit xxHash fingerprints aren't expressible in DuckDB SQL;
#: tests/llm/test_pipeline.py holds every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
