"""Mixing sources to target weights.

Every document gets a hash-random key from its id; within its source the rows
stand in key order and a distributed prefix sum of word counts gives each row's
interval. A source's exact word budget is ``full`` whole epochs plus a rest;
the rest is cut at its word in the last epoch: ``taken`` = full * size + the part
of the row's interval below the rest. ``copies`` is the number of whole copies
for a writer of whole documents (the row in which the cut falls is kept if at
least half of it is taken).

Prefix sums: the key range is dealt into 2^b buckets (b from the row count, so
that a bucket holds about ``ROWS`` rows at any size), bucket totals are summed
per source, their prefix joins back by (source, bucket) and rows are summed in
key order inside a bucket only. A source with a third of all rows is spread
over its buckets; texts are read once and never shuffled.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating; they
share the corpus size by weight; none exceeds ``MAX_EPOCHS`` times its source's
size, the excess is shared by weight among the others. In order of
size / weight the capped sources are a prefix, so one cumulative sum finds
them.

Defined cases: a null source is a source of its own; null and blank texts have
size 0 and take 0; rows tied on the key (repeated ids) stand in order of id,
size and text hash; an empty table gives an empty result; a source of size 0
has target 0.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import aside, text_key, word_count, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
ROWS = 16384
KEY_BITS = 52


def hash_key(doc_id: Column, salt: str = "mix") -> Column:
    """Hash-random key of ``KEY_BITS`` bits, the same in Spark and DuckDB."""
    text = F.concat(F.lit(f"{salt}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(rows: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, target (double). ``rows``: source, size."""
    s = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    s = s.withColumn("w", weight.cast("decimal(38,0)")).withColumn("size_d", F.col("source_size").cast("decimal(28,0)"))
    every = W.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    before = every.rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    s = (s.withColumn("total", F.sum("size_d").over(whole)).withColumn("w_all", F.sum("w").over(whole))
         .withColumn("c_size", F.coalesce(F.sum("size_d").over(before), F.lit(0)) * max_epochs)
         .withColumn("c_w", F.coalesce(F.sum("w").over(before), F.lit(0))))
    s = s.withColumn("capped", (F.col("total") - F.col("c_size")).cast("double") * F.col("w").cast("double")
                     > (F.col("size_d") * max_epochs).cast("double") * (F.col("w_all") - F.col("c_w")).cast("double"))
    cap = F.when(F.col("capped"), F.col("size_d") * max_epochs)
    s = (s.withColumn("left", F.col("total") - F.coalesce(F.sum(cap).over(whole), F.lit(0)))
         .withColumn("w_left", F.sum(F.when(~F.col("capped"), F.col("w"))).over(whole)))
    target = F.when(F.col("capped"), (F.col("size_d") * max_epochs).cast("double")).otherwise(
        F.col("left").cast("double") * F.col("w").cast("double") / F.col("w_left").cast("double"))
    return s.select("source", "source_size", target.alias("target"))


def with_prefix(rows: DataFrame, group: str, key: str, value: str, ties: list, key_bits: int = KEY_BITS,
                bucket_rows: int = ROWS, extra: DataFrame | None = None) -> DataFrame:
    """``rows`` plus ``before``: the sum of ``value`` over the rows of its group with smaller keys.

    ``extra``: a table with one row per group whose columns travel with the bucket totals.
    """
    bits = max(0, math.ceil(math.log2(max(1, rows.count()) / bucket_rows)))
    rows = rows.withColumn("__b", F.shiftright(F.col(key), key_bits - bits) if bits else F.lit(0).cast("long"))
    totals = rows.groupBy(group, "__b").agg(F.sum(value).alias("__t"))
    ahead = W.partitionBy(group).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.withColumn("__base", F.coalesce(F.sum("__t").over(ahead), F.lit(0))).drop("__t")
    if extra is not None:
        names = [c for c in extra.columns if c != group]
        extra = extra.select(F.col(group).alias("__e"), *names)
        totals = totals.join(extra, F.col(group).eqNullSafe(F.col("__e"))).drop("__e")
    totals = totals.withColumnRenamed(group, "__g").withColumnRenamed("__b", "__k")
    joined = rows.join(totals, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__b") == F.col("__k")))
    inside = W.partitionBy("__g", "__k").orderBy(key, *ties).rowsBetween(W.unboundedPreceding, -1)
    return (joined.withColumn("before", F.col("__base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("__g", "__k", "__b", "__base"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: doc_id, dk (text key), source, size, source_size, target, taken, copies."""
    rows = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), text_key(F.col("text")).alias("dk"))
                   .withColumn("key", hash_key(F.col("doc_id"))), "mix-rows")
    out = with_prefix(rows, "source", "key", "size", ["doc_id", "size", "dk"], extra=source_targets(rows, weights, max_epochs))
    size, total = F.col("size"), F.greatest(F.col("source_size"), F.lit(1))
    budget = F.floor(F.col("target")).cast("long")
    full, rest = F.floor(budget / total).cast("long"), F.pmod(budget, total)
    part = F.greatest(F.lit(0).cast("long"), F.least(size, rest - F.col("before")))
    more = (2 * part >= F.greatest(size, F.lit(1))).cast("long")
    return out.select("doc_id", "dk", "source", "size", "source_size", "target",
                      (full * size + part).alias("taken"), (full + more).alias("copies"))


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``docs`` with each row as often as the mix takes it (rows not taken go)."""
    plan = mix(docs, weights, max_epochs)
    n = W.partitionBy("doc_id", "dk", "source").orderBy("copies", "taken")
    plan = plan.withColumn("n", F.row_number().over(n)).select(
        F.col("doc_id").alias("m_id"), F.col("dk").alias("m_dk"), F.col("source").alias("m_source"), "n", "copies").filter("copies > 0")
    plain = aside(docs)
    keyed = plain.withColumn("__dk", text_key(F.col("text")))
    keyed = keyed.withColumn("__n", F.row_number().over(W.partitionBy("doc_id", "__dk", "source").orderBy("__dk")))
    same = (F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("__dk") == F.col("m_dk")) & F.col("source").eqNullSafe(F.col("m_source"))
            & (F.col("__n") == F.col("n")))
    return (keyed.join(plan, same).withColumn("__c", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*plain.columns).toDF(*docs.columns))
