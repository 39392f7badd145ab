"""Sharding by histogram sort.

Documents are sorted by (hash of the text, hash of the id) and cut into shards
of near-equal bytes. Splitters are found without sorting: a pass counts the
exact bytes below candidate boundaries (probes) of the key range over all
partitions, and only the intervals that still hold a splitter are probed more
finely in the next pass, until each splitter meets its tolerance or no key lies
between two probes. Rows are then exchanged once.

The first ``TEXT_BITS`` bits of the key come from the text: equal texts stay
together in a shard, and a splitter goes into a group of copies only if either
edge of the group is farther than ``GROUP_TOLERANCE`` of a shard from where the cut
should be. Such a group (it may hold a third of all rows) is cut by the hash of
the id, and rows that agree in id and text too (one key) by their number among the
rows of that key: a splitter is a pair (key, number).

The probe counts that reach the driver are bounded by splitters x probes,
whatever the input. Rows of one key are numbered by counts per (key, task that
wrote them) and a row number inside that pair, so no task orders more of them than
a task wrote. ``slot`` numbers a shard's rows in the order of a hash of id, text
and that number by bucketed prefix counts (no window over a whole shard).

Defined cases: a null text has no bytes (size 16) and a null checksum; repeated
rows are cut like any other, with a slot each (which of them goes where is not
fixed, how many go where is); an empty table gives an empty result; fewer rows
than shards leaves shards empty.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import aside, text_key, written
from .mixing import KEY_BITS, hash_key, with_prefix

Cut = tuple[int, int]

SHARDS = 40
OVERHEAD = 16
TOLERANCE = 0.005
GROUP_TOLERANCE = 0.02
TEXT_BITS = 32
ID_BITS = 31
BITS = TEXT_BITS + ID_BITS
FIRST, NEXT = 12, 9
CELL_BYTES = 8 << 20


def doc_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def sort_key(doc_id: Column, text: Column) -> Column:
    """63-bit key, never negative: text hash first, id hash last."""
    t = F.shiftrightunsigned(F.xxhash64(text, F.lit(1)), 64 - TEXT_BITS)
    i = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(2)), 64 - ID_BITS)
    return F.shiftleft(t, ID_BITS).bitwiseOR(i)


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, bits: int = BITS,
              text_bits: int = TEXT_BITS, group_tolerance: float = GROUP_TOLERANCE) -> list[Cut]:
    """Pairs b_1 <= .. <= b_{shards-1} of a key and a row number: shard j holds b_j <= (key, number) < b_{j+1}.
    ``rows``: key, size. The number is 0 but where one key alone holds more than the tolerance on both sides."""
    level = FIRST

    def probe(df, level):
        cell = F.shiftright("key", bits - level).alias("c")
        return sorted((r["c"], r["s"], r["n"]) for r in
                      df.groupBy(cell).agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).collect())

    first = probe(rows, level)
    total = sum(s for _, s, _ in first)
    slack, group_slack = tolerance * total / shards, max(tolerance, group_tolerance) * total / shards
    open_: dict[int, tuple[float, int, int]] = {}   # splitter -> (bytes wanted below it, its cell, bytes below the cell)
    cut: dict[int, Cut] = {}

    def settle(wants, cells, below, level):
        """Cut at the nearer edge of the cell a splitter falls in, inside a key that is too large for that, or keep
        the cell for the next pass."""
        width, cells = bits - level, list(cells)
        for j, want in wants:
            at = below
            for c, s, n in cells:
                if at + s >= want or c == cells[-1][0]:
                    low, high = want - at, at + s - want
                    if min(abs(low), abs(high)) <= (group_slack if level == text_bits else slack):
                        cut[j] = ((c if abs(low) <= abs(high) else c + 1) << width, 0)
                        open_.pop(j, None)
                    elif level >= bits:
                        cut[j] = (c, min(n, max(0, round(low / s * n))))
                        open_.pop(j, None)
                    else:
                        open_[j] = (want, c, at)
                    break
                at += s

    settle([(j, total * j / shards) for j in range(1, shards)] if first else [], first, 0, level)
    while open_:
        old, level = level, min(bits if level >= text_bits else text_bits, level + NEXT)
        cells = sorted({c for _, c, _ in open_.values()})
        inside = rows.filter(F.shiftright("key", bits - old).isin(cells))
        found: dict[int, list] = {}
        for c, s, n in probe(inside, level):
            found.setdefault(c >> (level - old), []).append((c, s, n))
        for c in cells:
            mine = [(j, w) for j, (w, k, _) in open_.items() if k == c]
            below = next(b for _, k, b in open_.values() if k == c)
            settle(mine, found[c], below, level)
    return [cut.get(j, (0, 0)) for j in range(1, shards)]


def shard_of(key: Column, number: Column, cuts: list[Cut]) -> Column:
    """Number of splitters at or below (key, number)."""
    top = (1 << 63) - 1

    def reached(c, m):
        return (key > F.lit(c)) | ((key == F.lit(c)) & (number >= F.lit(m))) if m else key >= F.lit(min(c, top))

    return sum([reached(c, m).cast("int") for c, m in cuts], F.lit(0)).cast("int")


def dealt(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``rows``, written, plus ``nth``: the row's number among the rows with its ``key`` (a long), from 0."""
    rows = written(rows.withColumn("__part", F.spark_partition_id()).withColumn("__pos", F.monotonically_increasing_id()), name)
    per = rows.groupBy(F.col(key).alias("__k"), F.col("__part").alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy("__k").orderBy("__p").rowsBetween(W.unboundedPreceding, -1)    # one row per task that wrote the key
    per = per.withColumn("__from", F.sum("__n").over(before)).filter("__from > 0")
    inside = F.row_number().over(W.partitionBy(key, "__part").orderBy("__pos")) - 1
    joined = (rows.withColumn("__i", inside)
              .join(per, (F.col(key) == F.col("__k")) & (F.col("__part") == F.col("__p")), "left"))
    return (joined.withColumn("nth", F.coalesce("__from", F.lit(0)) + F.col("__i"))
            .drop("__part", "__pos", "__k", "__p", "__n", "__from", "__i"))


def sharded(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: doc_id, dk, size, text_crc32, shard, slot, key."""
    rows = docs.select("doc_id", text_key(F.col("text")).alias("dk"), doc_size(F.col("text")).alias("size"),
                       F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
                       sort_key(F.col("doc_id"), F.col("text")).alias("key"))
    rows = written(dealt(rows, "key", "shard-rows"), "shard-numbered")
    rows = rows.withColumn("shard", shard_of(F.col("key"), F.col("nth"), splitters(rows, shards, tolerance)))
    order = hash_key(F.concat_ws("/", F.col("doc_id").cast("string"), "dk", "nth"), "slot")
    rows = rows.withColumn("one", F.lit(1).cast("long")).withColumn("order", order)
    out = with_prefix(rows, "shard", "order", "one", ["doc_id", "dk", "nth"], KEY_BITS)
    return out.select("doc_id", "dk", "size", "text_crc32", "shard", F.col("before").alias("slot"), "key")


def exchange(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Whole documents plus ``shard`` (a column of that name gives way), exchanged once by shard and cells of about
    ``CELL_BYTES`` (in sorted runs). Only rows of a key that a splitter cuts are written aside and numbered first."""
    docs = docs.drop("shard")
    slim = written(docs.select(doc_size(F.col("text")).alias("size"), sort_key(F.col("doc_id"), F.col("text")).alias("key")), "shard-rows")
    cuts = splitters(slim, shards, tolerance)
    cells = 1 + (slim.agg(F.sum("size")).first()[0] or 0) // (shards * CELL_BYTES)
    keyed = aside(docs).withColumn("__key", sort_key(F.col("doc_id"), F.col("text"))).withColumn("nth", F.lit(0).cast("long"))
    split = sorted({c for c, m in cuts if m})      # at most one key per splitter
    if split:
        own = dealt(keyed.filter(F.col("__key").isin(split)).drop("nth"), "__key", "shard-equal")
        keyed = keyed.filter(~F.col("__key").isin(split)).unionByName(own)
    placed = keyed.withColumn("shard", shard_of(F.col("__key"), F.col("nth"), cuts))
    cell = F.pmod(F.xxhash64("__key", "nth"), F.lit(cells))
    return placed.repartition("shard", cell).sortWithinPartitions("shard", "__key").drop("__key", "nth").toDF(*docs.columns, "shard")
