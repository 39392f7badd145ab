"""Mixing and sharding against brute force, and their edge cases."""
from __future__ import annotations

import collections
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pricelens.llm import mixing as mx
from pricelens.llm import sharding as sd
from pricelens.llm.common import table

SF_SMALL = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in rows], SCHEMA).withColumn("size", F.lit("clash")).withColumn("shard", F.lit(-1))


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def brute_targets(sizes):
    """sizes: source -> words. Shares by weight, the excess over three times a source's size shared again until none is above."""
    order = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left, w = total - sum(3 * sizes[s] for s in capped), sum(weight[s] for s in free)
        share = {s: left * weight[s] / w for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {**share, **{s: 3.0 * sizes[s] for s in capped}}
        capped |= over


def check_mix(rows, out):
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += words(t)
    targets, taken = brute_targets(sizes), collections.Counter()
    assert len(out) == len(rows)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]], rel=1e-12, abs=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, t in targets.items():
        assert taken[s] == int(t + 1e-9)          # the budget is met to the word


ROWS = [(i, " ".join(["w"] * (i % 37)), f"s{i % 7 if i % 3 else 0}") for i in range(600)] + [
    (600, None, "s1"), (601, "", None), (602, "a b c d", None), (None, "x y", "s2"), (5, "w w w w w", "s5"), (5, "w w w w w", "s5"),
    (700, "only one", "tiny"), (701, "z " * 5000, "é"), (702, " \t\n", "blank")]


def test_mix_matches_brute_force(spark):
    out = mx.mix(make(spark, ROWS)).collect()
    check_mix(ROWS, out)
    again = mx.mix(make(spark, ROWS).repartition(11)).collect()
    key = lambda r: (repr(r["doc_id"]), r["size"], repr(r["source"]), r["taken"])
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_prefix_sums_do_not_depend_on_buckets(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").alias("g"), mx.hash_key(F.col("id")).alias("key"),
                                  (F.col("id") % 11).alias("v"))
    a = {r["doc_id"]: r["before"] for r in mx.with_prefix(df, "g", "key", "v", ["doc_id"], bucket_rows=16).collect()}
    b = {r["doc_id"]: r["before"] for r in mx.with_prefix(df, "g", "key", "v", ["doc_id"]).collect()}
    assert a == b and len(a) == 3000


def test_mixed_documents(spark):
    df = make(spark, ROWS)
    plan = collections.Counter()
    for r in mx.mix(df).collect():
        plan[(r["doc_id"], r["dk"], r["source"])] += r["copies"]
    mixed = mx.mixed_documents(df)
    assert mixed.columns == df.columns
    got = collections.Counter((r["doc_id"], r["dk"], r["source"]) for r in mixed.withColumn("dk", F.xxhash64("text")).collect())
    assert got == collections.Counter({k: n for k, n in plan.items() if n})


def test_mix_of_nothing(spark):
    assert mx.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mx.mixed_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    assert [r["taken"] for r in mx.mix(make(spark, [(1, None, "a"), (2, "", "b")])).collect()] == [0, 0]


# ---------------------------------------------------------------------------- sharding
def check_shards(rows, out, shards, slack):
    total = sum(len((t or "").encode()) + 16 for _, t, _ in rows)
    size, slots, by_key = collections.Counter(), collections.defaultdict(list), sorted(out, key=lambda r: r["key"])
    for r in out:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(out) == len(rows) and sum(size.values()) == total
    assert [r["shard"] for r in by_key] == sorted(r["shard"] for r in by_key)          # shards follow the key order
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(abs(size[j] - total / shards) <= slack for j in range(shards)), size


def test_shards_of_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r["doc_id"], r["text"], None) for r in docs.collect()]
    biggest = max(len(t.encode()) for _, t, _ in rows)
    out = sd.sharded(docs, 8).collect()
    check_shards(rows, out, 8, 2 * biggest + 16)
    text = dict((d, t) for d, t, _ in rows)
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) for r in out)


def test_hot_group_is_cut_and_small_groups_stay(spark):
    rows = [(i, "the very same text" * 5, "s") for i in range(400)]
    rows += [(2000 + i, f"twin {i // 2} " * 12, "s") for i in range(800)] + [(None, None, None), (7, "", "s"), (7, "", "s"), (8, "x" * 900, "s")]
    out = sd.sharded(make(spark, rows), 10).collect()
    check_shards(rows, out, 10, 1200)
    place = collections.defaultdict(set)
    for r in out:
        place[r["dk"]].add(r["shard"])
    hot = max(place.values(), key=len)
    assert len(hot) >= 3 and all(len(s) == 1 for s in place.values() if s is not hot)


def test_a_third_of_all_rows_equal(spark):
    rows = [(5, "a row that comes again and again " * 6, "s")] * 1000 + [(i, f"text {i} " * 20, "s") for i in range(2000)]
    fair, largest = sum(len(t) + 16 for _, t, _ in rows) / 40, max(len(t) + 16 for _, t, _ in rows)
    seen = []
    for parts in (3, 11):
        out = sd.sharded(make(spark, rows).repartition(parts)).collect()
        check_shards(rows, out, 40, 0.02 * fair + 2 * largest)
        seen.append(sorted((r["doc_id"], r["dk"], r["shard"], r["slot"]) for r in out))
    assert seen[0] == seen[1]                      # which rows go where, up to rows equal in id and text
    whole = sd.exchange(make(spark, rows).repartition(5))
    assert sorted((r["doc_id"], r["shard"]) for r in whole.select("doc_id", "shard").collect()) == sorted((d, s) for d, _, s, _ in seen[0])


def test_numbers_of_equal_keys(spark):
    df = spark.range(700).select((F.col("id") % 3 * F.lit(7)).alias("k"), "id").repartition(6)
    got = collections.defaultdict(list)
    for r in sd.dealt(df, "k", "test-dealt").collect():
        got[r["k"]].append(r["nth"])
    assert {k: sorted(v) for k, v in got.items()} == {0: list(range(234)), 7: list(range(233)), 14: list(range(233))}


def test_exchange_keeps_rows_and_agrees(spark):
    docs = table(spark, SF_SMALL, "documents")
    whole = sd.exchange(docs, 6)
    assert whole.columns == [*docs.columns, "shard"]
    a = {r["doc_id"]: r["shard"] for r in whole.select("doc_id", "shard").collect()}
    assert a == {r["doc_id"]: r["shard"] for r in sd.sharded(docs, 6).collect()}


def test_few_or_no_rows(spark):
    assert sd.sharded(spark.createDataFrame([], SCHEMA)).count() == 0
    assert sd.exchange(spark.createDataFrame([], SCHEMA)).count() == 0
    few = sd.sharded(make(spark, [(1, "a", "s"), (2, None, "s"), (3, "b", "s")])).collect()
    assert len(few) == 3 and {r["size"] for r in few} == {16, 17} and all(0 <= r["shard"] < 40 for r in few)
    assert [r["text_crc32"] for r in few if r["doc_id"] == 2] == [None]
