"""SimHash: fingerprints and components against brute force, the covering guarantee, edge cases."""
from __future__ import annotations

import itertools
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pricelens.llm import simhash as sh

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius=3):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(ids)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= radius:
            parent[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        r = find(i)
        low[r] = min([x for x in (low.get(r), d) if x is not None], default=None)
    return [low[find(i)] for i in range(len(ids))]


def test_covering_masks_catch_every_close_pair():
    masks = sh.covering(list(range(64)))
    assert len(masks) == 15
    for bits in itertools.combinations(range(64), 3):
        x = sum(1 << b for b in bits)
        assert any(x & m == 0 for m in masks)


TEXTS = [None, "", " \t\n", "one", "one two", "One TWO three", "É É é ß x", "a b c d e f", "a b c d e f g", "w " * 400,
         "x" * 3000, "one two", "The same text here " * 30, "The same text here " * 30, "The same text here " * 29 + "other"]


def test_fingerprints_match_brute_force(spark):
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)], SCHEMA)
    got = {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in sh.with_fingerprint(df, ["doc_id"]).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in enumerate(TEXTS)}
    native = df.filter("doc_id = 5").select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert native & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"one two three", 42)


def clustered(n, seed=0):
    rng = np.random.default_rng(seed)
    out = [int(rng.integers(1 << 63))]
    while len(out) < n:
        x = out[int(rng.integers(len(out)))] if rng.random() < 0.8 else int(rng.integers(1 << 63))
        for _ in range(int(rng.integers(1, 6))):
            x ^= 1 << int(rng.integers(64))
        out.append(x)
    return out


@pytest.mark.parametrize("limit", [2048, 4])
def test_components_match_brute_force(spark, limit):
    """limit 4 sends nearly every bucket through the second covering."""
    fps = clustered(220, 1)
    centre = int(np.random.default_rng(5).integers(1 << 63))
    fps += [centre ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(0, 26), 2)]      # one dense ball
    ids = [int(x) for x in np.random.default_rng(2).permutation(len(fps))]
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    rows = spark.createDataFrame(list(zip(ids, signed)), "doc_id long, fp long").repartition(5)
    comps = {r["fp"]: r["component_id"] for r in sh.fingerprint_components(rows, limit=limit).collect()}
    assert [comps[s] for s in signed] == brute_components(ids, fps)


def test_near_duplicates_and_keep_one(spark):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(TEXTS)] + [(None, "quite another text than the others", None, None, None),
                                                                 (3, "one", "en", "s", 0), (12, TEXTS[12], "de", "t", 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit("x"))
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = brute_components([r[0] for r in rows], fps)
    got = sorted(((r["doc_id"], r["component_id"]) for r in sh.near_duplicates(df).collect()), key=repr)
    assert got == sorted(zip([r[0] for r in rows], want), key=repr)
    kept = sh.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted(set(want), key=repr)


def test_the_survivor_does_not_depend_on_partitioning(spark):
    rows = [(4, "one two three four" + " " * i, "en", f"s{j}", 0) for i in range(5) for j in range(2)] + [(None, "one  two three four", "en", "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    kept = [sh.keep_one(df.repartition(n, *by)).collect() for n, by in ((1, ()), (3, ()), (7, ("text",)), (4, ("source",)))]
    assert all(len(k) == 1 and k == kept[0] for k in kept) and kept[0][0]["doc_id"] == 4


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert sh.near_duplicates(df).count() == 0 and sh.keep_one(df).count() == 0
