"""Decontamination and exact top-k against brute force, and their edge cases."""
from __future__ import annotations

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import decontamination as dc
from pricelens.llm import topk as tk

DOCS = "doc_id long, text string, source string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def shingles(text, k=5):
    w = words(text)
    return {" ".join(w[i:i + k]) for i in range(len(w) - k + 1)}


def own_length(item):
    return min(5, max(1, len(words(item))))


def brute(docs, items):
    out = {}
    for d, t in docs:
        have = {k: shingles(t, k) for k in range(1, 6)}
        for i, x in items:
            need = shingles(x, own_length(x))
            n = len(need & have[own_length(x)])
            if need and n / len(need) >= 0.8:
                out[(d, i)] = max(out.get((d, i), (0, 0, 0)), (n / len(need), n, len(need)))
    return out


def random_text(rng, n):
    return " ".join(f"w{int(x)}" for x in rng.integers(0, 5000, n))


def corpus(seed=0):
    rng = np.random.default_rng(seed)
    items = [(i, random_text(rng, int(rng.integers(3, 60)))) for i in range(40)] + [(40, "Short one"), (41, None), (42, " "), (None, random_text(rng, 20)),
                                                                                   (7, random_text(rng, 25))]
    docs = []
    for d in range(150):
        body = random_text(rng, int(rng.integers(5, 900))).split()
        if d % 3 == 0:
            w = (items[int(rng.integers(40))][1]).split()
            for _ in range(int(rng.integers(0, 4))):          # changes push some pairs just below the threshold
                w[int(rng.integers(len(w)))] = "changed"
            at = int(rng.integers(len(body)))
            body[at:at] = w
        docs.append((d, ("\n" if d % 2 else "  ").join(body)))
    docs += [(200, items[3][1].upper()), (201, None), (202, ""), (203, "short ONE"), (204, "short one more"), (5, items[8][1]), (5, "other"),
             (None, f"x {items[43][1]} y"), (206, items[9][1]), (206, items[9][1]), (207, random_text(rng, 30000) + " " + items[4][1])]
    return docs, items


def test_containment_matches_brute_force(spark):
    docs, items = corpus()
    d = spark.createDataFrame([(i, t, "s") for i, t in docs], DOCS).withColumn("item_id", F.lit("clash")).repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1.5))
    got = {(r["doc_id"], r["item_id"]): (r["containment"], r["n_shared"], r["n_item"]) for r in dc.contaminations(d, b).collect()}
    assert got == brute(docs, items)
    clean = dc.decontaminate(d, b)
    assert clean.columns == d.columns
    bad = {(i, t) for i, t in docs if brute([(i, t)], items)}
    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert sorted(rows, key=repr) == sorted([r for r in docs if r not in bad], key=repr)


def test_short_items_inside_longer_documents(spark):
    items = [(1, "Blue whale"), (2, "alpha beta gamma"), (3, "one two  three four"), (4, "solo"), (5, "a b c d e")]
    docs = [(1, "we saw a blue\nwhale off the coast of the far north today"), (2, "alpha beta gamma"), (3, "x alpha beta delta gamma"),
            (4, "count one two three four five"), (5, "one two three"), (6, "SOLO"), (7, "a b c d"), (8, "z a b c d e"), (9, None), (10, ""),
            (11, "bluewhale alone"), (12, "z " * 3000 + "beta gamma alpha beta gamma")]
    d, b = spark.createDataFrame([(i, t, "s") for i, t in docs], DOCS), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminations(d, b).collect()}
    assert got == set(brute(docs, items)) == {(1, 1), (2, 2), (4, 3), (6, 4), (8, 5), (12, 2)}
    assert {r["doc_id"] for r in dc.decontaminate(d, b).collect()} == {3, 5, 7, 9, 10, 11}


def test_blocks_of_a_large_benchmark_agree(spark):
    docs, items = corpus(1)
    d = spark.createDataFrame([(i, t, "s") for i, t in docs], DOCS)
    b = spark.createDataFrame(items, "item_id long, text string")
    key = lambda df: sorted(map(repr, df.select("doc_id", "item_id", "n_shared").collect()))
    assert key(dc.contaminated_pairs(d, b, block=40)) == key(dc.contaminated_pairs(d, b))


def test_sketches_cannot_miss_a_contained_item():
    for n in range(1, 300):
        upper = 2 ** math.ceil(math.log2(n))
        size = math.floor(0.2 * upper + 1e-9) + 1
        lost = n - math.ceil(0.8 * n - 1e-9)
        assert min(size, n) > lost


def test_empty_sides(spark):
    d = spark.createDataFrame([(1, "a b c d e f", "s")], DOCS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contaminations(d, none).count() == 0 and dc.decontaminate(d, none).count() == 1
    assert dc.decontaminate(d.limit(0), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


# ---------------------------------------------------------------------------- top-k
VEC = "vec_id long, embedding array<double>"


def brute_topk(rows, every, k):
    ok = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and i is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
        out |= {(q, n + 1, i, -v) for n, (v, i) in enumerate(s)}
    return out


@pytest.mark.parametrize("pivots,block", [(32, 2048), (4, 7)])
def test_topk_matches_brute_force(spark, pivots, block):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.2 * rng.normal(size=16)]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 16) for i in range(40)] + [(1500, None), (1501, [1.0, None] + [0.0] * 14), (1502, [float("nan")] * 16),
             (1503, [float("inf")] + [0.0] * 15), (1550, [1.0, 2.0]), (None, [1.0] * 16), (1600, [0.0] * 16), (1650, [])]
    df = spark.createDataFrame(rows, VEC).withColumn("score", F.lit("clash")).repartition(6)
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in tk.top_k(df, F.col("vec_id") % 50 == 0, 5, pivots, block).collect()}
    assert got == brute_topk(rows, 50, 5)


def test_topk_large_numbers_few_rows_and_none(spark):
    rows = [(0, [1e9, -3e9, 7.0]), (1, [2e9, 5e8, 1.0]), (2, [-1e9, 1e9, 3.0]), (50, [1e9, 1e9, 1e9])]
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in tk.top_k(spark.createDataFrame(rows, VEC), F.col("vec_id") % 50 == 0, 5).collect()}
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    want = brute_topk(rows, 50, 5)
    assert {(q, v, s) for q, _, v, s in got} == {(q, v, clip(s)) for q, _, v, s in want}
    assert tk.top_k(spark.createDataFrame([], VEC), F.col("vec_id") % 50 == 0).count() == 0
    assert tk.top_k(spark.createDataFrame([(50, [1.0])], VEC), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("huge", [1e37, 1e300])
def test_topk_loses_nothing_beside_a_huge_component(spark, huge):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)] + [(301, [huge, 0.0, 1.0, 0.0, 0.0, 0.0])]
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in tk.top_k(spark.createDataFrame(rows, VEC), F.col("vec_id") % 50 == 0, 5).collect()}
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    assert got == {(q, n, v, clip(s)) for q, n, v, s in brute_topk(rows, 50, 5)} and len(got) == 30


def test_topk_components_beyond_a_double_when_scaled_take_part(spark):
    rows = [(50, [1.0, 1.0]), (1, [1.5e308, 1.0]), (2, [3.0, 1.0]), (3, [-1.5e308, 1.0])]
    got = {r["rank"]: (r["vec_id"], r["score"]) for r in tk.top_k(spark.createDataFrame(rows, VEC), F.col("vec_id") % 50 == 0, 5).collect()}
    assert got == {1: (1, (1 << 63) - 1), 2: (2, 256 * 256 * 4), 3: (3, -(1 << 63))}


def test_bounds_prune_without_loss():
    rng = np.random.default_rng(0)
    x = np.floor(256 * rng.normal(size=(400, 8)))
    p, q = x[:16], x[17]
    top = float((x ** 2).sum(axis=1).max())
    d = tk.lifted_distance(x @ p.T, (x ** 2).sum(axis=1), (p ** 2).sum(axis=1), top)
    dq = np.sqrt((q @ q) + top - 2 * (p @ q))
    low = np.abs(d - dq).max(axis=1)
    assert (((q @ q) + top - low ** 2) / 2 + 1e-6 * top >= x @ q).all()
