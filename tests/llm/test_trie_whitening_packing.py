"""Prefix trie, whitening and packing against brute force, and their edge cases."""
from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import packing as pk
from pricelens.llm import prefix_trie as pt
from pricelens.llm import whitening as wh

# --- prefix trie -------------------------------------------------------------------------------------------------

CONV = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    full = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + ts[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(full):
        for d in range(len(full[c]) + 1):
            members[tuple(full[c][:d])].append(c)
        ends[tuple(full[c])].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p in members:
        value = (len(members[p]) - 1) * len(p[-1][1].encode().split()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += value
            leaves[p[:d]] += not kids[p]
    return sorted((members[p][0], len(p), members[p[:-1]][0] if p else -1, len(members[p]), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p in members)


def spark_trie(df):
    conv = F.col("conv_id")
    rows, convs = pt.with_shared_openings(pt.turns(df), conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, 3)
    out = pt.trie(rows, convs)
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in out.collect())


def conversations(seed=0, n=60):
    rng = random.Random(seed)
    say = ["a b", "c", "", "long one two three", None, "é ü\tx"]
    rows = []
    for c in range(n):
        stem = [(rng.choice(["user", None]), say[i % 3]) for i in range(rng.choice([0, 1, 3, 4, 5, 8, 9]))] if c % 2 else [("user", "same")] * rng.randint(1, 9)
        body = stem + [(rng.choice(["user", "bot"]), rng.choice(say)) for _ in range(rng.randint(0, 4))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(body)]
    rows += [(200, None, "user", "x"), (200, 0, "user", "b"), (200, 0, "user", "a"), (200, 0, "user", "a"), (None, 1, "user", "lost"),
             (-7, 0, "u", "neg"), (-20, 0, "u", "base"), (321, 0, "u", "short"), (322, 0, "u", "short")]
    rows += [(400, i, "user", f"deep {i}") for i in range(40)] + [(401, i, "user", f"deep {i}") for i in range(37)] + [(403, i, "user", f"deep {i}") for i in range(37)]
    rng.shuffle(rows)
    return rows


def test_trie_matches_brute_force(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, CONV).withColumn("depth", F.lit("clash")).withColumn("words", F.lit(None).cast("int"))
    assert spark_trie(df.repartition(5)) == brute_trie(rows)


def test_trie_across_stretches_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(pt, "STRETCH", 3)
    monkeypatch.setattr(pt, "RUN_IDS", 2)
    rows = conversations(1, 25) + [(c, i, "user", f"hot {i % 7}") for c in (500, 520, 540) for i in range(90)]
    assert spark_trie(spark.createDataFrame(rows, CONV).repartition(6)) == brute_trie(rows)


def test_trie_of_copies_repeated_rows_and_long_texts(spark):
    long = "wort " * 50_000
    rows = [(c, t, "user", f"t{t}") for c in range(1000, 1300) for t in range(5)]      # copies
    rows += [(2000, 0, "user", "again")] * 400 + [(2003, 0, "user", long), (2003, 1, "bot", long)]
    assert spark_trie(spark.createDataFrame(rows, CONV)) == brute_trie(rows)


def test_trie_of_an_empty_table_and_of_a_null_conversation(spark):
    assert spark_trie(spark.createDataFrame([], CONV)) == []
    assert spark_trie(spark.createDataFrame([(None, 0, "u", "x")], CONV)) == []


# --- whitening ---------------------------------------------------------------------------------------------------

VEC = "vec_id long, embedding array<double>"


def brute_whitening(rows):
    dim = max((len(v) for _, v in rows), default=0)
    x = [(i, [int(np.floor(256 * c)) for c in v] + [0] * (dim - len(v))) for i, v in rows]
    fit = sorted({tuple(v) for _, v in x})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array(fit, float) - np.array([t / n for t in s])
    e, u = np.linalg.eigh(c.T @ c / n)
    return x, n, s, e[::-1], u[:, ::-1]


def check_whitening(df, rows, atol=1e-9):
    x, n, s, e, u = brute_whitening(rows)
    got = defaultdict(dict)
    for r in wh.whiten(df).collect():
        got[r["vec_id"]][r["component"]] = r
    k = min(4, int((e > e[0] * 1e-12).sum()))
    by_id = dict(x)
    signs = None
    assert set(got) == set(by_id)
    for i, v in by_id.items():
        assert sorted(got[i]) == list(range(1, k + 1))
        r = [got[i][j + 1] for j in range(k)]
        assert all(q["n"] == n and q["deviation"] == min(sum((n * a - b) ** 2 for a, b in zip(v, s)), 2 ** 63 - 1) for q in r)
        want = (np.array(v, float) - np.array([t / n for t in s])) @ u[:, :k] / np.sqrt(e[:k])
        have = np.array([q["whitened"] for q in r])
        if signs is None and (np.abs(want) > 1e-6).all():
            signs = np.sign(want * have)
        if signs is not None:
            assert np.allclose(have, signs * want, atol=atol)
        assert np.allclose([q["explained"] for q in r], e[:k] / e.sum(), rtol=1e-9)
        assert all(q["identity_error"] < 1e-9 for q in r)


def test_whitening_matches_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=24) * np.r_[3, 2.5, 2, 1.5, np.ones(20)]).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(2000, [0.5, -0.25]), (2001, [])]
    df = spark.createDataFrame([*rows, (3000, None), (3001, [1.0, None]), (3002, [float("nan")]), (3003, [float("inf")] * 24)], VEC)
    check_whitening(df.withColumn("x", F.lit("clash")).withColumn("task", F.lit(1)).repartition(6), rows)


def test_whitening_of_few_dimensions_low_rank_and_huge_entries(spark):
    rng = np.random.default_rng(4)
    check_whitening(spark.createDataFrame(rows := [(i, rng.normal(size=2).tolist()) for i in range(30)], VEC), rows)
    flat = rng.normal(size=(50, 2)) @ rng.integers(-3, 4, (2, 6)).astype(float)
    rows = [(i, (np.floor(v * 8) * 4).tolist()) for i, v in enumerate(flat)]
    assert {r["component"] for r in wh.whiten(spark.createDataFrame(rows, VEC)).collect()} <= {1, 2, 3, 4}
    big = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 3.0])], VEC)
    out = wh.whiten(big).collect()
    assert {r["vec_id"] for r in out} == {1, 2, 3} and all(np.isfinite(r["whitened"]) for r in out)
    assert max(r["deviation"] for r in out) == 2 ** 63 - 1
    check_whitening(spark.createDataFrame(rows := [(i, [float(i) * 1e8, float(i * i % 7)]) for i in range(9)], VEC), rows)


def test_whitening_without_variance_or_rows(spark):
    assert wh.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], VEC)).collect() == []
    for rows in ([], [(1, None)], [(1, [])]):
        out = wh.whiten(spark.createDataFrame(rows, VEC))
        assert out.collect() == [] and out.columns == wh._OUT
    nulls = wh.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (None, [2.0, 5.0])], VEC)).collect()
    assert len(nulls) == 2 and nulls[0]["vec_id"] is None


@pytest.mark.parametrize("spectrum", [0.9 ** np.arange(80), np.r_[1, 1 - 1e-6, .9, .9 - 1e-8, np.linspace(.8, 0, 60)], np.r_[np.ones(6), np.full(24, .5)],
                                      np.r_[3, 1, np.zeros(18)], np.zeros(7), np.r_[2.0]])
def test_jacobi_davidson_reaches_double_precision(spectrum):
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(len(spectrum), len(spectrum))))[0]
    a = q @ np.diag(spectrum) @ q.T
    values, vectors, residual = wh.jacobi_davidson(lambda y: a @ y, len(a), 4)
    assert np.allclose(values, np.sort(spectrum)[::-1][:4], atol=1e-13)
    assert residual < 1e-12 and np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)


def test_partial_sums_merge_beyond_the_fan_in(spark, monkeypatch):
    x = np.arange(60).reshape(20, 3)
    fit = spark.createDataFrame([("<i8", x[i:i + 2].astype("<i8").tobytes()) for i in range(0, 20, 2)], "kind string, body binary").repartition(7)
    monkeypatch.setattr(wh, "FAN_IN", 2)
    assert wh.block_sum(fit, 3, lambda b: b.sum(axis=0).astype(float), np.zeros(3)).tolist() == x.sum(axis=0).tolist()
    assert wh.block_sum(fit, 3, wh.exact_sums, np.array([0] * 4, object)).tolist() == [20, *x.sum(axis=0).tolist()]


# --- packing -----------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def spec():
    public = pytest.importorskip("public_tokenizers")
    return pk.tokenizer_json(public.path("byte_bpe_50k.json"))


def naive_first_fit(lengths, capacity):
    bins, used = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        b = next((b for b, u in enumerate(used) if u + lengths[i] <= capacity), len(used))
        if b == len(used):
            bins.append([])
            used.append(0)
        bins[b].append(i)
        used[b] += lengths[i]
    return bins


def test_tournament_tree_is_first_fit_decreasing():
    rng = random.Random(2)
    for n in (0, 1, 2, 3, 17, 200):
        for top in (10, 50, 100):
            lengths = [rng.randint(1, top) for _ in range(n)]
            assert pk.first_fit_decreasing(lengths, 100) == naive_first_fit(lengths, 100)


def test_every_id_is_packed_once_with_little_padding():
    rng = random.Random(3)
    for lengths in ([rng.randint(1, 1023) for _ in range(500)], [600] * 300, [1023] * 9, [1], []):
        seqs = pk.packed(lengths)
        own = defaultdict(list)
        for s in seqs:
            assert 0 < sum(n for _, _, n in s) <= 1024
            for i, start, n in s:
                own[i].append((start, n))
        for i, size in enumerate(lengths):
            at = 0
            for start, n in sorted(own[i]):
                assert start == at and n > 0
                at += n
            assert at == size
        padding = sum(0 if (u := sum(n for _, _, n in s)) & (u - 1) == 0 else 1024 - u for s in seqs)
        assert padding <= 0.016 * 1024 * len(seqs)


def test_runs_give_the_tokenizers_ids(spec):
    import pyarrow as pa
    rng = random.Random(4)
    signs = " \t\n　 ab'sé中1!.,  \u0085\x1c​ \x00᠎"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    texts += ["", " ", "a  b", "It's here.\n\nNew  line, and (so)... on <|endoftext|> x"] + [" ".join(rng.choice(["the", "cat's", "1.5", "x."]) for _ in range(50)) for _ in range(50)]
    e = pk.Encoder(spec)
    assert e.by_run
    got = [i.tolist() for lo in range(0, len(texts), 500) for i in e(pa.array(texts[lo:lo + 500]))]
    assert got == [i.tolist() for i in e.whole(texts)]


def test_packing_round_trip(spark, spec):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 700)))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, " \n "), (503, " ".join(word() for _ in range(30_000))), (None, "no id")] + [(504, "same row again")] * 200 + [(504, "other text")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("start", F.lit(1.5)).repartition(5)
    out = pk.pack(df, spec, group=64)
    assert dict(out.dtypes) == {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids": "binary", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"}
    rows = out.collect()
    direct = pk.Encoder(spec).whole([t or "" for _, t in docs])
    want = sorted((repr(d), [*i.tolist(), 0]) for (d, _), i in zip(docs, direct))
    unique = {d for d, _ in docs if d != 504}
    ids, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        body = np.frombuffer(r["ids"], "<u4")
        assert len(body) == r["length"] > 0
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        if r["doc_id"] in unique:
            ids[r["doc_id"]].append((r["start"], body.tolist(), r["doc_tokens"]))
    for d in unique:
        whole = [x for _, b, _ in sorted(ids[d]) for x in b]
        assert (repr(d), whole) in want and all(n == len(whole) for _, _, n in ids[d])
    assert sum(r["length"] for r in rows) == sum(len(i) for _, i in want)
    assert sum(r["start"] == 0 for r in rows if r["doc_id"] == 504) == 201
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 1024
    again = pk.sequences(out).collect()
    assert {r["sequence_id"]: r["n_ids"] for r in again} == {s: sum(n for _, n in v) for s, v in seqs.items()}
    assert all(len(r["ids"]) == 4 * r["n_ids"] for r in again)


def test_packing_an_empty_table_and_other_ids(spark, spec):
    assert pk.pack(spark.createDataFrame([], "doc_id string, text string"), spec).collect() == []
    row = pk.pack(spark.createDataFrame([("x", None)], "doc_id string, text string"), spec).first()
    assert (row["doc_id"], row["length"], bytes(row["ids"])) == ("x", 1, b"\0\0\0\0")
