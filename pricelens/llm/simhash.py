"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes of a
text's word shingles (repeats count). Two fingerprints link at ``radius`` or
fewer differing bits; a component is everything reachable over links.

Covering masks: bit i gets a nonzero vector phi(i) of radius + 1 bits, and
table v (nonzero) keeps the bits with <phi(i), v> odd. The phi of at most
``radius`` differing bits span less than the whole space, so some v is
orthogonal to all of them and its mask keeps none of them: the pair collides
in that table. No linked pair can be missed, whatever the data.

Rows are reduced to distinct fingerprints before any bucket is formed, so a
group of copies of any size is one entry. A bucket of more than ``LIMIT``
fingerprints is dealt out again by a second covering over its free bits, whose
buckets hold at most 2^14 values by construction; both levels are exact. Only
a spanning forest of each bucket leaves a task, never its pairs.

Defined cases: null, empty and blank texts have fingerprint 0 and link like
any other; a text of fewer words than the shingle is one shingle; repeated
rows share a fingerprint; null ids never become a component id unless every
member's id is null; an empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, text_key, written

SHINGLE = 3
RADIUS = 3
SEED = 42
LIMIT = 2048
CHUNK = 1 << 16


# ------------------------------------------------------------------ fingerprints
def fingerprint(raw: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text given as UTF-8."""
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    flat, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    counts, total = np.zeros(64, np.int64), len(words) - shingle + 1
    for lo in range(0, total, CHUNK):
        hi = min(total, lo + CHUNK)
        spans = zip(starts[lo:hi].tolist(), ends[lo + shingle - 1:hi + shingle - 1].tolist())
        h = np.fromiter([digest(flat[a:b], SEED) for a, b in spans], np.uint64, hi - lo)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, keep: list[str], shingle: int = SHINGLE, text: str = "text",
                     out: str = "fp") -> DataFrame:
    """Columns ``keep`` of ``docs`` plus the signed 64-bit fingerprint of ``text``."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(out, T.LongType(), False)])
    read = list(dict.fromkeys([*keep, text]))

    def run(batches):
        for b in batches:
            raw = b.column(read.index(text)).cast(pa.binary()).to_pylist()
            fps = np.fromiter((fingerprint(r, shingle) for r in raw), np.uint64, len(raw)).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(read.index(c)) for c in keep] + [pa.array(fps, pa.int64())],
                                             names=[*keep, out])

    return docs.select(*[F.col(f"`{c}`") for c in read]).mapInArrow(run, schema)


# ------------------------------------------------------------------ covering masks
def covering(bits: list[int], radius: int = RADIUS) -> list[int]:
    """One mask for each nonzero v over the given bit positions."""
    n = 1 << (radius + 1)
    return [sum(1 << b for i, b in enumerate(bits) if bin((i % (n - 1) + 1) & v).count("1") % 2) for v in range(1, n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def forest(fps: np.ndarray, groups: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest (member, smallest member reached) inside each run of equal ``groups``."""
    n = len(fps)
    label = np.arange(n)
    u, v, d = [], [], 1
    alive = np.arange(n - 1) if n else np.arange(0)
    while len(alive):
        alive = alive[alive + d < n]
        alive = alive[groups[alive] == groups[alive + d]]
        hit = alive[_popcount(fps[alive] ^ fps[alive + d]) <= radius]
        if len(hit):
            u.append(hit)
            v.append(hit + d)
            if sum(map(len, u)) > 2_000_000:   # fold what is known into labels; links grow quadratically, labels don't
                label = _settle(label, np.concatenate(u), np.concatenate(v))
                u, v = [np.arange(n)], [label.copy()]
        d += 1
    if u:
        label = _settle(label, np.concatenate(u), np.concatenate(v))
    moved = np.flatnonzero(label != np.arange(n))
    return fps[moved], fps[label[moved]]


def _settle(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label, new)
        new = new[new]
        if (new == label).all():
            return label
        label = new


EDGE = "kind int, t int, m long, a long, b long"


def _links(radius: int, limit: int | None, free: dict[int, list[int]]):
    """Buckets arrive sorted by (t, m, fp). Emits kind 0 edges (a, b); members of a
    bucket beyond ``limit`` go out again as kind 1 rows (t, m of the second level, a = fp)."""

    def table(kind, t, m, a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind), pa.int32()), pa.array(t, pa.int32()),
                                           pa.array(m, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                          names=["kind", "t", "m", "a", "b"])

    def again(t, fp):
        for w, mask in enumerate(free[t]):
            m = fp & np.int64(mask)
            yield table(1, np.full(len(fp), t * 64 + w), m, fp, np.zeros(len(fp), np.int64))

    def run(batches):
        t0 = np.zeros(0, np.int32)
        m0, f0 = np.zeros(0, np.int64), np.zeros(0, np.int64)
        large = None    # key of the bucket being passed on
        for batch in batches:
            t = np.concatenate([t0, batch.column(0).to_numpy()])
            m = np.concatenate([m0, batch.column(1).to_numpy()])
            f = np.concatenate([f0, batch.column(2).to_numpy()])
            if not len(t):
                continue
            if large is not None:
                cut = int(np.argmin(np.append((t == large[0]) & (m == large[1]), False)))
                if cut:
                    yield from again(large[0], f[:cut])
                    t, m, f = t[cut:], m[cut:], f[cut:]
                if not len(t):
                    t0, m0, f0 = t, m, f
                    continue
                large = None
            yield from close(t, m, f, False)
            last = int(np.argmax((t == t[-1]) & (m == m[-1])))
            t0, m0, f0 = t[last:], m[last:], f[last:]
            if limit and len(t0) > limit:
                large = (int(t0[0]), int(m0[0]))
                yield from again(large[0], f0)
                t0, m0, f0 = t0[:0], m0[:0], f0[:0]
        if len(t0):
            yield from close(t0, m0, f0, True)

    def close(t, m, f, end):
        """Edges of all buckets but the last one, which may go on (all of them at the end)."""
        new = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (m[1:] != m[:-1])))
        size = np.diff(np.append(new, len(t)))
        g = np.repeat(np.arange(len(new)), size)
        keep = np.repeat(size > 1, size)
        if not end:
            keep &= g != g[-1]
        big = np.repeat(size > limit, size) & keep if limit else np.zeros(len(t), bool)
        for k in np.unique(g[big]):
            own = g == k
            yield from again(int(t[own][0]), f[own])
        keep &= ~big
        a, b = forest(f[keep].view(np.uint64), g[keep], radius)
        if len(a):
            z = np.zeros(len(a), np.int64)
            yield table(0, z, z, a.view(np.int64), b.view(np.int64))

    return run


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) whose components are those of all pairs within ``radius``; ``fps``: distinct ``fp``."""
    masks = covering(list(range(64)), radius)
    free = {v: [_signed(mask | s) for s in covering([b for b in range(64) if not mask >> b & 1], radius)]
            for v, mask in enumerate(masks)}
    cells = F.array(*[F.struct(F.lit(v).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("m"))
                      for v, mask in enumerate(masks)])
    first = (fps.select("fp", F.explode(cells).alias("c")).select("c.t", "c.m", "fp")
             .repartition("t", "m").sortWithinPartitions("t", "m", "fp"))
    out = written(first.mapInArrow(_links(radius, limit, free), EDGE), "simhash-links")
    second = (out.filter("kind = 1").select("t", "m", F.col("a").alias("fp"))
              .repartition("t", "m").sortWithinPartitions("t", "m", "fp"))
    deep = second.mapInArrow(_links(radius, None, {}), EDGE)
    return out.filter("kind = 0").select("a", "b").union(deep.select("a", "b"))


# ------------------------------------------------------------------ components
def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, root) for every node that isn't its component's smallest node.

    Alternating large-star and small-star steps; each round is a few grouped
    minima and joins over the links, written to the shared folder. Stops when a
    round changes nothing (about log of the longest path); raises beyond ``max_rounds``.
    """
    e = written(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                "links")
    seen = None
    for _ in range(max_rounds):
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1000003)).first()
        if now[0] == 0 or now == seen:
            return e.withColumnRenamed("v", "root")
        seen = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        e = written(small, "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def fingerprint_components(rows: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """(fp, component_id, root): ``rows`` hold doc_id and fp; the component id is the smallest doc_id reachable."""
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-nodes")
    stars = components(fingerprint_links(nodes.select("fp"), radius, limit)).select(F.col("u").alias("fp"), "root")
    rooted = nodes.join(stars, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return written(rooted.join(lows, "root").select("fp", "component_id", "root"), "simhash-components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, fp (signed), component_id."""
    rows = written(with_fingerprint(docs, ["doc_id"], shingle), "simhash-rows")
    return rows.join(fingerprint_components(rows, radius, limit).drop("root"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id (nulls last), then the smallest
    fingerprint, then the smallest hash of the text, then of the row's columns (those that can be hashed: all but maps).
    The survivor is the same over any partitioning; rows that agree in all of that count once. Null, empty and very
    long texts have fingerprints like any other; an empty table stays empty."""
    plain = aside(docs)
    keyed = plain.withColumn("__dk", text_key(F.col("text")))
    rows = written(with_fingerprint(keyed, ["doc_id", "__dk"], shingle), "simhash-rows")
    comps = fingerprint_components(rows, radius)
    nodes = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__dk")).alias("b"))
    best = (nodes.join(comps, "fp").filter(F.col("b.doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root").agg(F.min(F.struct("fp", "b.__dk", "b.doc_id")).alias("k"))
            .select(F.col("k.doc_id").alias("keep_id"), F.col("k.__dk").alias("keep_dk")))
    kept = keyed.join(best, F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("__dk") == F.col("keep_dk")), "left_semi")
    hashed = [f.name for f in plain.schema if "map<" not in f.dataType.simpleString()]
    first = F.min_by(F.struct(*plain.columns), F.xxhash64(*hashed))
    out = kept.groupBy(F.col("doc_id").alias("__id"), "__dk").agg(first.alias("__row"))
    return out.select("__row.*").toDF(*docs.columns)
