"""Trie of conversation prefixes by fixed-length block hashing.

A turn's digest is a 128-bit hash of its place, role and text; the digest of a run of
turns is the exclusive-or of its turns' digests, so prefix digests are running sums
that tasks can work out apart. Blocks are ``BLOCK`` successive turns of a
conversation; a block's digest covers several turns at once.

1. Conversations are grouped by the prefix digest at each block end (or at their
   own end, if it falls inside a block). One row stands for all conversations that
   share the blocks so far: their smallest id, their number and the block's turns.
2. Turn boundaries are refined only inside blocks where siblings diverge: a block
   whose parent has one block child is a chain, and all its turns have the members of
   its end. Only the others are cut into turn prefixes and grouped again.
3. The smallest member of a node is the smallest member of every node below it on its
   own path. So a conversation owns one stretch of its path, from some depth to its
   end, and a node is (owner, depth). Sums over subtrees are then sums over owners:
   suffix sums along the stretch an owner holds, and its whole stretch for each node
   above it on its path. Work grows with the turns, at any depth of the trie.

Nothing is gathered per conversation or node: positions, prefix digests and suffix
sums are windows over stretches of ``STRETCH`` blocks or turns with a prefix sum over the
stretches' totals, so a conversation that holds a third of all rows is dealt over many
tasks, as a range partition of (conversation, turn) deals its rows. Copies
are merged before any shuffle by partial aggregation. The ids of the conversations that
end at a node are packed in sorted runs and streamed through the hash.

Defined cases: rows without a conversation id belong to none and take no part; turns go
in order of turn (null first), role, text (by the first ``TIE_CHARS`` characters where equal
turns are so many that they fill several tasks); null role or text is empty; repeated rows are
turns of their own; a turnless conversation is a member of the root alone; an empty
table has no conversation, hence no root and no rows; extra columns take no part.
Different prefixes that share all 128 bits of a digest would be merged.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import written

BLOCK = 4
STRETCH = 4096
RUN_IDS = 4096
TIE_CHARS = 256         # of a text, and a quarter of them of a role, in the range key


def _zero() -> Column:
    return F.lit(0).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """Turns of every conversation in order: conv_id, pos (from 0), h1, h2 (hash of role and text), words."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]).withColumn("at", F.monotonically_increasing_id())
    # ``at`` deals equal rows over several tasks; the range key (sampled by the driver) holds no whole text
    order = ["conv_id", "turn", F.substring("role", 1, TIE_CHARS // 4), F.substring("text", 1, TIE_CHARS)]
    dealt = rows.repartitionByRange(*order, "at").sortWithinPartitions(*order, "role", "text", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            conv, role, text = (b.column(i).to_pylist() for i in range(3))
            place, h = np.empty(len(conv), np.int64), np.empty((len(conv), 2), np.int64)
            words = np.empty(len(conv), np.int64)
            for i, (c, r, t) in enumerate(zip(conv, role, text)):
                n = n + 1 if c == last else 0
                last, place[i] = c, n
                r, t = r.encode(), t.encode()
                digest = hashlib.blake2b(t, digest_size=16, key=hashlib.blake2b(r, digest_size=32).digest()).digest()
                h[i] = np.frombuffer(digest, np.int64)
                words[i] = len(t.split())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(len(conv), task, np.int64)), pa.array(place), pa.array(h[:, 0].copy()),
                                              pa.array(h[:, 1].copy()), pa.array(words)], names=["conv_id", "task", "place", "h1", "h2", "words"])

    here = written(dealt.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, task long, place long, h1 long, h2 long, words long"), "trie-turns")
    # turns of a conversation that lies in several tasks: those in earlier tasks come first
    counts = here.groupBy("conv_id", "task").agg(F.count("*").alias("n"))
    ahead = W.partitionBy("conv_id").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    later = counts.withColumn("before", F.sum("n").over(ahead)).filter("before IS NOT NULL").drop("n")
    return here.join(later, ["conv_id", "task"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", _zero())).alias("pos"), "h1", "h2", "words")


def with_shared_openings(rows: DataFrame, family: Column, head: Column, longest: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the opening of another: the first ``head`` turns of conversation ``family`` (all if fewer,
    none if absent), then a conversation's own turns after its first ``head``.

    ``rows``: as from ``turns``; ``family`` and ``head`` are over conv_id, ``head`` at most ``longest``. Returns turns and
    conversations (conv_id, length), turnless ones too.
    """
    own = rows.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("base", family).withColumn("head", head.cast("long"))
    bases = rows.filter(F.col("pos") < longest).select(F.col("conv_id").alias("base"), "pos", "h1", "h2", "words")
    opening = own.join(bases, "base").filter(F.col("pos") < F.col("head")).select("conv_id", "pos", "h1", "h2", "words")
    sizes = own.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = own.join(sizes, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_n", _zero())))
    plan = written(plan.select("conv_id", "head", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("head"), _zero())).alias("length")), "trie-plan")
    kept = rows.join(plan, "conv_id").filter(F.col("pos") >= F.col("head")).select(
        "conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("pos"), "h1", "h2", "words")
    return opening.unionByName(kept), plan.select("conv_id", "length")


def _running(rows: DataFrame, order: str, sums: dict[str, tuple], backwards: bool = False) -> DataFrame:
    """``rows`` plus running aggregates within conv_id in ``order``, own row included: {new: (function, column, combine)}.
    Windows span ``STRETCH`` rows; totals of the earlier stretches are added to them."""
    rows = rows.withColumn("__s", F.floor(F.col(order) / STRETCH).cast("long"))
    by = (lambda c: F.desc(c)) if backwards else F.asc
    ahead = W.partitionBy("conv_id").orderBy(by("__s")).rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy("conv_id", "__s").agg(*[f(c).alias(f"__t_{k}") for k, (f, c, _) in sums.items()])
    for k, (f, _, _) in sums.items():
        totals = totals.withColumn(f"__b_{k}", f(F.col(f"__t_{k}")).over(ahead))
    later = totals.filter(F.col(f"__b_{next(iter(sums))}").isNotNull()).select("conv_id", "__s", *[f"__b_{k}" for k in sums])
    here = W.partitionBy("conv_id", "__s").orderBy(by(order))
    for k, (f, c, _) in sums.items():
        rows = rows.withColumn(f"__w_{k}", f(F.col(c)).over(here))
    out = rows.join(later, ["conv_id", "__s"], "left")
    for k, (_, _, combine) in sums.items():
        out = out.withColumn(k, combine(F.col(f"__w_{k}"), F.coalesce(F.col(f"__b_{k}"), _zero())))
    return out.drop("__s", *[f"__{a}_{k}" for a in "bw" for k in sums])


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def blocks(rows: DataFrame) -> DataFrame:
    """conv_id, block, p1, p2 (prefix digest before it), d1, d2 (at its end), turns (struct g1, g2, words of its turns)."""
    placed = rows.select("conv_id", "pos", "words", F.xxhash64(F.lit(11), "pos", "h1", "h2").alias("g1"), F.xxhash64(F.lit(12), "pos", "h2", "h1").alias("g2"))
    own = F.sort_array(F.collect_list(F.struct("pos", "g1", "g2", "words")))       # at most BLOCK turns
    out = placed.groupBy("conv_id", F.floor(F.col("pos") / BLOCK).cast("long").alias("block")).agg(
        F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"), own.alias("turns"))
    out = _running(out, "block", {"d1": (F.bit_xor, "x1", _xor), "d2": (F.bit_xor, "x2", _xor)})
    return out.select("conv_id", "block", _xor(F.col("d1"), F.col("x1")).alias("p1"), _xor(F.col("d2"), F.col("x2")).alias("p2"), "d1", "d2", "turns")


def _boundaries(turns_: str = "turns", upto: Column | None = None) -> Column:
    """Array of (depth, d1, d2, u1, u2, words) for each turn of a block: digest of the prefix that ends there and of its parent."""
    def step(state, t):
        d1, d2 = _xor(state["d1"], t["g1"]), _xor(state["d2"], t["g2"])
        node = F.struct((t["pos"] + 1).alias("depth"), d1.alias("d1"), d2.alias("d2"), state["d1"].alias("u1"), state["d2"].alias("u2"), t["words"].alias("words"))
        return F.struct(d1.alias("d1"), d2.alias("d2"), F.concat(state["out"], F.array(node)).alias("out"))
    kind = "array<struct<depth:bigint,d1:bigint,d2:bigint,u1:bigint,u2:bigint,words:bigint>>"
    start = F.struct(F.col("p1").alias("d1"), F.col("p2").alias("d2"), F.array().cast(kind).alias("out"))
    return F.aggregate(F.col(turns_), start, step, lambda s: s["out"])


_KEY = ["depth", "d1", "d2"]


def nodes(parts: DataFrame, conversations: DataFrame) -> DataFrame:
    """Every node: depth, d1, d2, u1, u2 (digests of itself and of its parent), conv_id (smallest member), n_convs, words."""
    groups = written(parts.groupBy("block", "p1", "p2", "d1", "d2", F.size("turns").alias("n_turns")).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("turns").alias("turns")), "trie-blocks")
    child, parent = ["d1", "d2", "n_turns"], ["block", "p1", "p2"]
    ranges = [f(c).alias(f"{n}_{c}") for c in child for n, f in (("lo", F.min), ("hi", F.max))]
    spans = groups.groupBy(*parent).agg(*ranges)
    diverges = F.lit(False)
    for c in child:
        diverges = diverges | (F.col(f"lo_{c}") != F.col(f"hi_{c}"))
    split = groups.join(spans, parent).withColumn("nodes", _boundaries())
    split = split.select("conv_id", "n_convs", diverges.alias("diverges"), F.explode("nodes").alias("x")).select(
        "conv_id", "n_convs", "diverges", "x.*")
    split = written(split, "trie-nodes")
    chain = split.filter("NOT diverges").drop("diverges")
    refined = split.filter("diverges").groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.first("u1").alias("u1"), F.first("u2").alias("u2"), F.first("words").alias("words"))
    zero = [_zero().alias(c) for c in (*_KEY, "u1", "u2", "words")]
    root = conversations.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select("conv_id", "n_convs", *zero)
    names = [*_KEY, "u1", "u2", "conv_id", "n_convs", "words"]
    return chain.select(*names).unionByName(refined.select(*names)).unionByName(root.select(*names))


def ends_hash(ends: DataFrame) -> DataFrame:
    """SHA-256 over the ascending, comma-joined decimal ids of each key: depth, d1, d2, ends_sha256. ``ends``: key, conv_id.

    Ids come in sorted runs of ``RUN_IDS``; the runs of a key pass in order through one hash, one run in memory at a time.
    """
    kind = "depth long, d1 long, d2 long, first long, body binary"
    keys = [*_KEY, "conv_id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, out = None, [], []

        def close():
            if ids:
                out.append((*key, ids[0], ",".join(map(str, ids)).encode()))
                ids.clear()

        for b in batches:
            for *k, i in zip(*(c.to_pylist() for c in b.columns)):
                if k != key or len(ids) == RUN_IDS:
                    close()
                    key = k
                ids.append(i)
            if len(out) > 1000:
                yield _batch(out, kind)
                out.clear()
        close()
        yield _batch(out, kind)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []
        for b in batches:
            for *k, body in zip(*(c.to_pylist() for c in b.columns)):
                if k != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256(body)
                else:
                    sha.update(b",")
                    sha.update(body)
            if len(out) > 1000:
                yield _batch(out, final)
                out.clear()
        if key is not None:
            out.append((*key, sha.hexdigest()))
        yield _batch(out, final)

    final = "depth long, d1 long, d2 long, ends_sha256 string"
    runs = ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(pack, kind)
    runs = runs.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").select(*_KEY, "body")
    return runs.mapInArrow(stream, final)


_TYPES = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


def trie(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rows``: conv_id, pos, h1, h2, words; ``conversations``: conv_id, length, turnless ones too.
    """
    parts = written(blocks(rows), "trie-parts")
    every = written(nodes(parts, conversations), "trie-all").withColumn("value", (F.col("n_convs") - 1) * F.col("words"))

    # a conversation that owns nodes: where its stretch starts and hangs on, and how long it is
    edge = F.struct("depth", "u1", "u2")
    owners = every.groupBy("conv_id").agg(F.min(edge).alias("top"), F.max("depth").alias("end"), F.sum("value").alias("total"))
    owners = owners.select("conv_id", F.col("top.depth").alias("start"), (F.col("top.depth") - 1).alias("up"), F.col("top.u1").alias("u1"),
                           F.col("top.u2").alias("u2"), "end", "total")
    owners = written(owners, "trie-owners")
    hung = owners.filter("start > 0")
    above = every.select(F.col("depth").alias("up"), F.col("d1").alias("u1"), F.col("d2").alias("u2"), F.col("conv_id").alias("parent"))
    hung_on = hung.join(above, ["up", "u1", "u2"]).select("conv_id", F.col("start").alias("depth"), "parent")
    attached = hung.groupBy(F.col("up").alias("depth"), F.col("u1").alias("d1"), F.col("u2").alias("d2")).agg(F.count("*").alias("attached"))

    # children, and with them leaves
    stretch = every.join(owners.select("conv_id", "end"), "conv_id").join(attached, _KEY, "left")
    stretch = stretch.withColumn("n_children", F.coalesce("attached", _zero()) + (F.col("depth") < F.col("end")).cast("long"))
    stretch = written(stretch.withColumn("leaf", (F.col("n_children") == 0).cast("long")).drop("attached", "end"), "trie-stretch")
    leaves = stretch.groupBy("conv_id").agg(F.sum("leaf").alias("leaves"))

    # an owner's whole stretch counts for every node above it on its path
    paths = parts.join(hung.select("conv_id", "start", "total").join(leaves, "conv_id"), "conv_id").filter(F.col("block") * BLOCK + 1 < F.col("start"))
    paths = paths.select("total", "leaves", "start", F.explode(_boundaries()).alias("x")).select("total", "leaves", "start", *[f"x.{c}" for c in _KEY])
    to_root = hung.join(leaves, "conv_id").select("total", "leaves", *[_zero().alias(c) for c in _KEY])
    below = paths.filter(F.col("depth") < F.col("start")).drop("start").unionByName(to_root).groupBy(*_KEY).agg(
        F.sum("total").alias("below_total"), F.sum("leaves").alias("below_leaves"))

    plus = lambda a, b: a + b
    out = _running(stretch, "depth", {"own_total": (F.sum, "value", plus), "own_leaves": (F.sum, "leaf", plus)}, backwards=True)
    ends = conversations.select("conv_id", "length")
    at_end = parts.join(ends, "conv_id").filter(F.col("block") == F.floor((F.col("length") - 1) / BLOCK)).select(
        "conv_id", F.col("length").alias("depth"), "d1", "d2")
    at_end = at_end.unionByName(ends.filter("length = 0").select("conv_id", *[_zero().alias(c) for c in _KEY]))
    out = out.join(below, _KEY, "left").join(ends_hash(at_end), _KEY, "left").join(hung_on, ["conv_id", "depth"], "left")
    return out.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent", "conv_id")).alias("parent_conv_id"), "n_convs", "n_children",
        (F.col("own_leaves") + F.coalesce("below_leaves", _zero())).alias("n_leaves"),
        (F.col("own_total") + F.coalesce("below_total", _zero())).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
