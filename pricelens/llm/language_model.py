"""Word language model: a hierarchical Pitman-Yor process, seated by Gibbs sampling.

Every word seen before a token (and the start of text) is a context with a
restaurant of its own, whose dishes are all the words seen after it and the end of
text. All context restaurants share one parent, the unigram restaurant, whose
customers are their tables and whose parent is uniform over the types and one more
that stands for every unseen word:

    p(w | u) = (c(u, w) - d t(u, w) + (s + d t(u)) p(w)) / (s + c(u))

An unseen context has p(w | u) = p(w). Seating is sampled by Gibbs: given a gamma
variable per restaurant its dishes are independent, and the number of tables of a
dish is drawn at once from its conditional distribution given all its customers
(generalised Stirling numbers; exact to ``EXACT`` customers, by a series and a saddle
point above), so a sweep covers every customer of a dish of any size. Predictive
probabilities are averaged over ``SAMPLES`` seatings after ``BURN`` sweeps.

Scale. What is gathered is the table of (context, word, count) over all training
tokens; it grows with the corpus and stays in Spark. It is dealt over blocks by
context, the pairs of the most frequent contexts by pair, so that no block grows with
the share of a word; the number of blocks follows the bytes of text. Words are dealt
over as many blocks. A row holds the arrays of one kind of a block. Dishes with one
customer have one table and need no draw; for the others a sweep draws in the blocks of
contexts, sends the tables of every word to its block, draws there, and sends back what
p(w) is made of. Only totals, and the tables of the spread contexts (at most ``SYMBOLS``
and START), pass through the driver. Scoring sends each text's distinct pairs to the
blocks of contexts; words that a block doesn't hold are looked up in the word table.
The ``HEAD`` most frequent pairs and all pairs among the ``SYMBOLS`` most frequent words
travel as bounded broadcasts instead: a shortcut with the same probabilities.
Draws are seeded by context and word, so a retried task draws the same.

Defined cases: a null text is empty: one token, the end; repeated rows get equal
scores; ids may be null or repeat; without training texts N = V = 0 and every
token has probability 1; extra columns are ignored.
"""
from __future__ import annotations

import math
import struct
import uuid
import zlib
from contextlib import contextmanager
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import text_key, written

SYMBOLS = 256
HEAD = 50_000
DISCOUNT, STRENGTH = 0.6, 5.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.4, 5.0
SWEEPS, BURN, SAMPLES = 4, 2, 2
MOVES = 3
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
EXACT = 1024
#: Bytes of text that a task takes at a time, and that fall to a block on average.
WINDOW, BLOCK = 12_000_000, 16_000_000
#: What a 16-bit index can count.
FEW = 32_000
#: START as a context, END as a word; no word is empty.
EDGE = b""


# ------------------------------------------------------------------ restaurants
def first_tables(c: int, mass: float) -> list[int]:
    """A start seating near the expected number of tables, sizes falling as 1, 1/2, 1/3, ..."""
    t = max(1, min(c, round(mass * math.log1p(c / mass)))) if mass > 0 else 1
    if t == 1:
        return [c]
    share = [(c - t) / (k + 1) for k in range(t)]
    scale = (c - t) / sum(share) if c > t else 0.0
    out = [1 + int(x * scale) for x in share]
    out[0] += c - sum(out)
    return out


def reseat(tables: list[int], mass: float, discount: float, rng, moves: int = MOVES) -> int:
    """Gibbs moves of single customers of one dish; ``mass``: weight of a new table. Returns the change in the
    number of tables. The chain ``draw_tables`` draws the limit of; kept as its reference."""
    before, n = len(tables), sum(tables)
    if n < 2:
        return 0
    for _ in range(min(moves, n)):
        r = rng.random() * n
        for k, size in enumerate(tables):
            r -= size
            if r < 0:
                break
        if tables[k] == 1:
            tables.pop(k)
        else:
            tables[k] -= 1
        r = rng.random() * (n - 1 - discount * len(tables) + mass)
        for k, size in enumerate(tables):
            r -= size - discount
            if r < 0:
                tables[k] += 1
                break
        else:
            tables.append(1)
    return len(tables) - before


@lru_cache(maxsize=8)
def _exact(discount: float, size: int) -> np.ndarray:
    """log S(c, t) of the generalised Stirling numbers, c and t to ``size``: S(c, t) sums the seatings of c customers at t tables."""
    out = np.full((size + 1, size + 1), -np.inf)
    out[1, 1] = 0.0
    for n in range(1, size):
        t = np.arange(1, n + 1)
        out[n + 1, 1:n + 1] = out[n, 1:n + 1] + np.log(n - discount * t)
        out[n + 1, 1:n + 2] = np.logaddexp(out[n + 1, 1:n + 2], out[n, :n + 1])
    return out


def _saddle(c: int, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(c, t) for t < c from its generating function ((1 - (1 - x)^d) / d)^t / t! at the saddle point."""
    r = c / t
    lo, hi = np.full(t.shape, -700.0), np.zeros(t.shape)     # log(1 - x)
    for _ in range(60):
        mid = (lo + hi) / 2
        at = discount * -np.expm1(mid) * np.exp((discount - 1) * mid) / -np.expm1(discount * mid)
        lo, hi = np.where(at > r, mid, lo), np.where(at > r, hi, mid)
    v = (lo + hi) / 2
    x = -np.expm1(v)
    curve = c * (1 + (1 - discount) * x * np.exp(-v) - r)
    return (math.lgamma(c + 1) - _lgamma(t + 1) - t * math.log(discount) + t * np.log(-np.expm1(discount * v)) - c * np.log(x)
            - 0.5 * np.log(2 * math.pi * curve))


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving small arguments up by eight."""
    x = np.asarray(x, float)
    y = x + 8
    low = sum(np.log(x + k) for k in range(8))
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - low


def _series(c: int, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(c, t) for t within a few times c^discount, from the alternating sum over powers (1 - x)^(j discount), whose
    terms fall fast there; the saddle point is loose for such few tables."""
    j = np.arange(1, 121)
    front = np.array([math.lgamma(c - discount * k) - math.lgamma(c) + math.lgamma(1 + discount * k) - math.lgamma(k + 1) for k in j])
    sign = -np.where(j % 2, -1, 1) * np.sin(math.pi * ((discount * j) % 2)) / math.pi
    t = t[:, None]
    ways = _lgamma(t + 1) - _lgamma(np.maximum(t - j, 0) + 1)
    total = (np.where(j <= t, np.exp(ways + front), 0.0) * sign).sum(axis=1)
    t = t[:, 0]
    return math.lgamma(c) - _lgamma(t + 1) - t * math.log(discount) + np.log(np.maximum(total, 1e-300))


def log_stirling(c: int, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(c, t): exact for c <= EXACT, else by the series for few tables and the saddle point (within 1 or 2 %) for many."""
    if c <= EXACT:
        return _exact(discount, EXACT)[c, t]
    out, few = np.zeros(t.shape), t <= 5 * c ** discount
    out[few] = _series(c, t[few], discount)
    rest = ~few & (t < c)
    out[rest] = _saddle(c, t[rest], discount)
    return out


def draw_tables(c: np.ndarray, mass: np.ndarray, discount: float, u: np.ndarray) -> np.ndarray:
    """Numbers of tables, one draw each from P(t | c) in proportion to mass^t S(c, t), at the quantiles ``u``: the
    limit that reseating every customer again and again would reach, at a cost that grows with the tables' spread."""
    out, lm = np.ones(len(c), np.int64), np.log(np.maximum(mass, 1e-300))
    out[c == 0] = 0
    two = c == 2
    out[two] += u[two] < mass[two] / (mass[two] + 1 - discount)
    order = np.flatnonzero(c > 2)
    order = order[np.argsort(c[order], kind="stable")]
    cuts = np.flatnonzero(np.diff(c[order])) + 1
    for same in np.split(order, cuts) if len(order) else []:
        n = int(c[same[0]])
        if n <= EXACT:
            t = np.arange(1, n + 1)
            base = log_stirling(n, t, discount)
            for lo in range(0, len(same), max(1, 1_000_000 // n)):
                at = same[lo:lo + max(1, 1_000_000 // n)]
                out[at] = 1 + _quantile(lm[at, None] * t + base, u[at])
            continue
        for i in same:
            t = np.unique(np.geomspace(1, n, 200).astype(np.int64))
            f = lm[i] * t + log_stirling(n, t, discount)
            near = np.flatnonzero(f > f.max() - 45)
            t = np.arange(t[max(near[0] - 1, 0)], t[min(near[-1] + 1, len(t) - 1)] + 1)
            step = -(-len(t) // 200_000)
            t = t[::step]
            out[i] = t[_quantile((lm[i] * t + log_stirling(n, t, discount))[None], u[i:i + 1])[0]]
    return out


def _quantile(logp: np.ndarray, u: np.ndarray) -> np.ndarray:
    p = np.cumsum(np.exp(logp - logp.max(axis=1, keepdims=True)), axis=1)
    return np.minimum((p < (u * p[:, -1])[:, None]).sum(axis=1), logp.shape[1] - 1)


def uniforms(key: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) from each 64-bit key (splitmix)."""
    with np.errstate(over="ignore"):
        x = key.astype(np.int64).view(np.uint64) + np.uint64(salt + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 9007199254740992.0 + 2.0 ** -54


def draw_gamma(shape: np.ndarray, key: np.ndarray, salt: int) -> np.ndarray:
    """Gamma(shape, 1) draws for shapes over 1, seeded by key (Marsaglia and Tsang's rejection)."""
    d = shape - 1 / 3
    out, todo = d.copy(), np.arange(len(shape))
    for k in range(64):
        a, b, u = (uniforms(key[todo], 1000 * salt + 3 * k + j) for j in range(3))
        x = np.sqrt(-2 * np.log(a)) * np.cos(2 * math.pi * b)
        v = np.maximum(1 + x / np.sqrt(9 * d[todo]), 1e-12) ** 3
        ok = np.log(u) < 0.5 * x * x + d[todo] * (1 - v + np.log(v))
        out[todo[ok]] = d[todo[ok]] * v[ok]
        todo = todo[~ok]
        if not len(todo):
            break
    return out


# ------------------------------------------------------------------ keys
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotate(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _same_length(raw: np.ndarray, seed: np.ndarray) -> np.ndarray:
    n, size = raw.shape
    at = size - size % 32
    if at:
        lanes = raw[:, :at].copy().view("<u8").reshape(n, -1, 4)
        acc = [seed + _P1 + _P2, seed + _P2, seed.copy(), seed - _P1]
        for i in range(lanes.shape[1]):
            acc = [_rotate(a + lanes[:, i, j] * _P2, 31) * _P1 for j, a in enumerate(acc)]
        h = sum((_rotate(a, r) for a, r in zip(acc[1:], (7, 12, 18))), _rotate(acc[0], 1))
        for a in acc:
            h = (h ^ (_rotate(a * _P2, 31) * _P1)) * _P1 + _P4
    else:
        h = seed + _P5
    h = h + np.uint64(size)
    for _ in range((size - at) // 8):
        h = _rotate(h ^ (_rotate(raw[:, at:at + 8].copy().view("<u8")[:, 0] * _P2, 31) * _P1), 27) * _P1 + _P4
        at += 8
    if size - at >= 4:
        h = _rotate(h ^ (raw[:, at:at + 4].copy().view("<u4")[:, 0].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at += 4
    for i in range(at, size):
        h = _rotate(h ^ (raw[:, i].astype(np.uint64) * _P5), 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def word_keys(words: pa.Array, seed: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Spark's xxhash64 of each word (or of the words at ``at``) upon a seed per element, for all words of a length at once."""
    ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4).astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    at = np.arange(len(words)) if at is None else at
    lo, size = ends[at], np.diff(ends)[at]
    out, order = np.zeros(len(at), np.uint64), np.argsort(size, kind="stable")
    with np.errstate(over="ignore"):
        for same in np.split(order, np.flatnonzero(np.diff(size[order])) + 1) if len(order) else []:
            n = int(size[same[0]])
            for part in np.split(same, range(50_000, len(same), 50_000)):
                out[part] = _same_length(data[lo[part, None] + np.arange(n)], seed[part])
    return out


def salted(salt: int, n: int) -> np.ndarray:
    """Spark's xxhash64 of an int literal, as the seed of ``n`` further hashes."""
    with np.errstate(over="ignore"):
        return np.repeat(_same_length(np.frombuffer(struct.pack("<i", salt), np.uint8)[None], np.array([42], np.uint64)), n)


# ------------------------------------------------------------------ tokens
def pairs_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words (EDGE first), the number of words of every text, and context, word and text of every token as indices."""
    cut = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))))
    text, flat = pc.list_parent_indices(cut).to_numpy().astype(np.int32), cut.flatten()
    some = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(some).dictionary_encode()
    text = text[some.to_numpy(zero_copy_only=False)]
    sizes = np.bincount(text, minlength=len(texts))
    vocab = pa.concat_arrays([pa.array([EDGE], pa.binary()), coded.dictionary.cast(pa.binary())])
    at = np.arange(len(text)) + text
    u, w = np.zeros(len(text) + len(texts), np.int32), np.zeros(len(text) + len(texts), np.int32)
    w[at] = u[at + 1] = coded.indices.to_numpy() + 1
    return vocab, sizes, u, w, np.repeat(np.arange(len(texts), dtype=np.int32), sizes + 1)


def windows(batches, column: int):
    """Slices of the batches of about WINDOW bytes of text, at most FEW texts."""
    for b in batches:
        step = min(FEW, max(1, b.num_rows * WINDOW // max(1, b.column(column).nbytes)))
        for lo in range(0, b.num_rows, step):
            yield b.slice(lo, step)


def owners(vocab: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(x) for x in vocab.to_pylist()), np.int64, len(vocab))


def places(vocab: pa.Array, u: np.ndarray, w: np.ndarray, blocks: int, hot: pa.Array) -> np.ndarray:
    """The block of every pair: that of its context, or of the pair if the context is a ``hot`` one."""
    crc = owners(vocab)
    spread = pc.is_in(vocab, value_set=hot).to_numpy(zero_copy_only=False)[u]
    return np.where(spread, crc[u] * 31 + crc[w] * 17, crc[u]) % blocks


def parts_of(key: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(key, positions in their order) for every distinct key."""
    order = np.argsort(key, kind="stable")
    if not len(order):
        return []
    return [(int(key[x[0]]), x) for x in np.split(order, np.flatnonzero(np.diff(key[order])) + 1)]


def localised(vocab: pa.Array, *ids: np.ndarray) -> tuple[pa.Array, list[np.ndarray]]:
    """The words in use and the indices among them."""
    used = np.zeros(len(vocab), bool)
    for x in ids:
        used[x] = True
    new = np.cumsum(used, dtype=np.int32) - 1
    return vocab.take(pa.array(np.flatnonzero(used))), [new[x] for x in ids]


# ------------------------------------------------------------------ rows of arrays
#: What blocks of contexts (b), blocks of words (k) and groups of texts send each other: a row holds many entries of one kind.
LISTS = {"words": pa.binary(), "u": pa.int32(), "w": pa.int32(), "n": pa.int64(), "p": pa.float64()}
ROW = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("k", T.IntegerType()), T.StructField("kind", T.StringType()),
                    T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("u", T.ArrayType(T.IntegerType())),
                    T.StructField("w", T.ArrayType(T.IntegerType())), T.StructField("n", T.ArrayType(T.LongType())), T.StructField("p", T.ArrayType(T.DoubleType()))])


def lists(parts: list, kind: pa.DataType) -> pa.Array:
    parts = [pa.array([], kind) if x is None else x.cast(kind) if isinstance(x, pa.Array) else pa.array(x, kind) for x in parts]
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.concat_arrays(parts) if parts else pa.array([], kind))


def table_of(rows: list[dict], more: dict[str, pa.DataType] | None = None) -> pa.Table:
    cols = {"b": pa.array([r.get("b", -1) for r in rows], pa.int32()), "k": pa.array([r.get("k", -1) for r in rows], pa.int32()),
            "kind": pa.array([r["kind"] for r in rows], pa.string())}
    return pa.table(cols | {c: lists([r.get(c) for r in rows], t) for c, t in (LISTS | (more or {})).items()})


def rows_of(table: pa.Table) -> dict[str, list[dict]]:
    """The rows by kind; arrays as numpy, words and ids as Arrow arrays."""
    out: dict[str, list[dict]] = {}
    for b in table.to_batches():
        cols = {c: b.column(c) for c in b.schema.names}
        for i, kind in enumerate(cols["kind"].to_pylist()):
            r = {c: x[i].as_py() if c in ("b", "k", "kind") else x[i].values for c, x in cols.items()}
            out.setdefault(kind, []).append({c: x.to_numpy() if isinstance(x, pa.Array) and c not in ("words", "ids") else x for c, x in r.items()})
    return out


def merged(vocabs: list[pa.Array]) -> tuple[pa.Array, list[np.ndarray]]:
    """The distinct words of all lists, by owner and word, and every list's indices among them."""
    coded = pa.chunked_array(vocabs, pa.binary()).combine_chunks()
    coded = (coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded).dictionary_encode()
    new = np.empty(len(coded.dictionary), np.int32)
    order = pc.array_sort_indices(coded.dictionary).to_numpy()
    new[order] = np.arange(len(order))
    ids = new[coded.indices.to_numpy()]
    return coded.dictionary.take(pa.array(order)), np.split(ids, np.cumsum([len(x) for x in vocabs])[:-1])


def summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(n, first) if len(first) else n


@contextmanager
def swept(spark: SparkSession):
    """What is written within leaves no shuffle files behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def by_kind(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written with a folder for each kind, and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    with swept(spark):
        df.write.partitionBy("kind").parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*ROW.names), path


def drop(spark: SparkSession, path: str, *names: str) -> None:
    """Delete a table of ``by_kind``, or some kinds of it, that nothing reads any more."""
    for x in [f"{path}/kind={k}" for k in names] or [path]:
        at = spark._jvm.org.apache.hadoop.fs.Path(x)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def kinds(df: DataFrame, *names: str) -> DataFrame:
    return df.filter(F.col("kind").isin(*names))


def together(key: str, *dfs: DataFrame):
    df = dfs[0]
    for x in dfs[1:]:
        df = df.unionByName(x)
    return df.groupBy(key)


# ------------------------------------------------------------------ counting
def layout(docs: DataFrame) -> tuple[int, pa.Array]:
    """The number of blocks, and the frequent contexts (START among them) whose pairs are spread over all blocks. Only the place
    of a pair depends on them, so they may come from the counts of each slice's most frequent words."""
    def run(batches):
        for b in windows(batches, 0):
            vocab, _, _, w, _ = pairs_of(b.column(0))
            n = np.bincount(w, minlength=len(vocab))
            top = np.argsort(-n, kind="stable")[:4 * SYMBOLS]
            yield pa.RecordBatch.from_arrays([vocab.take(pa.array(top)), pa.array(n[top], pa.int64()), pa.array([b.column(0).nbytes] + [0] * (len(top) - 1), pa.int64())],
                                             names=["w", "c", "bytes"])

    found = (docs.select("text").mapInArrow(run, "w binary, c long, bytes long").groupBy("w").agg(F.sum("c").alias("c"), F.sum("bytes").alias("bytes")))
    found = written(found, "lm-frequent")
    top = found.orderBy(F.desc("c"), "w").limit(SYMBOLS).collect()
    size = found.agg(F.sum("bytes")).first()[0] or 0
    return 6 + size // BLOCK, pa.array(sorted({EDGE, *(bytes(r["w"]) for r in top)}), pa.binary())


def pair_counts(docs: DataFrame, blocks: int, hot: pa.Array) -> tuple[DataFrame, str]:
    """Per block of contexts b: "pairs" (u, w, n customers, as indices of words), "many" (those with more than one customer),
    "ctx" (context u, n customers, w dishes with one), "hot" (as "ctx" with dishes in u, for the contexts spread over blocks),
    and for every block of words k "word" (words, n customers and w dishes with one in this block, u their indices)."""
    def run(batches):
        for b in windows(batches, 0):
            vocab, _, u, w, _ = pairs_of(b.column(0))
            code, n = np.unique(u.astype(np.int64) * len(vocab) + w, return_counts=True)
            u, w = code // len(vocab), code % len(vocab)
            out = []
            for at, x in parts_of(places(vocab, u, w, blocks, hot)):
                words, (lu, lw) = localised(vocab, u[x], w[x])
                out.append({"b": at, "kind": "pairs", "words": words, "u": lu, "w": lw, "n": n[x]})
            yield from table_of(out).to_batches()

    def count(table):
        rows = rows_of(table)["pairs"]
        vocab, ids = merged([r["words"] for r in rows])
        size, b = len(vocab), rows[0]["b"]
        code, n = summed(np.concatenate([i[r["u"]].astype(np.int64) * size + i[r["w"]] for i, r in zip(ids, rows)]), np.concatenate([r["n"] for r in rows]))
        u, w = code // size, code % size
        many, one = n > 1, n == 1
        cu, dishes, lone = (np.bincount(u, x, size).astype(np.int64) for x in (n, None, one))
        ctx = np.flatnonzero(dishes)
        shared = ctx[pc.is_in(vocab.take(pa.array(ctx)), value_set=hot).to_numpy(zero_copy_only=False)]
        out = [{"b": b, "kind": "pairs", "words": vocab, "u": u, "w": w, "n": n}, {"b": b, "kind": "many", "words": vocab, "u": u[many], "w": w[many], "n": n[many]},
               {"b": b, "kind": "ctx", "u": ctx, "w": lone[ctx], "n": cu[ctx]},
               {"b": b, "kind": "hot", "words": vocab.take(pa.array(shared)), "u": dishes[shared], "n": cu[shared]}]
        cw, lone = np.bincount(w, n, size).astype(np.int64), np.bincount(w, one, size).astype(np.int64)
        seen = np.flatnonzero(cw)
        for k, x in parts_of(owners(vocab.take(pa.array(seen))) % blocks):
            x = seen[x]
            out.append({"b": b, "k": k, "kind": "word", "words": vocab.take(pa.array(x)), "u": x, "w": lone[x], "n": cw[x]})
        return table_of(out)

    return by_kind(docs.select("text").mapInArrow(run, ROW).groupBy("b").applyInArrow(count, ROW), "lm-pairs")


def word_blocks(counted: DataFrame) -> tuple[DataFrame, str]:
    """Per block of words k: "own" (words, n customers, w dishes with one), and to every block of contexts "known": its words (u), their index in k (w), customers (n)."""
    def collect(table):
        rows = rows_of(table)["word"]
        vocab, ids = merged([r["words"] for r in rows])
        n, lone = np.zeros(len(vocab), np.int64), np.zeros(len(vocab), np.int64)
        for i, r in zip(ids, rows):
            n[i] += r["n"]
            lone[i] += r["w"]
        k = rows[0]["k"]
        return table_of([{"k": k, "kind": "own", "words": vocab, "n": n, "w": lone}, *[{"b": r["b"], "k": k, "kind": "known", "u": r["u"], "w": i, "n": n[i]} for i, r in zip(ids, rows)]])

    return by_kind(kinds(counted, "word").groupBy("k").applyInArrow(collect, ROW), "lm-words")


# ------------------------------------------------------------------ seating
def filled(size: int, rows: list[dict], value: str, kind=float) -> np.ndarray:
    out = np.zeros(size, kind)
    for r in rows:
        out[r["u"]] = r[value]
    return out


def context_tables(rows: dict, words: pa.Array, tables: np.ndarray, shared: tuple[pa.Array, np.ndarray]) -> np.ndarray:
    """Per word of the block its tables as a context; those of a context spread over blocks are the sum over them."""
    out = np.zeros(len(words), np.int64)
    out[rows["ctx"][0]["u"]] = tables
    at = pc.index_in(words, value_set=shared[0])
    some = at.is_valid().to_numpy(zero_copy_only=False)
    out[some] = shared[1][pc.fill_null(at, 0).to_numpy()[some]]
    return out


def seat_pairs(done: int, j: int, unigram: tuple[float, float], hot: pa.Array, shared: tuple[pa.Array, np.ndarray]):
    """A sweep in a block of contexts: tables drawn for every dish with more than one customer, given the gamma variable of its
    context. Out go "t" (tables of the contexts), "hot" (of those spread), "seat" (of the dishes, if kept) and to every block of words "more"."""
    def run(table):
        rows = rows_of(table)
        many, ctx = rows["many"][0], rows["ctx"][0]
        words, u, w, b, size = many["words"], many["u"], many["w"], many["b"], len(many["words"])
        known = rows.get("known", [])
        if "p" in rows:
            p = (filled(size, rows["p"], "p") + unigram[0]) / unigram[1]
        else:
            p = (filled(size, known, "n") + 1) / unigram[1]
        old = rows["t"][0]["n"] if "t" in rows else ctx["w"] + np.bincount(u, minlength=size)[ctx["u"]]
        t = context_tables(rows, words, old, shared)
        seeds = word_keys(words, salted(done, size))
        g = np.zeros(size)
        at = np.unique(u)
        g[at] = draw_gamma(STRENGTH / DISCOUNT + t[at].astype(float), seeds[at].view(np.int64), done)
        drawn = draw_tables(many["n"], DISCOUNT * g[u] * p[w], DISCOUNT, uniforms(word_keys(words, seeds[u], w).view(np.int64), done))
        new = ctx["w"] + np.bincount(u, drawn, size).astype(np.int64)[ctx["u"]]
        spread = np.flatnonzero(pc.is_in(words.take(pa.array(ctx["u"])), value_set=hot).to_numpy(zero_copy_only=False))
        out = [{"b": b, "kind": "t", "n": new}, {"b": b, "kind": "hot", "words": words.take(pa.array(ctx["u"][spread])), "n": new[spread]}]
        if j >= 0:
            out.append({"b": b, "kind": "seat", "n": drawn})
        more = np.bincount(w, drawn, size).astype(np.int64)
        owner, index = filled(size, [{"u": r["u"], "k": r["k"]} for r in known], "k", np.int64), filled(size, known, "w", np.int64)
        at = np.flatnonzero(more)
        out += [{"b": b, "k": k, "kind": "more", "u": at[x], "w": index[at[x]], "n": more[at[x]]} for k, x in parts_of(owner[at])]
        return table_of(out)

    return run


def seat_words(done: int, j: int, mass: float):
    """A sweep in a block of words: their tables in the unigram restaurant. Out go "sum" (customers, tables), "p" (for the blocks of
    contexts: customers less the discount of every word they need next) and, if kept, "x" (the same for all words)."""
    def run(table):
        rows = rows_of(table)
        own = rows["own"][0]
        words, t, k = own["words"], own["w"].astype(np.int64), own["k"]
        for r in rows.get("more", []):
            t[r["w"]] += r["n"]
        tt = draw_tables(t, np.full(len(t), mass), PARENT_DISCOUNT, uniforms(word_keys(words, salted(100 + done, len(t))).view(np.int64), 100 + done))
        x = t - PARENT_DISCOUNT * tt
        out = [{"k": k, "kind": "sum", "n": np.array([t.sum(), tt.sum()])}]
        out += [{"b": r["b"], "k": k, "kind": "p", "u": r["u"], "p": x[r["w"]]} for r in rows.get("known" if j >= 0 else "more", [])]
        return table_of(out + ([{"k": k, "kind": "x", "p": x}] if j >= 0 else []))

    return run


def gathered(rows: DataFrame, *values: str) -> tuple[pa.Array, list[np.ndarray]]:
    """The contexts spread over blocks and the sums of their values; never more than SYMBOLS + 1."""
    each = rows.select(F.explode(F.arrays_zip("words", *values)).alias("r")).groupBy(F.col("r.words").alias("word")).agg(*[F.sum(f"r.{v}").alias(v) for v in values])
    found = sorted(each.collect(), key=lambda r: bytes(r["word"]))
    return pa.array([bytes(r["word"]) for r in found], pa.binary()), [np.array([r[v] for r in found], np.int64) for v in values]


@dataclass
class Seating:
    """What all blocks share of the kept seatings: the contexts spread over them (customers, tables in every
    kept seating) and how the entries of "p" become p(w)."""

    blocks: int
    hot: pa.Array
    words: pa.Array
    customers: np.ndarray
    tables: list[np.ndarray]
    unigram: list[tuple[float, float]]

    def solve(self, rows: dict) -> dict:
        """All pairs of a block with log10 p, and per word of the block: customers, p(w), back-off mass as a context (1 if unseen)."""
        pairs, ctx = rows["pairs"][0], rows["ctx"][0]
        words, u, w, c = pairs["words"], pairs["u"], pairs["w"], pairs["n"]
        size, many, total, back, ps = len(words), c > 1, 0, [], []
        cu = context_tables(rows, words, ctx["n"], (self.words, self.customers))
        for j, (spread, below) in enumerate(self.unigram):
            t = np.ones(len(c), np.int64)
            t[many] = rows[f"seat{j}"][0]["n"]
            g = STRENGTH + DISCOUNT * context_tables(rows, words, rows[f"t{j}"][0]["n"], (self.words, self.tables[j]))
            p = (filled(size, rows[f"p{j}"], "p") + spread) / below
            total = total + (c - DISCOUNT * t + g[u] * p[w]) / (STRENGTH + cu[u])
            back.append(np.where(cu > 0, g / (STRENGTH + cu), 1.0))
            ps.append(p)
        return {"words": words, "u": u, "w": w, "c": c, "lp": np.log10(total / SAMPLES), "n": filled(size, rows["known"], "n", np.int64), "p": ps, "g": back, "cu": cu, "ctx": ctx["u"]}

    def shared(self) -> list[tuple]:
        """(u, g0, g1, ..) of the contexts spread over blocks."""
        each = [(STRENGTH + DISCOUNT * t) / (STRENGTH + self.customers) for t in self.tables]
        return [(bytes(u), *(float(g[i]) for g in each)) for i, u in enumerate(self.words.to_pylist())]


def sample(counted: DataFrame, blocks: int, hot: pa.Array) -> tuple[Seating, DataFrame, DataFrame, int, int, list[float]]:
    """Seatings of all restaurants, the rows of their blocks, the words (word, c, p0..), N, V and p of an unseen word."""
    spark = counted.sparkSession
    known, known_at = word_blocks(counted)
    own = kinds(known, "own")
    total = own.select(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"), F.size("words").alias("v")).agg(F.sum("n"), F.sum("v")).first()
    n, v = int(total[0] or 0), int(total[1] or 0)
    names, (customers, dishes) = gathered(kinds(counted, "hot"), "n", "u")
    shared, unigram, tables, units, kept, free, xs = (names, dishes), (0.0, float(n + v + 1)), v, [], [], [], []
    chain, old = np.random.default_rng(1), []
    fixed, before = kinds(counted, "many", "ctx").unionByName(kinds(known, "known")), []
    for done in range(1, SWEEPS + 1):
        j = done - 1 - (SWEEPS - SAMPLES)
        seats, seats_at = by_kind(together("b", fixed, *before).applyInArrow(seat_pairs(done, j, unigram, hot, shared), ROW), "lm-seats")
        shared = (names, gathered(kinds(seats, "hot"), "n")[1][0]) if n else shared
        g = chain.gamma(PARENT_STRENGTH / PARENT_DISCOUNT + tables)
        sent = [kinds(seats, "more"), kinds(known, "own", "known") if j >= 0 else own]
        words, words_at = by_kind(together("k", *sent).applyInArrow(seat_words(done, j, float(PARENT_DISCOUNT * g / (v + 1))), ROW), "lm-words")
        sums = kinds(words, "sum").agg(F.sum(F.col("n")[0]), F.sum(F.col("n")[1])).first()
        below, tables = int(sums[0] or 0), int(sums[1] or 0)
        spread = (PARENT_STRENGTH + PARENT_DISCOUNT * tables) / (v + 1)
        unigram = (spread, PARENT_STRENGTH + below)
        before = [kinds(seats, "t"), kinds(words, "p")]
        for path in old:
            drop(spark, path)
        old = [] if j >= 0 else [seats_at, words_at]
        drop(spark, seats_at, "more")
        if j >= 0:
            units.append(unigram)
            free.append(spread / unigram[1])
            kept.append((shared[1], [kinds(words, "p").withColumn("kind", F.lit(f"p{j}")), kinds(seats, "t").withColumn("kind", F.lit(f"t{j}")),
                                     kinds(seats, "seat").withColumn("kind", F.lit(f"seat{j}"))]))
            low, all_below = map(F.lit, unigram)
            xs.append(kinds(words, "x").select("k", F.transform("p", lambda x: (x + low) / all_below).alias(f"p{j}")))  # noqa: B023
    rows = kinds(counted, "pairs", "ctx").unionByName(kinds(known, "known"))
    for _, more in kept:
        for x in more:
            rows = rows.unionByName(x)
    lexicon = own.select("k", "words", "n")
    for x in xs:
        lexicon = lexicon.join(x, "k")
    lexicon = lexicon.select(F.explode(F.arrays_zip("words", "n", *[f"p{j}" for j in range(SAMPLES)])).alias("r"))
    lexicon = lexicon.select(F.col("r.words").alias("word"), F.col("r.n").alias("c"), *[F.col(f"r.p{j}").alias(f"p{j}") for j in range(SAMPLES)])
    with swept(spark):
        lexicon = written(lexicon, "lm-lexicon")
    drop(spark, known_at, "own")
    return Seating(blocks, hot, names, customers, [t for t, _ in kept], units), rows, lexicon, n, v, free


@dataclass
class Model:
    """``symbol``: frequent word -> number; RARE (all other words) and END follow, START is the last context.
    ``logp``: log10 p(symbol | context), in row RARE that of an unseen context; ``head``: frequent pair -> log10 p;
    ``known``: the counts of the words in both. All other pairs are looked up in the blocks of ``rows``, which ``pairs`` (u, w, lp, n)
    and ``contexts`` (u, g0..: back-off mass of every kept seating) show as rows, and in the word table, of which ``frequent``
    (word, c, p0..) are the symbols' rows."""

    symbol: dict[bytes, int]
    logp: np.ndarray
    head: dict[tuple[bytes, bytes], float]
    known: dict[bytes, int]
    n_tokens: int
    n_types: int
    unseen: list[float]     # p(w) of an unseen word in every kept seating
    rare_free: float        # log10 p(w | RARE) of an unseen word
    pairs: DataFrame
    contexts: DataFrame
    frequent: DataFrame
    seating: Seating
    rows: DataFrame


def pair_rows(seating: Seating, placed: DataFrame, few: pa.Array | None = None, least: int = 0) -> DataFrame:
    """u, w, c, lp, n of all pairs, or of those among ``few`` words and those with ``least`` customers; for contexts w is null, lp the first of g0, g1, ..., and ``more`` has the others."""
    def run(table):
        s = seating.solve(rows_of(table))
        words, keep = s["words"], np.ones(len(s["u"]), bool)
        ctx = s["ctx"][~pc.is_in(words.take(pa.array(s["ctx"])), value_set=seating.hot).to_numpy(zero_copy_only=False)]
        if few is not None:
            common = pc.is_in(words, value_set=few).to_numpy(zero_copy_only=False)
            keep, ctx = (s["c"] >= least) | (common[s["u"]] & common[s["w"]]), ctx[common[ctx]]
        u, w = s["u"][keep], s["w"][keep]
        none = lambda t: pa.nulls(len(ctx), t)
        cols = {"u": (words.take(pa.array(u)), words.take(pa.array(ctx))), "w": (words.take(pa.array(w)), none(pa.binary())), "c": (pa.array(s["c"][keep]), none(pa.int64())),
                "lp": (pa.array(s["lp"][keep]), none(pa.float64())), "n": (pa.array(s["n"][w]), none(pa.int64())),
                **{f"g{j}": (pa.nulls(len(u), pa.float64()), pa.array(g[ctx])) for j, g in enumerate(s["g"])}}
        return pa.table({c: pa.concat_arrays([*x]) for c, x in cols.items()})

    return placed.groupBy("b").applyInArrow(run, "u binary, w binary, c long, lp double, n long, " + ", ".join(f"g{j} double" for j in range(SAMPLES)))


def train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """Model and the table of the words that are no symbols (word, c, p0.., lp = log10 p(w | RARE)); ``docs``: training rows only."""
    spark, kept = docs.sparkSession, range(SAMPLES)
    blocks, hot = layout(docs)
    counted, path = pair_counts(docs, blocks, hot)
    seating, placed, words, n, v, free = sample(counted, blocks, hot)
    gs = [f"g{j}" for j in kept]
    shared = spark.createDataFrame(seating.shared(), "u binary, " + ", ".join(f"{g} double" for g in gs))
    every = pair_rows(seating, placed)
    pairs, back = every.filter("w IS NOT NULL").select("u", "w", "lp", "n"), every.filter("w IS NULL").select("u", *gs).unionByName(shared)

    listed = words.filter(F.length("word") > 0)
    top = listed.orderBy(F.desc("c"), "word").limit(SYMBOLS).collect()
    symbol = {bytes(r["word"]): i for i, r in enumerate(top)}
    k = len(symbol)
    frequent = spark.createDataFrame([*top, *words.filter(F.length("word") == 0).collect()], words.schema)
    unigram, p = np.zeros((SAMPLES, k + 3)), np.zeros((k + 3, k + 3))
    unigram[:, k + 1] = free    # without training texts; else set below
    for r in frequent.collect():
        unigram[:, symbol.get(bytes(r["word"]), k + 1)] = [r[f"p{j}"] for j in kept]
    p[k] = unigram.mean(axis=0)
    p[:k] = p[k + 2] = p[k]
    rows, cols = {**symbol, EDGE: k + 2}, {**symbol, EDGE: k + 1}
    # the head takes pairs from the largest counts down; smaller counts than that of its last pair need not leave their blocks
    counts = kinds(counted, "many").select(F.explode("n").alias("c")).groupBy("c").count().orderBy(F.desc("c")).limit(HEAD).collect()
    reach = np.cumsum([r["count"] for r in counts])
    least = counts[int(np.searchsorted(reach, HEAD))]["c"] if len(reach) and reach[-1] >= HEAD else 1
    drop(spark, path, "many", "word", "hot")
    with swept(spark):
        chosen = written(pair_rows(seating, placed, pa.array([*rows], pa.binary()), least), "lm-chosen")
    for r in [*chosen.filter("w IS NULL").collect(), *shared.collect()]:
        if bytes(r["u"]) in rows:
            p[rows[bytes(r["u"])]] = sum(r[g] * unigram[j] for j, g in enumerate(gs)) / SAMPLES
    few = F.broadcast(frequent.select("word"))
    chosen = chosen.filter("w IS NOT NULL").select("u", "w", "c", "lp", "n")
    for r in chosen.join(few.withColumnRenamed("word", "u"), "u").join(few.withColumnRenamed("word", "w"), "w").collect():
        p[rows[bytes(r["u"])], cols[bytes(r["w"])]] = 10 ** r["lp"]
    p[:, k] = np.maximum(1 - p.sum(axis=1), 0)
    first = chosen.orderBy(F.desc("c"), "u", "w").limit(HEAD).collect()
    head = {(bytes(r["u"]), bytes(r["w"])): r["lp"] for r in first}
    known = {bytes(r["word"]): r["c"] for r in frequent.collect()} | {bytes(r["w"]): r["n"] for r in first}
    others = float(p[k, k]) or 1.0
    rare = listed.join(few, "word", "left_anti").withColumn("lp", F.log10(sum(F.col(f"p{j}") for j in kept) / SAMPLES / others))
    with np.errstate(divide="ignore"):
        model = Model(symbol, np.log10(p), head, known, n, v, free, math.log10(sum(free) / SAMPLES / others), pairs, back, frequent, seating, placed)
    return model, rare


# ------------------------------------------------------------------ scoring
def look_up(codes: np.ndarray, values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``at`` are among the sorted ``codes``, and the values of those that are."""
    place = np.minimum(np.searchsorted(codes, at), max(len(codes) - 1, 0))
    hit = codes[place] == at if len(codes) else np.zeros(len(at), bool)
    return hit, values[place[hit]]


def index_of(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Index of every word in ``among``, or -1."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy()


def shortcuts(model: Model) -> tuple:
    """What every task gets: the words of the head and the symbols with their places in ``logp`` and counts, the head's pairs, ``logp``."""
    k = len(model.symbol)
    symbols = {**model.symbol, EDGE: k}
    vocab = sorted(symbols.keys() | {x for pair in model.head for x in pair})
    place = {x: i for i, x in enumerate(vocab)}
    row = np.array([{**model.symbol, EDGE: k + 2}.get(x, -1) for x in vocab], np.int64)
    col = np.array([{**model.symbol, EDGE: k + 1}.get(x, -1) for x in vocab], np.int64)
    count = np.array([model.known.get(x, -1) for x in vocab], np.int64)
    code = np.array([place[u] * len(vocab) + place[w] for u, w in model.head], np.int64)
    order = np.argsort(code)
    head = (code[order], np.array([*model.head.values()], float)[order])
    return pa.array(vocab, pa.binary()), row, col, count, head, model.logp


def ask(sent, blocks: int, hot: pa.Array, bottom: float):
    """Arrow function of (doc_id, dk, text): "own" has what was found in the broadcasts, per text of a slice; "ask" sends to a block of
    contexts the distinct pairs to be looked up (au, aw, each in n tokens) and the text of every such token (at)."""
    def run(batches):
        vocab, row, col, count, (codes, lps), dense = sent.value
        for b in windows(batches, 2):
            words, sizes, u, w, doc = pairs_of(b.column(2))
            order = np.argsort(u.astype(np.int64) * len(words) + w, kind="stable")
            u, w, doc = u[order], w[order], doc[order]
            first = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (w[1:] != w[:-1])])
            n = np.diff(np.r_[first, len(u)])
            u, w = u[first], w[first]
            at = index_of(words, vocab)
            iu, iw = at[u], at[w]
            lp = np.full(len(u), np.nan)
            both = np.flatnonzero((iu >= 0) & (iw >= 0))
            hit, found = look_up(codes, lps, iu[both].astype(np.int64) * len(vocab) + iw[both])
            lp[both[hit]] = found
            both = both[~hit]
            both = both[(row[iu[both]] >= 0) & (col[iw[both]] >= 0) & (count[iw[both]] >= 0)]
            lp[both] = dense[row[iu[both]], col[iw[both]]]
            here = ~np.isnan(lp)
            local, c = np.repeat(here, n), np.where(iw >= 0, count[iw], 0)
            texts = len(sizes)
            own = [np.bincount(doc[local], np.repeat(x[here], n[here]), texts) for x in (c > 0, np.log10((np.maximum(c, 0) + 1) / bottom), lp)]
            ids = b.column(0)
            out = [{"b": int(doc_block), "kind": "own", "ids": ids.take(pa.array(x)), "dks": b.column(1).take(pa.array(x)), "n": sizes[x] + 1, "known": own[0][x], "base": own[1][x], "p": own[2][x]}
                   for doc_block, x in parts_of(b.column(1).to_numpy() % blocks)]
            left = np.flatnonzero(~here)
            starts = first[left]
            for block, every in parts_of(places(words, u[left], w[left], blocks, hot)):
                fit = len(localised(words, u[left[every]], w[left[every]])[0]) <= FEW
                for x in [every] if fit else np.array_split(every, -(-2 * len(every) // FEW)):
                    own_words, (lu, lw) = localised(words, u[left[x]], w[left[x]])
                    m = n[left[x]]
                    token = np.repeat(starts[x] - np.r_[0, np.cumsum(m)[:-1]], m) + np.arange(m.sum())
                    some, text = np.unique(doc[token], return_inverse=True)
                    out.append({"b": block, "kind": "ask", "words": own_words, "au": lu.astype(np.int16), "aw": lw.astype(np.int16), "n": m, "at": text.astype(np.int16),
                                "ids": ids.take(pa.array(some)), "dks": b.column(1).take(pa.array(some))})
            yield from table_of(out, extra(ids.type)).to_batches()

    return run


def extra(ids: pa.DataType) -> dict[str, pa.DataType]:
    return {"ids": ids, "dks": pa.int64(), "au": pa.int16(), "aw": pa.int16(), "at": pa.int16(), "known": pa.float64(), "base": pa.float64()}


def answer(seating: Seating, bottom: float):
    """In a block of contexts: per group of texts (k) "sum" has what was found for the texts, "open" the words to be looked up, with their back-off masses in p."""
    def run(table):
        kind = table.schema.field("ids").type.value_type
        rows = rows_of(table)
        s = seating.solve(rows) if "pairs" in rows else None
        out, size = [], len(s["words"]) if s else 0
        codes = s["u"].astype(np.int64) * size + s["w"] if s else np.zeros(0, np.int64)
        shared = [(STRENGTH + DISCOUNT * t) / (STRENGTH + seating.customers) for t in seating.tables]

        def send(what, r, **cols):
            out.extend({"k": k, "kind": what, "ids": r["ids"].take(pa.array(x)), "dks": r["dks"][x], **{c: v.take(pa.array(x)) if isinstance(v, pa.Array) else v[x] for c, v in cols.items()}}
                       for k, x in parts_of(r["dks"] % seating.blocks))

        for r in rows.get("own", []):
            send("own", r, **{c: r[c] for c in ("n", "known", "base", "p")})
        for r in rows.get("ask", []):
            ids = r["ids"]
            at = index_of(r["words"], s["words"]) if s else np.full(len(r["words"]), -1)
            au, aw = r["au"], r["aw"]
            u, w, lp = at[au], at[aw], np.full(len(au), np.nan)
            both = np.flatnonzero((u >= 0) & (w >= 0))
            hit, found = look_up(codes, s["lp"] if s else codes, u[both].astype(np.int64) * size + w[both])
            lp[both[hit]] = found
            n = np.where(at >= 0, s["n"][at], 0) if s else np.zeros(len(at), np.int64)
            spread = index_of(r["words"], seating.words)
            g = [np.where(at >= 0, s["g"][j][at], 1.0) if s else np.ones(len(at)) for j in range(SAMPLES)]
            if len(seating.words):
                g = [np.where(spread >= 0, shared[j][spread], x) for j, x in enumerate(g)]
            miss = np.flatnonzero(np.isnan(lp) & (n[aw] > 0))
            if len(miss):
                lp[miss] = np.log10(sum(g[j][au[miss]] * s["p"][j][w[miss]] for j in range(SAMPLES)) / SAMPLES)
            c = n[aw]
            done = ~np.isnan(lp)
            each, texts = np.repeat(np.arange(len(lp)), r["n"]), len(r["dks"])
            tokens = done[each]
            text, pair = r["at"][tokens], each[tokens]
            sums = [np.bincount(text, x[pair], texts) for x in (np.ones(len(lp)), np.log10((c + 1) / bottom), np.where(done, lp, 0.0))]
            send("sum", {"ids": ids, "dks": r["dks"]}, known=sums[0], base=sums[1], p=sums[2])
            text, pair = r["at"][~tokens], each[~tokens]
            for k, x in parts_of(r["dks"][text] % seating.blocks):
                out.append({"k": k, "kind": "open", "ids": ids.take(pa.array(text[x])), "dks": r["dks"][text[x]], "words": r["words"].take(pa.array(aw[pair[x]])),
                            "p": np.stack([y[au[pair[x]]] for y in g], axis=1).ravel()})
        return table_of(out, extra(kind))

    return run


def added(table):
    """In a group of texts: a row per text with its sums and the number of its copies, and a row per token whose word must be looked up."""
    kind, rows = table.schema.field("ids").type.value_type, rows_of(table)
    own, sums, opened = (rows.get(x, []) for x in ("own", "sum", "open"))
    every = [*own, *sums]
    join = lambda rs, c: np.concatenate([r[c] for r in rs]) if rs else np.zeros(0)
    chain = lambda rs, c, t: pa.concat_arrays([pa.array(r[c], t) for r in rs]) if rs else pa.array([], t)
    ids, dks = chain(every, "ids", kind), join(every, "dks").astype(np.int64)
    code = ids.dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
    _, first, text = np.unique(np.stack([code, dks]), axis=1, return_index=True, return_inverse=True) if len(dks) else (None, np.zeros(0, np.int64), np.zeros(0, np.int64))
    text = text.ravel()
    mine = text[:sum(len(r["dks"]) for r in own)]
    total = [np.bincount(text, join(every, c), len(first)) for c in ("known", "base", "p")]
    words, g = chain(opened, "words", pa.binary()), join(opened, "p").reshape(-1, SAMPLES)
    n, m = len(first), len(words)
    pad = lambda x: pa.concat_arrays([pa.array(x, pa.float64()), pa.array(np.zeros(m))])
    cols = {"t_id": pa.concat_arrays([ids.take(pa.array(first)), chain(opened, "ids", kind)]), "t_dk": pa.array(np.r_[dks[first], join(opened, "dks").astype(np.int64)]),
            "n0": pad(np.bincount(mine, join(own, "n"), n)), "known": pad(total[0]), "base": pad(total[1]), "total": pad(total[2]), "same": pad(np.bincount(mine, minlength=n)),
            "w": pa.concat_arrays([pa.nulls(n, pa.binary()), words])}
    return pa.table(cols | {f"g{j}": pa.concat_arrays([pa.nulls(n, pa.float64()), pa.array(g[:, j], pa.float64())]) for j in range(SAMPLES)})


def score(docs: DataFrame, model: Model, rare: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns (doc_id among them) plus n_tokens, n_known, train_tokens, base_score, score."""
    spark, kept, seating = docs.sparkSession, range(SAMPLES), model.seating
    free, kind = model.unseen, docs.schema["doc_id"].dataType
    bottom = float(model.n_tokens + model.n_types + 1)
    sent = spark.sparkContext.broadcast(shortcuts(model))
    tagged = docs.withColumn("dk", text_key(F.col("text")))
    more = [T.StructField("ids", T.ArrayType(kind)), T.StructField("dks", T.ArrayType(T.LongType())), *[T.StructField(c, T.ArrayType(T.ShortType())) for c in ("au", "aw", "at")],
            T.StructField("known", T.ArrayType(T.DoubleType())), T.StructField("base", T.ArrayType(T.DoubleType()))]
    wide = T.StructType([*ROW.fields, *more])
    asked = tagged.select("doc_id", "dk", "text").mapInArrow(ask(sent, seating.blocks, seating.hot, bottom), wide)
    found = asked.unionByName(model.rows, allowMissingColumns=True).groupBy("b").applyInArrow(answer(seating, bottom), wide)
    fields = [T.StructField("t_id", kind), T.StructField("t_dk", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("n0", "known", "base", "total", "same")],
              T.StructField("w", T.BinaryType()), *[T.StructField(f"g{j}", T.DoubleType()) for j in kept]]
    with swept(spark):
        sums = written(found.groupBy("k").applyInArrow(added, T.StructType(fields)), "lm-sums")
    words = rare.select("word", "c", *[f"p{j}" for j in kept]).unionByName(model.frequent).withColumnRenamed("word", "w")
    back = sum(F.col(f"g{j}") * F.coalesce(f"p{j}", F.lit(free[j])) for j in kept) / SAMPLES
    n = F.coalesce("c", F.lit(0))
    missed = (sums.filter("w IS NOT NULL").join(words, "w", "left")
              .select("t_id", "t_dk", "n0", (n > 0).cast("double").alias("known"), F.log10((n + 1) / F.lit(bottom)).alias("base"), F.log10(back).alias("total"), "same"))
    each = ["n0", "known", "base", "total", "same"]
    sums = sums.filter("w IS NULL").select("t_id", "t_dk", *each).unionByName(missed).groupBy("t_id", "t_dk").agg(*[F.sum(c).alias(c) for c in each])
    one = lambda c: F.col(c) / F.col("same")  # noqa: E731   repeated rows (same id, same text) add up
    return (tagged.join(sums, F.col("doc_id").eqNullSafe(F.col("t_id")) & F.col("dk").eqNullSafe(F.col("t_dk")))
            .select(*keep, one("n0").cast("long").alias("n_tokens"), one("known").cast("long").alias("n_known"), F.lit(model.n_tokens).cast("long").alias("train_tokens"),
                    one("base").alias("base_score"), one("total").alias("score")))
