"""Quality classifier: a generalised additive model with pairwise interactions.

Features are shares and means of a whole text (letters, capitals, symbols,
repeats, word and line lengths, ...), cut into at most ``BINS`` bins by quantiles
of the training sample. Training is cyclic boosting: round after round, each
feature in turn gets one shallow tree on its bins (``LEAVES`` leaves by best
Newton gain), whose leaf values, times a small rate, are added to the
feature's lookup table. Then the ``PAIRS`` feature pairs that explain most of
the remaining gradient are boosted the same way on their two-dimensional
tables (a tree of two cuts, one per feature). A score is the sigmoid of a base
plus one table entry per feature and pair: vectorised additions, no tree left.

Fitting uses at most ``SAMPLE`` labelled rows (smallest hash of the id first; a
documented parameter). Features are computed once for every document in one
pass over whole texts and kept as a small table.

Defined cases: null and blank texts have all-zero features and a score like any
other; null or missing labels train nothing, several labels of one id all
count; with a single class among the labels every score is that share; without
labels every score is 0.5; repeated rows get equal scores.
"""
from __future__ import annotations

import math
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

SAMPLE = 20_000
BINS = 32
LEAVES = 4
ROUNDS = 60
PAIRS = 6
PAIR_BINS = 8
PAIR_ROUNDS = 25
RATE = 0.15
PEN = 1.0
FEATURES = ("log_words", "word_len", "word_len_sd", "upper", "upper_words", "symbols", "exclaims", "digits", "spaces", "commas",
            "stops", "distinct_words", "top_word", "same_as_last", "log_lines", "line_len", "distinct_lines", "bars", "non_ascii",
            "symbol_ends", "short_words", "packed", "stop_per_word", "short_lines", "braces")
_UPPER, _DIGIT = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = ~(_LETTER | _DIGIT | _BLANK)
_SYMBOL[[ord(c) for c in ".,'-"]] = False
_PACK = 1 << 16


def describe(raw: bytes | None) -> np.ndarray:
    """The features of one text given as UTF-8."""
    out = np.zeros(len(FEATURES), np.float32)
    words = raw.split() if raw else []
    if not words:
        return out
    n, size = len(words), len(raw)
    h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    letters, lens = max(1, h[_LETTER].sum()), np.fromiter(map(len, words), np.int64, n)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    same = sum(map(bytes.__eq__, words[1:], words[:-1]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = sum(1 for w in seen if len(w) > 1 and _SYMBOL[w[-1]] and _SYMBOL[w[-2]])
    uppers = sum(k for w, k in seen.items() if len(w) > 1 and w[:2].isupper())
    packed = sum(len(zlib.compress(raw[i:i + _PACK], 1)) for i in range(0, size, _PACK))
    stops = h[46] + h[33] + h[63]
    out[:] = (math.log1p(n), lens.mean(), lens.std(), h[_UPPER].sum() / letters, uppers / n, h[_SYMBOL].sum() / size, h[33] / n,
              h[_DIGIT].sum() / size, h[_BLANK].sum() / size, h[44] / n, h[46] / n, len(seen) / n, max(seen.values()) / n, same / n,
              math.log1p(len(lines)), math.log1p(size / max(1, len(lines))), len(set(lines)) / max(1, len(lines)), h[124] / n,
              h[128:].sum() / size, ends / len(seen), (lens <= 2).mean(), packed / size, stops / n,
              sum(len(x) < 40 for x in lines) / max(1, len(lines)), (h[123] + h[125] + h[59] + h[61]) / n)
    return out


def feature_table(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``x``: the features of every whole text."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("x", T.ArrayType(T.FloatType()))])
    read = list(dict.fromkeys([*keep, "text"]))

    def run(batches):
        for b in batches:
            raw = b.column(read.index("text")).cast(pa.binary()).to_pylist()
            x = np.stack([describe(r) for r in raw]) if raw else np.zeros((0, len(FEATURES)), np.float32)
            flat = pa.ListArray.from_arrays(np.arange(len(raw) + 1, dtype=np.int32) * len(FEATURES), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(read.index(c)) for c in keep] + [flat], names=[*keep, "x"])

    return docs.select(*[F.col(f"`{c}`") for c in read]).mapInArrow(run, schema)


@dataclass
class Additive:
    """``tables[f]``: one value per bin of feature f; ``pairs``: (f, g, table over their coarse bins)."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            z += t[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for f, g, t in self.pairs:
            z += t[np.searchsorted(self.coarse[f], x[:, f], side="right"), np.searchsorted(self.coarse[g], x[:, g], side="right")]
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _edges(v: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(v, np.arange(1, bins) / bins, method="higher"))


def _gain(g, h):
    return g * g / (h + PEN)


def _cut(g: np.ndarray, h: np.ndarray, lo: int, hi: int) -> tuple[float, int]:
    """Best cut of bins lo..hi-1: its gain and the first bin on the right."""
    if hi - lo < 2:
        return 0.0, lo
    gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
    gt, ht = g[lo:hi].sum(), h[lo:hi].sum()
    gain = np.where((hl > 1) & (ht - hl > 1), _gain(gl, hl) + _gain(gt - gl, ht - hl) - _gain(gt, ht), 0.0)
    k = int(np.argmax(gain))
    return float(gain[k]), lo + k + 1


def tree_on_bins(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Leaf value of each bin: a best-first tree of at most ``leaves`` leaves."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = max(((*_cut(g, h, lo, hi), lo, hi) for lo, hi in parts), key=lambda c: c[0])
        if best[0] <= 1e-9:
            break
        parts.remove((best[2], best[3]))
        parts += [(best[2], best[1]), (best[1], best[3])]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + PEN)
    return out


def tree_on_grid(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best two-cut tree: one cut of the rows, then one of the columns on either side."""
    best, out = 0.0, np.zeros(g.shape)
    for swap in (False, True):
        a, b = (g.T, h.T) if swap else (g, h)
        for k in range(1, len(a)):
            gain, val = -_gain(a.sum(), b.sum()), np.zeros(a.shape)
            for s in (slice(0, k), slice(k, None)):
                ga, hb = a[s].sum(axis=0), b[s].sum(axis=0)
                more, c = _cut(ga, hb, 0, len(ga))
                gain += _gain(ga.sum(), hb.sum()) + more
                for t in ((slice(0, c), slice(c, None)) if more > 0 else (slice(None),)):
                    val[s, t] = ga[t].sum() / (hb[t].sum() + PEN)
            if gain > best:
                best, out = gain, val.T if swap else val
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Additive:
    """Cyclic boosting on a feature matrix and 0/1 labels."""
    if not len(y):
        return Additive()
    share = (y.sum() + 1e-3) / (len(y) + 2e-3)
    m = Additive(base=float(np.log(share / (1 - share))))
    if y.min() == y.max():
        return m
    m.edges = [_edges(x[:, f], BINS) for f in range(x.shape[1])]
    m.coarse = [_edges(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(m.edges)]
    wide = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(m.coarse)]
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    z = np.full(len(y), m.base)
    for _ in range(ROUNDS):
        for f, b in enumerate(bins):
            p = 1 / (1 + np.exp(-z))
            step = RATE * tree_on_bins(np.bincount(b, y - p, len(m.tables[f])), np.bincount(b, p * (1 - p), len(m.tables[f])))
            m.tables[f] += step
            z += step[b]

    def grid(f, g, v):
        return np.bincount(wide[f] * (len(m.coarse[g]) + 1) + wide[g], v, (len(m.coarse[f]) + 1) * (len(m.coarse[g]) + 1)).reshape(-1, len(m.coarse[g]) + 1)

    p = 1 / (1 + np.exp(-z))
    ranked = sorted(((tree_on_grid(grid(f, g, y - p), grid(f, g, p * (1 - p)))[0], f, g)
                     for f in range(x.shape[1]) for g in range(f + 1, x.shape[1])), key=lambda t: (-t[0], t[1], t[2]))
    m.pairs = [(f, g, np.zeros((len(m.coarse[f]) + 1, len(m.coarse[g]) + 1))) for gain, f, g in ranked[:PAIRS] if gain > 0]
    for _ in range(PAIR_ROUNDS):
        for f, g, t in m.pairs:
            p = 1 / (1 + np.exp(-z))
            step = RATE * tree_on_grid(grid(f, g, y - p), grid(f, g, p * (1 - p)))[1]
            t += step
            z += step[wide[f], wide[g]]
    return m


def train(features: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Additive:
    """Model from at most ``sample`` labelled rows; ``features``: doc_id and x. The bound holds for labels and again after
    the join: rows that agree in id, features and label count once, smallest hash of id and features first."""
    y = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", (F.col(label) > 0).cast("int").alias("y"))
    picked = y.orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id", "y").limit(sample)
    rows = features.select("doc_id", "x", F.xxhash64("x").alias("xk")).join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id", "xk", "y"])
    rows = rows.orderBy(F.xxhash64("doc_id", "xk", F.lit(9)), "doc_id", "xk", "y").limit(sample).toPandas()
    rows = rows.sort_values(["doc_id", "xk", "y"], kind="stable")
    x = np.array(rows["x"].tolist(), np.float32).reshape(len(rows), len(FEATURES))
    return fit(x, rows["y"].to_numpy(float))


def score(features: DataFrame, model: Additive, keep: list[str], cut: float = 0.5) -> DataFrame:
    """``keep`` columns plus score and predicted (1 if score >= ``cut``)."""
    schema = T.StructType([features.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for b in batches:
            flat = b.column("x").flatten().to_numpy(zero_copy_only=False)
            s = model.score(flat.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(s), pa.array((s >= cut).astype(np.int32))],
                                             names=[*keep, "score", "predicted"])

    return features.mapInArrow(run, schema)


def rate(docs: DataFrame, labels: DataFrame, keep: list[str], cut: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """Train on ``labels`` and score all of ``docs``."""
    features = written(feature_table(docs, keep), "quality-features")
    return score(features, train(features, labels, sample=sample), keep, cut)
