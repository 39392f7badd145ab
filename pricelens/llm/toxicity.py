"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic models; the model of
category j sees the word features and the probabilities of categories 1..j-1.
In training those earlier probabilities are out-of-fold: each of ``FOLDS``
parts (by hash of the id) is predicted by models fitted without it, so a later
model learns from the errors the earlier ones make on unseen text. The models
used for scoring are then fitted on the whole sample.

Fitting uses a bounded sample of labelled rows (``SAMPLE``, smallest hash
first; a documented parameter). Everything else covers all rows and whole
texts: features are counts of whole words and word beginnings, selected by
log-odds between toxic and other sample documents.

The label tables hold one label, ``toxic``. The chain's categories are derived
from it: ``term`` (uses any term of the learned lexicon), ``repeated`` (uses
several), ``toxic`` (the label). ``fit_chain`` takes any 0/1 matrix.

Defined cases: null and blank texts score as a text without words; a null or
missing label takes no part in training; several labels of one id all count;
without both classes among the labels every score is 0 and nothing is
rejected; repeated rows get equal scores; extra columns pass through, ``text``
may be of any length.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, text_key, written

SAMPLE = 8000
FEATURES = 256
FOLDS = 5
MIN_DOCS = 5
RIDGE = 1.0
CATEGORIES = ("term", "repeated", "toxic")
STARTS = (4, 6)
_WORDS = re.compile(r"\w+")


def tokens(text: str | None) -> Counter:
    return Counter(_WORDS.findall(text.lower())) if text else Counter()


def features_of(words) -> set[str]:
    """Whole words and word beginnings (marked by ~)."""
    out = set(words)
    for n in STARTS:
        out.update("~" + w[:n] for w in words if len(w) > n)
    return out


@dataclass
class Chain:
    """``vocab``: feature -> column; ``weights[j]``: bias, features, summaries, earlier categories."""

    categories: tuple[str, ...] = CATEGORIES
    vocab: dict[str, int] = field(default_factory=dict)
    strong: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: list[np.ndarray] = field(default_factory=list)
    threshold: float = 0.5

    def design(self, texts) -> np.ndarray:
        """Feature matrix: log counts, then hits of strong features (log count, share of words, distinct)."""
        k = len(self.vocab)
        x = np.zeros((len(texts), k + 3))
        get = self.vocab.get
        for i, text in enumerate(texts):
            words = tokens(text)
            hit: Counter = Counter()
            for w, n in words.items():
                if (c := get(w)) is not None:
                    hit[c] += n
                for s in STARTS:
                    if len(w) > s and (c := get("~" + w[:s])) is not None:
                        hit[c] += n
            for c, n in hit.items():
                x[i, c] = math.log1p(n)
            s = sum(n for c, n in hit.items() if self.strong[c])
            x[i, k:] = math.log1p(s), 100.0 * s / (1 + sum(words.values())), math.log1p(sum(1 for c in hit if self.strong[c]))
        x[:, k + 1] = np.minimum(x[:, k + 1], 20.0)
        return x

    def predict(self, x: np.ndarray) -> np.ndarray:
        """(rows, categories): each column feeds the later models."""
        p = np.zeros((len(x), len(self.categories)))
        for j, w in enumerate(self.weights):
            p[:, j] = _sigmoid(np.hstack([x, p[:, :j]]) @ w[1:] + w[0])
        return p


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, rounds: int = 12) -> np.ndarray:
    """Ridge logistic regression by Newton steps (bias first, not penalised)."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    pen = np.full(a.shape[1], ridge)
    pen[0] = 1e-6

    def loss(w):
        z = np.clip(a @ w, -35, 35)
        return np.logaddexp(0, z).sum() - (y * z).sum() + 0.5 * (pen * w * w).sum()

    now = loss(w)
    for _ in range(rounds):
        p = _sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(pen), a.T @ (p - y) + pen * w)
        size = 1.0
        while size > 1e-3 and (new := loss(w - size * step)) > now:
            size /= 2
        w, gain, now = w - size * step, now - new, new
        if gain < 1e-6 * len(y):
            break
    return w


def fit_chain(chain: Chain, x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> tuple[Chain, np.ndarray]:
    """Fit every category in order; returns the chain and the out-of-fold probabilities."""
    held = np.zeros(y.shape)
    chain.weights = []
    for j in range(y.shape[1]):
        xj = np.hstack([x, held[:, :j]])
        for f in np.unique(fold):
            out = fold == f
            held[out, j] = _sigmoid(xj[out] @ (w := fit_linear(xj[~out], y[~out, j]))[1:] + w[0]) if (~out).any() else y[:, j].mean()
        chain.weights.append(fit_linear(xj, y[:, j]))
    return chain, held


def best_threshold(score: np.ndarray, y: np.ndarray) -> float:
    """Cut with the best F1, midway between neighbouring scores."""
    order = np.argsort(-score, kind="stable")
    s, tp = score[order], np.cumsum(y[order])
    f1 = 2 * tp / (np.arange(1, len(s) + 1) + y.sum())
    last = np.append(s[1:] < s[:-1], True)
    k = int(np.argmax(np.where(last, f1, -1)))
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0.0)) / 2)


def select_features(counts: pd.DataFrame, n1: int, n0: int, size: int = FEATURES) -> tuple[dict[str, int], np.ndarray]:
    """Features by their log-likelihood ratio for toxic texts; strong: far more frequent in them."""
    a, b = counts["n1"].to_numpy(float), counts["n0"].to_numpy(float)
    gap = np.log((a + 0.5) / (n1 - a + 0.5)) - np.log((b + 0.5) / (n0 - b + 0.5))

    def part(seen, rows, share):
        return seen * np.log(np.maximum(seen, 1e-9) / (rows * share + 1e-12))

    share = (a + b) / (n1 + n0)
    ratio = part(a, n1, share) + part(b, n0, share) + part(n1 - a, n1, 1 - share) + part(n0 - b, n0, 1 - share)
    order = np.lexsort((counts["f"].to_numpy(str), -np.where(gap > 0, ratio, 0.0)))[:size]
    order = order[gap[order] > 0]
    return {f: i for i, f in enumerate(counts["f"].to_numpy()[order])}, (gap[order] > 2.5) & (ratio[order] > 12)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` labelled rows (doc_id, text, y, fold), smallest hash of the id first. The bound holds again
    after the join: rows that agree in id, text and label count once, smallest hash of id and text first."""
    y = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", (F.col(label) > 0).cast("int").alias("y"))
    picked = y.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id", "y").limit(sample)
    rows = docs.select("doc_id", "text", text_key(F.col("text")).alias("dk")).join(F.broadcast(picked), "doc_id")
    rows = rows.dropDuplicates(["doc_id", "dk", "y"]).orderBy(F.xxhash64("doc_id", "dk", F.lit(7)), "doc_id", "dk", "y").limit(sample)
    return rows.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(FOLDS)).cast("int"))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Chain:
    """Chain fitted on the bounded sample of labelled rows."""
    rows = written(labelled_sample(docs, labels, label, sample), "toxicity-sample")

    def count(batches):
        n1, n0 = Counter(), Counter()
        for b in batches:
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (n1 if y else n0).update(features_of(tokens(text)))
        names = list(n1 | n0)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([n1[f] for f in names], pa.int64()),
                                          pa.array([n0[f] for f in names], pa.int64())], names=["f", "n1", "n0"])

    size = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    chain = Chain()
    if len(size) < 2:
        return chain
    counts = (rows.select("text", "y").mapInArrow(count, "f string, n1 long, n0 long").groupBy("f")
              .agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).filter(F.col("n1") >= min(MIN_DOCS, size[1])))
    z = F.col("n1") / F.lit(size[1]) - F.col("n0") / F.lit(size[0])
    counts = counts.orderBy(z.desc(), "f").limit(16 * FEATURES).toPandas()
    chain.vocab, chain.strong = select_features(counts, size[1], size[0])

    def design(batches):
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "dk": pdf["dk"], "y": pdf["y"], "fold": pdf["fold"],
                                "x": list(chain.design(list(pdf["text"])).astype(np.float32))})

    kind = T.StructType([rows.schema[c] for c in ("doc_id", "dk", "y", "fold")] + [T.StructField("x", T.ArrayType(T.FloatType()))])
    made = rows.mapInPandas(design, kind).toPandas().sort_values(["doc_id", "dk", "y"], kind="stable")
    x, y = np.stack(made["x"].to_numpy()).astype(float), made["y"].to_numpy()
    hits = x[:, len(chain.vocab)]
    cats = np.stack([hits > 0, hits > math.log1p(2.5), y > 0], axis=1).astype(float)
    chain, held = fit_chain(chain, x, cats, made["fold"].to_numpy())
    chain.threshold = best_threshold(held[:, -1], y)
    return chain


def score(docs: DataFrame, chain: Chain, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) plus one probability per category and ``rejected``."""
    keep = list(docs.columns if keep is None else keep)
    read = list(dict.fromkeys([*keep, "text"]))
    probs = [f"p_{c}" for c in chain.categories]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(p, T.DoubleType()) for p in probs]
                          + [T.StructField("rejected", T.BooleanType())])

    def run(batches):
        for b in batches:
            texts = b.column(read.index("text")).to_pylist()
            p = chain.predict(chain.design(texts))
            yield pa.RecordBatch.from_arrays(
                [b.column(read.index(c)) for c in keep] + [pa.array(p[:, j]) for j in range(p.shape[1])]
                + [pa.array(p[:, -1] >= chain.threshold if chain.weights else np.zeros(len(texts), bool))], names=[*keep, *probs, "rejected"])

    return docs.select(*[F.col(f"`{c}`") for c in read]).mapInArrow(run, schema)


def keep_clean(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` without the rows that the chain rejects."""
    plain = aside(docs)
    return score(plain, chain).filter("NOT rejected").select(*plain.columns).toDF(*docs.columns)
