"""Language identification by nearest centroid.

A text is a vector of hashed byte n-grams (1 to 3 bytes of the lower-cased
UTF-8 text, ``DIM`` buckets), weighted by sublinear term frequency times inverse
document frequency and scaled to length one. Each language has several
centroids, found by spherical k-means inside the language; the prediction is the
language of the centroid with the largest cosine. A text farther from its
centroid than nearly all training texts of that language is marked
``rejected`` (its prediction stays the nearest language).

Document frequencies cover every training row: each task adds up ``DIM``
counters and emits those, so the shuffle is bounded by tasks x ``DIM``. The
centroids are fitted on at most ``SAMPLE`` rows per language (smallest hash
first; a documented parameter). Scoring is one pass without a shuffle; the
model that travels holds languages x ``CENTROIDS`` x ``DIM`` numbers.

Defined cases: a null text or one without a letter is ``und`` with score 0; a
null language trains nothing; without training rows every text is ``und`` with
score 0; equal cosines go to the language first by code point; repeated rows get
equal results; texts may be of any length (they are counted in blocks).
"""
from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


DIM = 4096
CENTROIDS = 4
SAMPLE = 1500
ROUNDS = 8
REJECT_SHARE = 0.002
_BLOCK = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return _LETTER.search(text) is not None


def ngram_counts(text: str, dim: int = DIM) -> np.ndarray:
    """Counts of hashed byte n-grams of a whole text."""
    raw = np.frombuffer(b" " + " ".join(text.lower().split()).encode() + b" ", np.uint8).astype(np.uint32)
    shift = np.uint32(32 - (dim.bit_length() - 1))
    out = np.zeros(dim, np.int64)
    for lo in range(0, len(raw), _BLOCK):
        b = raw[lo:lo + _BLOCK + 2]
        grams = [b[:_BLOCK], (b[:-1] | (b[1:] << np.uint32(8)) | np.uint32(1 << 24))[:_BLOCK]]
        if len(b) > 2:
            grams.append((b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16)) | np.uint32(2 << 24))[:_BLOCK])
        for g in grams:
            out += np.bincount((g * np.uint32(2654435761)) >> shift, minlength=dim)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(n > 0, n, 1)


@dataclass
class Centroids:
    """``langs``: language of each centroid (by code point); ``floor``: smallest accepted cosine of each language."""

    langs: list[str]
    points: np.ndarray
    idf: np.ndarray
    floor: dict[str, float]

    def vectors(self, texts: list[str]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.idf)), np.float32)
        for i, t in enumerate(texts):
            x[i] = np.log1p(ngram_counts(t, len(self.idf)))
        return unit(x * self.idf)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        lang, score, far = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        rows = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.langs else []
        for lo in range(0, len(rows), 256):
            part = rows[lo:lo + 256]
            cos = self.vectors([texts[i] for i in part]) @ self.points.T
            best = cos.argmax(axis=1)
            for i, k, c in zip(part, best, cos.max(axis=1)):
                lang[i], score[i] = self.langs[k], min(1.0, max(0.0, float(c)))
                far[i] = score[i] < self.floor[lang[i]]
        return lang, score, far


def document_frequency(docs: DataFrame, dim: int = DIM) -> tuple[np.ndarray, int]:
    """Texts holding each n-gram bucket, and the number of texts, over all rows."""
    def count(batches):
        df, n = np.zeros(dim, np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    df += ngram_counts(t, dim) > 0
                    n += 1
        k = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(k, -1)), pa.array(np.append(df[k], n))], names=["k", "n"])

    rows = docs.select("text").mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    out, total = np.zeros(dim, np.int64), 0
    for r in rows:
        if r["k"] < 0:
            total = r["n"]
        else:
            out[r["k"]] = r["n"]
    return out, total


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and the cosine of each row to its nearest; starts from the rows farthest from those chosen before."""
    start = [int(np.argmax(x @ unit(x.mean(axis=0))))]
    near = x @ x[start[0]]
    while len(start) < min(k, len(x)):
        start.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[start[-1]])
    c = x[start]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        c = unit(np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))]))
    return c, (x @ c.T).max(axis=1)


def train(docs: DataFrame, lang: Column, sample: int = SAMPLE, k: int = CENTROIDS, dim: int = DIM) -> Centroids:
    """Model from the rows of ``docs`` (all are training rows); ``lang``: their language, null: unlabelled."""
    rows = docs.select("doc_id", "text", lang.alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    df, n = document_frequency(rows, dim)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + np.float32(1)
    base = Centroids([], np.zeros((0, dim), np.float32), idf, {})
    size = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    u = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    thin = (rows.withColumn("u", u).join(F.broadcast(size), "lang").filter(F.col("u") <= 1.5 * sample / F.col("n") + 0.0)
            .withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("u", "doc_id", F.xxhash64("text")))).filter(F.col("r") <= sample))

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = [t for t in pdf.sort_values(["u", "r"])["text"] if has_letter(t)]
        if not texts:
            return pd.DataFrame({"lang": [], "c": [], "floor": []})
        c, cos = spherical_kmeans(base.vectors(texts), k)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "c": list(c.astype(np.float32)), "floor": float(np.quantile(cos, REJECT_SHARE))})

    made = sorted(thin.groupBy("lang").applyInPandas(cluster, "lang string, c array<float>, floor double").collect(),
                  key=lambda r: (r["lang"].encode(), r["c"][:8]))
    if not made:
        return base
    return Centroids([r["lang"] for r in made], np.array([r["c"] for r in made], np.float32), idf, {r["lang"]: r["floor"] for r in made})


def predict(docs: DataFrame, model: Centroids, keep: list[str]) -> DataFrame:
    """``keep`` columns plus lang_pred, score and rejected."""
    read = list(dict.fromkeys([*keep, "text"]))
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()),
                          T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches):
        for b in batches:
            lang, score, far = model.predict(b.column(read.index("text")).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(read.index(c)) for c in keep] + [pa.array(lang, pa.string()), pa.array(score), pa.array(far)],
                                             names=[*keep, "lang_pred", "score", "rejected"])

    return docs.select(*[F.col(f"`{c}`") for c in read]).mapInArrow(run, schema)
