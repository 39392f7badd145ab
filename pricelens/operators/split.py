"""Splits and resampling (SP1-SP8).

All assignments are pure functions of the row key (``functions.portable``):
no ``rand``, ``randomSplit`` or ``monotonically_increasing_id``, so a retried
task or a different partitioning gives identical splits.

Exact-size selections ("the first k rows in hash order") never use a global
window (which would pull every row into one task). ``first_k_threshold`` finds
the k-th smallest (hash, key) with two bounded histogram aggregations instead:
the top 16 bits first (<= 65,536 groups), then the full hash inside one top
bucket (<= 65,536 groups); only hash ties at the threshold are ordered by key.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.portable import fold, hash_int, unit


@dataclass(frozen=True)
class Threshold:
    """Rows with (score, key) <= (score_t, key_t) form the first k rows."""

    k: int
    score: int | None      # None: k == 0 (select nothing)
    key: str | None        # largest admitted key among rows with score == score_t; None: all ties admitted

    def mask(self, score: Column, key: Column) -> Column:
        if self.score is None:
            return F.lit(False)
        tie = score == F.lit(self.score)
        if self.key is not None:
            tie = tie & (key.cast("string") <= F.lit(self.key))
        return (score < F.lit(self.score)) | tie


def _cumulative_cross(rows: list[tuple[int, int]], k: int) -> tuple[int, int]:
    """(value, count before value) for the value where the running count reaches k."""
    acc = 0
    for value, cnt in sorted(rows):
        if acc + cnt >= k:
            return value, acc
        acc += cnt
    raise ValueError("k exceeds row count")


def first_k_thresholds(df: DataFrame, score: Column, key: Column, ks: list[int]) -> list[Threshold]:
    """Exact thresholds for the k smallest rows by (score, key), for several k at once.

    score must lie in [0, 2^32). Two bounded histogram passes serve every k:
    counts per top-16-bit bucket, then counts per full score inside the
    buckets that contain a boundary. Hash ties at a boundary (a handful of
    rows) are ordered by key in a third, tiny pass.
    """
    scored = df.select(score.alias("_s"), key.cast("string").alias("_k"))
    top = scored.groupBy(F.shiftright(F.col("_s"), 16).alias("_b")).count().collect()  # <= 65,536 rows
    total = sum(r["count"] for r in top)
    tops = [(r["_b"], r["count"]) for r in top]
    plan = {}
    for k in ks:
        if 0 < k < total:
            plan[k] = _cumulative_cross(tops, k)
    buckets = sorted({b for b, _ in plan.values()})
    inner_rows = []
    if buckets:
        inner_rows = (scored.filter(F.shiftright(F.col("_s"), 16).isin(buckets))
                      .groupBy("_s").count().collect())  # <= 65,536 rows per boundary bucket
    by_bucket: dict[int, list[tuple[int, int]]] = {}
    for r in inner_rows:
        by_bucket.setdefault(r["_s"] >> 16, []).append((r["_s"], r["count"]))
    out = []
    for k in ks:
        if k <= 0:
            out.append(Threshold(0, None, None))
            continue
        if k >= total:
            out.append(Threshold(total, (1 << 32) - 1, None))
            continue
        bucket, before = plan[k]
        rows = by_bucket[bucket]
        value, before2 = _cumulative_cross(rows, k - before)
        need = k - before - before2
        ties = dict(rows)[value]
        if need == ties:
            out.append(Threshold(k, int(value), None))
        else:
            keys = scored.filter(F.col("_s") == value).select("_k").orderBy("_k").limit(need).collect()
            out.append(Threshold(k, int(value), keys[-1]["_k"]))
    return out


def first_k_threshold(df: DataFrame, score: Column, key: Column, k: int) -> Threshold:
    """Exact threshold for the k smallest rows by (score, key); score in [0, 2^32)."""
    return first_k_thresholds(df, score, key, [k])[0]


# -- SP1 / SP3 ------------------------------------------------------------------
def hash_split(df: DataFrame, key: str, frac: float, seed: int, label: str = "split",
               test_name: str = "holdout", train_name: str = "dev") -> DataFrame:
    """Approximate-fraction split: test iff U(seed, key) < frac (SP1, SP3)."""
    return df.withColumn(label, F.when(unit(seed, F.col(key)) < F.lit(frac), test_name).otherwise(train_name))


def exact_split(df: DataFrame, key: str, seed: int, *, frac: float | None = None, n_test: int | None = None,
                label: str = "split", test_name: str = "holdout", train_name: str = "dev") -> DataFrame:
    """Exact-size split: the first round(frac*n) (or n_test) rows in (hash, key) order are test."""
    h = hash_int(seed, F.col(key))
    if n_test is None:
        n = df.count()
        n_test = int(round(frac * n))
    t = first_k_threshold(df, h, F.col(key), n_test)
    return df.withColumn(label, F.when(t.mask(h, F.col(key)), test_name).otherwise(train_name))


def make_dev_holdout(df: DataFrame, key: str = "ID", frac: float = 0.2, seed: int = 42) -> DataFrame:
    """SP1: deterministic, disjoint and complete dev/holdout labelling."""
    return hash_split(df, key, frac, seed)


def load_dev_holdout(df: DataFrame, key: str = "ID", target: str = "price", frac: float = 0.2, seed: int = 42):
    """IO3: (X_dev, y_dev, X_hold, y_hold) as four DataFrames that all carry the key."""
    s = make_dev_holdout(df, key, frac, seed)
    dev, hold = s.filter(F.col("split") == "dev").drop("split"), s.filter(F.col("split") == "holdout").drop("split")
    return dev.drop(target), dev.select(key, target), hold.drop(target), hold.select(key, target)


# -- SP2 ------------------------------------------------------------------------
def assign_folds(df: DataFrame, key: str = "ID", k: int = 5, seed: int = 42, repeats: int = 1) -> DataFrame:
    """SP2: add ``repeat`` and ``fold``; repeat r uses seed + r (rows x repeats)."""
    if repeats == 1:
        return df.withColumn("repeat", F.lit(0)).withColumn("fold", fold(seed, F.col(key), k))
    out = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    return out.withColumn("fold", fold(F.lit(seed) + F.col("repeat"), F.col(key), k))


# -- SP4 ------------------------------------------------------------------------
def half_split(df: DataFrame, key: str = "ID", seed: int = 0) -> DataFrame:
    """SP4: exact halves (first round(n/2) rows in hash order are half 'A')."""
    return exact_split(df, key, seed, frac=0.5, label="half", test_name="A", train_name="B")


# -- SP5 ------------------------------------------------------------------------
def sample_rows(df: DataFrame, n: int, key: str = "ID", seed: int = 42) -> DataFrame:
    """SP5: n rows without replacement (all rows if n >= count), by the exact hash threshold at every n."""
    h = hash_int(seed, F.col(key))
    t = first_k_threshold(df, h, F.col(key), n)
    return df.filter(t.mask(h, F.col(key)))


# -- SP6 ------------------------------------------------------------------------
def nested_prefixes(df: DataFrame, sizes: list[int], n_val: int, key: str = "ID", seed: int = 42) -> DataFrame:
    """SP6: fixed validation block (first n_val rows in hash order) and nested training prefixes.

    Adds ``role`` ('val' or 'pool') and ``min_size``: the smallest training size
    whose prefix contains the row (NULL when the row is in no prefix). Training
    set for size s = rows with min_size <= s. One threshold per boundary.
    """
    h = hash_int(seed, F.col(key))
    kc = F.col(key)
    order = sorted(sizes, reverse=True)
    ts = first_k_thresholds(df, h, kc, [n_val] + [n_val + s for s in order])
    role = F.when(ts[0].mask(h, kc), "val").otherwise("pool")
    size_expr = F.lit(None).cast("int")
    for s, t in zip(order, ts[1:]):
        size_expr = F.when(t.mask(h, kc), F.lit(s)).otherwise(size_expr)
    return df.withColumn("role", role).withColumn("min_size", F.when(role == "pool", size_expr))


# -- SP8 ------------------------------------------------------------------------
def head(df: DataFrame, n: int, order: str = "ID") -> DataFrame:
    return df.orderBy(F.col(order).asc()).limit(n)


def tail(df: DataFrame, n: int, order: str = "ID") -> DataFrame:
    return df.orderBy(F.col(order).desc()).limit(n)
