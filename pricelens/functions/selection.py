"""Exact order statistics without a global sort, a global window or a buffer of distinct values.

0. The wanted columns are written once, so that no pass repeats the work behind them.
1. One aggregation per call gives, for every column, the count, the range and an
   approximate bracket of each wanted quantile (``percentile_approx``, whose rank
   error is bounded by n / ACCURACY).
2. One pass counts the values below each bracket and keeps the values inside
   (about 4 n / ACCURACY per quantile); only those are persisted.
3. Histogram passes over the kept values narrow each interval to the bucket that
   holds the rank, until a single value is left. Buckets are equal in value
   inside an interval of one sign and modest ratio, equal in logarithm over a
   wide one, and an interval across zero is first cut by sign; so the number of
   passes is bounded by the width of a double (at most about eight), at any n.

At most one row per open rank reaches the driver per pass. A bracket that misses
its rank (it cannot, by the error bound) falls back to the full range.

Quantiles interpolate linearly: pos = p (n - 1); lo + (hi - lo) * frac.
"""
from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

BUCKETS = 4096
ACCURACY = 10_000
WIDE = 4096.0


def _bucket(x: Column, lo: Column, hi: Column) -> Column:
    """Bucket number of x in [lo, hi], growing with x."""
    linear = F.floor((x - lo) / ((hi - lo) / F.lit(BUCKETS)))
    sign = F.signum(x) + 1
    small, large = F.least(F.abs(lo), F.abs(hi)), F.greatest(F.abs(lo), F.abs(hi))
    logs = F.floor((F.log2(F.abs(x)) - F.log2(small)) / ((F.log2(large) - F.log2(small)) / F.lit(BUCKETS)))
    signed = F.when(lo > 0, logs).otherwise(F.lit(BUCKETS) - logs)
    inf = F.lit(float("inf"))
    ends = F.when(x == inf, BUCKETS).when(x == -inf, 0).otherwise(1)
    raw = F.when((hi == inf) | (lo == -inf), ends).when((lo < 0) & (hi > 0), sign).when((small > 0) & (large / small > WIDE), signed).otherwise(linear)
    return F.greatest(F.lit(0), F.least(raw, F.lit(BUCKETS))).cast("int")


def _refine(long: DataFrame, open_: dict) -> dict:
    """{(group, rank): value} for {(group, rank): (lo, hi, rank within [lo, hi])}; ``long``: _g, _x."""
    found = {}
    while True:
        for key, (lo, hi, _r) in list(open_.items()):
            if lo == hi:
                found[key] = lo
                del open_[key]
        if not open_:
            return found
        ids = sorted(open_, key=str)
        # one row per open rank (bounded by the ranks asked for): broadcast, joined on the group
        iv = long.sparkSession.createDataFrame([(i, key[0], float(open_[key][0]), float(open_[key][1]), int(open_[key][2]))
                                                for i, key in enumerate(ids)], "t int, _g string, lo double, hi double, r long")
        j = long.join(F.broadcast(iv), "_g").filter((F.col("_x") >= F.col("lo")) & (F.col("_x") <= F.col("hi")))
        hist = (j.groupBy("t", "r", _bucket(F.col("_x"), F.col("lo"), F.col("hi")).alias("b"))
                .agg(F.count(F.lit(1)).alias("c"), F.min("_x").alias("mn"), F.max("_x").alias("mx")))
        cum = F.sum("c").over(Window.partitionBy("t").orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
        hit = (hist.withColumn("cum", cum)
               .filter((F.col("cum") >= F.col("r")) & (F.col("cum") - F.col("c") < F.col("r"))).collect())  # one row per open rank
        for h in hit:
            key = ids[h["t"]]
            open_[key] = (h["mn"], h["mx"], open_[key][2] - (h["cum"] - h["c"]))


def _ranks(df: DataFrame, cols: dict[str, Column], wanted) -> tuple[dict, dict]:
    """Values at 1-based ranks. ``wanted(n)`` gives the ranks for a column of n values; returns ({(col, rank): value}, {col: n})."""
    src = written(df.select(*[F.when(~F.isnan(c.cast("double")), c.cast("double")).alias(f"_{i}") for i, c in enumerate(cols.values())]), "selection")
    first = src.agg(*[a for i in range(len(cols)) for a in (F.count(f"_{i}").alias(f"n{i}"), F.min(f"_{i}").alias(f"lo{i}"),
                                                            F.max(f"_{i}").alias(f"hi{i}"))]).first()
    names, size, open_ = list(cols), {}, {}
    for i, name in enumerate(names):
        size[name] = first[f"n{i}"]
        for k in wanted(size[name]) if size[name] else []:
            open_[(name, k)] = (i, first[f"lo{i}"], first[f"hi{i}"])
    if not open_:
        return {}, size
    edge = lambda k, n, d: min(1.0, max(0.0, (k - 0.5) / n + d * 2.0 / ACCURACY))
    probes = {}
    for (name, k), (i, _, _) in open_.items():
        probes.setdefault(i, []).extend([edge(k, size[name], -1), edge(k, size[name], 1)])
    got = src.agg(*[F.percentile_approx(f"_{i}", sorted(set(ps)), ACCURACY).alias(f"q{i}") for i, ps in probes.items()]).first()
    value = {i: dict(zip(sorted(set(ps)), got[f"q{i}"])) for i, ps in probes.items()}
    span = {}
    for (name, k), (i, lo, hi) in open_.items():
        a, b = value[i][edge(k, size[name], -1)], value[i][edge(k, size[name], 1)]
        # ranks near the ends lie outside an interior bracket's guarantee: open it to the extreme
        span[(name, k)] = (lo if k <= 4 * size[name] / ACCURACY + 1 else a, hi if k >= size[name] * (1 - 4 / ACCURACY) else b)
    order = list(span)
    x = lambda key: F.col(f"_{open_[key][0]}")
    below = src.agg(*[F.count_if(x(key) < F.lit(span[key][0])).alias(f"c{j}") for j, key in enumerate(order)],
                    *[F.count_if((x(key) >= F.lit(span[key][0])) & (x(key) <= F.lit(span[key][1]))).alias(f"d{j}") for j, key in enumerate(order)]).first()
    inside: dict[int, Column] = {}
    todo = {}
    for j, key in enumerate(order):
        lo, hi = span[key]
        c, d = below[f"c{j}"], below[f"d{j}"]
        if not c < key[1] <= c + d:
            lo, hi, c = open_[key][1], open_[key][2], 0
        todo[key] = (lo, hi, key[1] - c)
        if lo < hi:
            cond = (x(key) >= F.lit(lo)) & (x(key) <= F.lit(hi))
            i = open_[key][0]
            inside[i] = inside[i] | cond if i in inside else cond
    cells = [F.when(cond, F.struct(F.lit(names[i]).alias("_g"), F.col(f"_{i}").alias("_x"))) for i, cond in inside.items()]
    if not cells:
        return _refine(src, todo), size
    long = (src.select(F.explode(F.filter(F.array(*cells), lambda s: s.isNotNull())).alias("_p")).select("_p._g", "_p._x")
            .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        return _refine(long, todo), size
    finally:
        long.unpersist()


def kth_smallest(df: DataFrame, col: Column, ks: list[int]) -> tuple[dict[int, float], int]:
    """Exact k-th smallest non-null values (1-based k) and the non-null count n."""
    found, size = _ranks(df, {"x": col}, lambda n: sorted({k for k in ks if 1 <= k <= n}))
    return {k: found.get(("x", k)) for k in ks}, size["x"]


def kth_largest(df: DataFrame, col: Column, ks: list[int]) -> tuple[dict[int, float], int]:
    """Exact k-th largest values (1-based)."""
    found, size = _ranks(df, {"x": col}, lambda n: sorted({n - k + 1 for k in ks if 1 <= k <= n}))
    n = size["x"]
    return {k: found.get(("x", n - k + 1)) for k in ks}, n


def grouped_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns at once: every pass serves every (column, rank)."""
    at = lambda n: [(int(math.floor(p * (n - 1))) + 1, int(math.ceil(p * (n - 1))) + 1) for p in probs]
    found, size = _ranks(df, {c: F.col(f"`{c}`") for c in cols}, lambda n: sorted({k for pair in at(n) for k in pair}))
    out: dict[str, list[float | None]] = {}
    for c in cols:
        n = size[c]
        vals: list[float | None] = [None] * len(probs)
        for j, p in enumerate(probs if n else []):
            pos = p * (n - 1)
            lo, hi = (found[(c, k)] for k in at(n)[j])
            vals[j] = lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos))
        out[c] = vals
    return out


def quantiles_by(df: DataFrame, by: list[str], target: str, probs: list[float], block: int | None = None) -> DataFrame:
    """One row per group of ``by``: q0, q1, ..., for any number of groups in the same passes; no key reaches the driver.

    A bracket per group and probability comes from one aggregation (``percentile_approx`` in groups of more than
    ``ACCURACY`` values, the whole range in smaller ones); a second pass counts the values below each bracket and keeps those
    inside, about 8 n / ACCURACY of a large group, whose distinct values are then ranked. ``block``, once the number of groups
    of a pass, is still accepted and has no effect.
    """
    x = F.col(target).cast("double")
    rows = written(df.select(*by, F.when(~F.isnan(x), x).alias("_x")), "selection-groups")
    edge = 4.0 / ACCURACY
    grid = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-edge, edge)})
    stats = rows.groupBy(*by).agg(F.count("_x").alias("_n"), F.min("_x").alias("_min"), F.max("_x").alias("_max"),
                                  F.percentile_approx("_x", grid, ACCURACY).alias("_q"))
    brackets = []
    for j, p in enumerate(probs):
        low, high = (F.col("_q")[grid.index(min(1.0, max(0.0, p + d)))] for d in (-edge, edge))
        small = F.col("_n") <= ACCURACY
        pos = F.lit(p) * (F.col("_n") - 1)
        brackets.append(F.struct(F.lit(j).alias("j"), F.when(small | F.lit(p <= edge), F.col("_min")).otherwise(low).alias("lo"),
                                 F.when(small | F.lit(p >= 1 - edge), F.col("_max")).otherwise(high).alias("hi"),
                                 (F.floor(pos) + 1).alias("k1"), (F.ceil(pos) + 1).alias("k2"), (pos - F.floor(pos)).alias("part")))
    keys = [F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]
    names = [f"_g{i}" for i in range(len(by))]
    stats = written(stats.select(*keys, "_n", F.array(*brackets).alias("_b")), "selection-brackets")
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names)]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    # per value: whether it lies below a bracket (only counted) or inside (kept); values above go before the shuffle
    each = rows.filter("_x IS NOT NULL").join(stats.select(*names, "_b"), cond).select(*names, "_x", F.explode("_b").alias("b")).filter(F.col("_x") <= F.col("b.hi"))
    cell = F.when(F.col("_x") >= F.col("b.lo"), F.col("_x"))
    counts = each.groupBy(*names, F.col("b.j").alias("j"), cell.alias("v")).agg(F.count(F.lit(1)).alias("c"), F.first("b").alias("b"))
    upto = F.sum("c").over(Window.partitionBy(*names, "j").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("upto", upto).filter(F.col("v").isNotNull())
    hit = lambda k: (F.col("upto") >= F.col(f"b.{k}")) & (F.col("upto") - F.col("c") < F.col(f"b.{k}"))
    found = ranked.groupBy(*names, "j").agg(F.max(F.when(hit("k1"), F.col("v"))).alias("a"), F.max(F.when(hit("k2"), F.col("v"))).alias("z"),
                                            F.first("b.part").alias("part"))
    value = F.when(F.col("a") == F.col("z"), F.col("a")).otherwise(F.col("a") + (F.col("z") - F.col("a")) * F.col("part"))
    wide = found.groupBy(*names).agg(*[F.max(F.when(F.col("j") == j, value)).alias(f"q{j}") for j in range(len(probs))])
    wide = wide.select(*[F.col(n).alias(f"_r{i}") for i, n in enumerate(names)], *[f"q{j}" for j in range(len(probs))])
    back = [F.col(n).eqNullSafe(F.col(f"_r{i}")) for i, n in enumerate(names)]
    cond = back[0]
    for c in back[1:]:
        cond = cond & c
    return stats.join(wide, cond, "left").select(*[F.col(n).alias(c) for n, c in zip(names, by)], *[f"q{j}" for j in range(len(probs))])


def exact_quantiles(df: DataFrame, col: Column | str, probs: list[float]) -> list[float | None]:
    """Linear-interpolation quantiles of one column."""
    col = F.col(col) if isinstance(col, str) else col
    return grouped_quantiles(df.select(col.alias("_q")), ["_q"], probs)["_q"]
