"""Dataset audit (AU1-AU12): profile, duplicates, key audit, rank correlation,
describe, histograms, between-group variance ratios, cross-tabs, box stats.

All are aggregations; multi-column statistics run over a long (column, value)
view so one grouped aggregation serves every column, and per-value tables (not
rows) feed the few windows (rank tables are windows over *distinct values*).
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import distinct_ranks
from ..functions.selection import exact_quantiles, quantiles_by
from ..session import written
from ..functions.stats import adjusted_skew
from .encode import long_values


def column_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """AU1: (col_name, dtype, n_missing, n_distinct, pct_unique) per column."""
    cols = cols or df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    n = df.count()
    lv = long_values(df, cols)
    per_value = lv.groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("c"))
    prof = per_value.groupBy("col_name").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("c")).otherwise(0)).cast("long").alias("n_missing"),
        F.count_if(F.col("value").isNotNull()).alias("n_distinct"))
    dtype = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return prof.select("col_name", dtype[F.col("col_name")].alias("dtype"), "n_missing", "n_distinct",
                       (F.col("n_distinct") / F.lit(float(n)) * 100.0).alias("pct_unique"))


def duplicate_counts(df: DataFrame, key: str = "ID", target: str = "price") -> DataFrame:
    """AU2: duplicated rows (rows - distinct rows) over all columns, ignoring the key, features only."""
    def dups(cols, name):
        g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))
        return g.agg(F.lit(name).alias("scope"), F.sum(F.col("_c") - 1).cast("long").alias("duplicates"))
    allc = df.columns
    no_id = [c for c in allc if c != key]
    feats = [c for c in no_id if c != target]
    return dups(allc, "full_row").unionByName(dups(no_id, "ignoring_id")).unionByName(dups(feats, "features_only"))


def key_audit(df: DataFrame, key: str = "ID") -> DataFrame:
    """AU3: key uniqueness, min, max, total missing cells."""
    miss = sum((F.col(c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    return df.agg((F.count_distinct(key) == F.count(F.lit(1))).alias("key_unique"), F.min(key).alias("key_min"),
                  F.max(key).alias("key_max"), F.sum(miss).alias("missing_cells"))


def _centred(counts: DataFrame, value: str, out: str) -> DataFrame:
    """``counts`` plus ``out``: the value's average rank less the mean rank of its column, which is (n + 1) / 2."""
    total = counts.groupBy("col_name").agg(F.sum("c").alias("_n"))
    ranked = distinct_ranks(counts, value).drop("place")
    rank = F.col("below") + (F.col("c") + 1) / 2.0 - (F.col("_n") + 1) / 2.0
    return ranked.join(F.broadcast(total), "col_name").withColumn(out, rank).drop("below", "_n")     # one row per column


def spearman_with_target(df: DataFrame, cols: list[str], target: str = "price") -> DataFrame:
    """AU4: Spearman rho(x, target) per numeric column (pairwise-complete rows, average ranks on ties).

    Each row gets its target's rank once; after that a column needs only, for each of its values, the number of its
    rows and the sum of their target ranks, so x values are grouped, never joined. Only columns with missing values
    rank the target again among their own rows.
    """
    narrow = written(df.select(F.col(target).cast("double").alias("_y"), *[F.col(c).cast("double").alias(c) for c in cols])
                     .filter(F.col("_y").isNotNull()), "au4")
    holes = narrow.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    full, own = [c for c in cols if not holes[c]], [c for c in cols if holes[c]]
    cells = lambda names: F.explode(F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).alias("v")) for c in names])).alias("p")
    each = None
    if full:
        y = narrow.groupBy("_y").agg(F.count(F.lit(1)).alias("c")).withColumn("col_name", F.lit(""))
        ry = written(_centred(y, "_y", "ry"), "au4-y").select("_y", "ry")
        each = narrow.join(ry, "_y").select("ry", cells(full)).select("ry", "p.*")
    if own:
        some = narrow.select("_y", cells(own)).select("_y", "p.*").filter(F.col("v").isNotNull())
        y = some.groupBy("col_name", "_y").agg(F.count(F.lit(1)).alias("c"))
        ry = written(_centred(y, "_y", "ry"), "au4-own-y").select("col_name", "_y", "ry")
        some = some.join(ry, ["col_name", "_y"]).select("ry", "col_name", "v")
        each = some if each is None else each.unionByName(some)
    x = each.groupBy("col_name", "v").agg(F.count(F.lit(1)).alias("c"), F.sum("ry").alias("s"), F.sum(F.col("ry") * F.col("ry")).alias("q"))
    x = _centred(x, "v", "rx")
    xy, xx, yy = F.sum(F.col("rx") * F.col("s")), F.sum(F.col("c") * F.col("rx") * F.col("rx")), F.sum("q")
    out = x.groupBy("col_name").agg(xy.alias("xy"), xx.alias("xx"), yy.alias("yy"))
    rho = F.when((F.col("xx") > 0) & (F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx")) / F.sqrt(F.col("yy")))
    return out.select("col_name", rho.alias("rho")).withColumn("abs_rho", F.abs("rho"))


def describe(df: DataFrame, col: str, percentiles=(0.01, 0.25, 0.5, 0.75, 0.95, 0.99)) -> DataFrame:
    """AU6: count, mean, std (ddof=1), min, custom percentiles (exact), max, adjusted skew."""
    qs = exact_quantiles(df, F.col(col), list(percentiles))
    base = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                  F.min(col).cast("double").alias("min"), F.max(col).cast("double").alias("max"),
                  adjusted_skew(F.col(col).cast("double")).alias("skew"))
    return base.select("*", *[F.lit(q).alias(f"p{int(round(p * 100)):02d}") for p, q in zip(percentiles, qs)])


def histogram(df: DataFrame, col: Column, bins: int = 80, name: str = "x") -> DataFrame:
    """AU7: equal-width histogram data (bin, lo, hi, n); the max lands in the last bin."""
    v = df.select(col.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    mn, mx = v.agg(F.min("_v"), F.max("_v")).first()
    width = (mx - mn) / bins if mx > mn else 1.0
    b = F.least(F.floor((F.col("_v") - F.lit(mn)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    g = v.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.lit(name).alias("series"), "bin", (F.lit(mn) + F.col("bin") * F.lit(width)).alias("lo"),
                    (F.lit(mn) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "n")


def variance_ratio(df: DataFrame, cols: list[str], target: str = "price") -> DataFrame:
    """AU8: between-group variance vs what a random grouping of the same size would explain."""
    tot = df.agg(F.count(F.lit(1)).alias("N"), F.avg(target).alias("m"), F.var_samp(target).alias("v"))
    lv = df.select(F.col(target).alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(c).cast("string").alias("value")) for c in cols])).alias("_p"))
    g = lv.select("_y", "_p.*").groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("ym"))
    N, m, v = tot.select("N").scalar(), tot.select("m").scalar(), tot.select("v").scalar()
    per = g.groupBy("col_name").agg(F.count(F.lit(1)).alias("n_levels"),
                                    (F.sum(F.col("n") * F.pow(F.col("ym") - m, 2)) / N).alias("between_var"))
    per = per.withColumn("expected_if_noise", v * (F.col("n_levels") - 1) / N)
    return per.withColumn("ratio", F.col("between_var") / F.col("expected_if_noise"))


def conditional_variance_ratio(df: DataFrame, col: str, cond: str, target: str = "price") -> DataFrame:
    """AU9: AU8 on y minus its ``cond``-group mean, grouping by (cond, col) cells."""
    # group means by aggregation + join (a window over a hot group would sit in one task)
    means = df.groupBy(cond).agg(F.avg(target).alias("_gm"))
    r = df.select(cond, col, target).join(means, cond).select(cond, col, (F.col(target) - F.col("_gm")).alias("_r"))
    cells = r.withColumn("_cell", F.concat_ws("|", F.col(cond).cast("string"), F.col(col).cast("string")))
    out = variance_ratio(cells.select("_cell", "_r"), ["_cell"], "_r")
    return out.withColumn("col_name", F.lit(f"{col}|{cond}"))


def crosstab(df: DataFrame, cat: str, flag: str, values=(0, 1)) -> DataFrame:
    """AU10: category x boolean counts, missing combinations 0."""
    p = df.groupBy(cat).pivot(flag, list(values)).count()
    return p.select(cat, *[F.coalesce(F.col(str(v)), F.lit(0)).cast("long").alias(f"n_{v}") for v in values])


def box_stats(df: DataFrame, level: str, target: str = "price") -> DataFrame:
    """AU11: per level q1, median, q3 (exact), whiskers = extreme values within 1.5 IQR fences."""
    q = quantiles_by(df, [level], target, [0.25, 0.5, 0.75]).toDF(level, "q1", "median", "q3")     # one row per level
    q = df.groupBy(level).agg(F.count(F.lit(1)).alias("n")).join(q, level)
    q = q.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).withColumn("_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    j = df.select(level, F.col(target).alias("_y")).join(q.select(level, "_lo", "_hi"), level)
    wsk = j.groupBy(level).agg(F.min(F.when(F.col("_y") >= F.col("_lo"), F.col("_y"))).alias("whisker_lo"),
                               F.max(F.when(F.col("_y") <= F.col("_hi"), F.col("_y"))).alias("whisker_hi"))
    return q.drop("_lo", "_hi").join(wsk, level)


def split_sanity(df: DataFrame, split: str = "split", target: str = "price") -> DataFrame:
    """AU12: rows and mean target per split."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean_target"),
                                 F.stddev_samp(target).alias("sd_target"))


__all__ = ["column_profile", "duplicate_counts", "key_audit", "spearman_with_target", "describe", "histogram",
           "variance_ratio", "conditional_variance_ratio", "crosstab", "box_stats", "split_sanity"]
