"""Error diagnostics (QB1, DG1-DG10).

Input is a prediction frame with ``y`` and ``pred`` (plus feature columns for
segment screens). Global order statistics (quantile edges, the k-th largest
squared error) come from ``functions.selection`` (bounded histogram passes),
never from a global window or an all-rows sort.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.selection import exact_quantiles, kth_largest
from ..functions.stats import adjusted_skew

# ----------------------------------------------------------------------------
# QB1: pandas-style qcut
# ----------------------------------------------------------------------------
def qcut_edges(df: DataFrame, col: Column, q: int = 10) -> list[float]:
    """Quantile edges by linear interpolation, duplicates dropped (sorted); never rounded."""
    edges = exact_quantiles(df, col, [i / q for i in range(q + 1)])
    return sorted({e for e in edges if e is not None})


def qcut_label(col: Column, edges: list[float]) -> Column:
    """0-based label = number of interior edges strictly below the value (right-closed bins)."""
    interior = edges[1:-1]
    if not interior:
        return F.when(col.isNotNull(), F.lit(0))
    expr = F.lit(0)
    for e in interior:
        expr = expr + F.when(col > F.lit(e), 1).otherwise(0)
    return F.when(col.isNotNull(), expr)


def qcut(df: DataFrame, col: str, q: int = 10, out: str = "bin") -> DataFrame:
    edges = qcut_edges(df, F.col(col), q)
    return df.withColumn(out, qcut_label(F.col(col), edges))


# ----------------------------------------------------------------------------
# DG1: error concentration
# ----------------------------------------------------------------------------
def error_concentration(df: DataFrame, quantiles=(0.001, 0.01, 0.05, 0.10), y: str = "y", p: str = "pred") -> DataFrame:
    """Share of squared error held by the worst k = max(1, round_half_even(q n)) rows.

    rmse_excluding_them divides by the full n. The k-th largest error comes
    from exact selection; ties at the threshold are counted by value.
    """
    e2 = F.pow(F.col(y) - F.col(p), 2)
    d = df.select(e2.alias("_e"))
    n = d.count()
    ks = {q: max(1, int(round(q * n))) for q in quantiles}  # Python round is half-to-even (T11)
    thr, _ = kth_largest(d, F.col("_e"), sorted(set(ks.values())))
    aggs = [F.sum("_e").alias("_tot")]
    for q, k in ks.items():
        t = thr[k]
        aggs += [F.sum(F.when(F.col("_e") > t, F.col("_e")).otherwise(0.0)).alias(f"_s{k}"),
                 F.count_if(F.col("_e") > t).alias(f"_c{k}")]
    row = d.agg(*aggs)
    outs = []
    for q, k in ks.items():
        top = F.col(f"_s{k}") + (F.lit(k) - F.col(f"_c{k}")) * F.lit(thr[k])
        outs.append(F.struct(F.lit(q).alias("top_fraction"), F.lit(k).cast("long").alias("n_rows"),
                             (top / F.col("_tot")).alias("share_of_squared_error"),
                             F.sqrt(F.greatest(F.col("_tot") - top, F.lit(0.0)) / F.lit(float(n))).alias("rmse_excluding_them")))
    return row.select(F.explode(F.array(*outs)).alias("_r")).select("_r.*")


# ----------------------------------------------------------------------------
# DG2 / DG3: decile tables
# ----------------------------------------------------------------------------
def residual_by_decile(df: DataFrame, y: str = "y", p: str = "pred") -> DataFrame:
    """DG2: deciles of the true target: n, y mean, pred mean, bias, RMSE."""
    b = qcut(df, y, 10, "decile")
    err = F.col(y) - F.col(p)
    return b.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("y_mean"), F.avg(p).alias("pred_mean"),
                                   F.avg(err).alias("bias"), F.sqrt(F.avg(err * err)).alias("rmse"))


def decile_table(df: DataFrame, value: str = "pred", y: str = "y", p: str = "pred") -> DataFrame:
    """DG3: deciles of ``value`` (calibration): n, level, bias, resid_sd (ddof=1), rmse."""
    b = qcut(df, value, 10, "decile")
    err = F.col(y) - F.col(p)
    return b.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("level"), F.avg(err).alias("bias"),
                                   F.stddev_samp(err).alias("resid_sd"), F.sqrt(F.avg(err * err)).alias("rmse"))


def noise_shape(deciles: DataFrame) -> DataFrame:
    """DG4: constant (sd = a) vs proportional (sd = b * level) noise over the decile table."""
    s = deciles.agg(F.avg("resid_sd").alias("a"),
                    (F.sum(F.col("resid_sd") * F.col("level")) / F.sum(F.col("level") * F.col("level"))).alias("b"))
    j = deciles.select("resid_sd", "level", s.select("a").scalar().alias("a"), s.select("b").scalar().alias("b"))
    out = j.agg(F.first("a").alias("a"), F.first("b").alias("b"),
                F.sum(F.pow(F.col("resid_sd") - F.col("a"), 2)).alias("sse_const"),
                F.sum(F.pow(F.col("resid_sd") - F.col("b") * F.col("level"), 2)).alias("sse_prop"))
    return out.withColumn("winner", F.when(F.col("sse_prop") < F.col("sse_const"), "PROPORTIONAL").otherwise("CONSTANT"))


def residual_moments(df: DataFrame, y: str = "y", p: str = "pred") -> DataFrame:
    """DG5: relative (r / max(pred, 1)) and absolute residual: sd (population), mean, adjusted skew."""
    r = F.col(y) - F.col(p)
    rel = r / F.greatest(F.col(p), F.lit(1.0))
    d = df.select(r.alias("r"), rel.alias("rel"))
    return d.agg(F.stddev_pop("rel").alias("rel_sd"), F.avg("rel").alias("rel_mean"), adjusted_skew(F.col("rel")).alias("rel_skew"),
                 F.stddev_pop("r").alias("abs_sd"), F.avg("r").alias("abs_mean"), adjusted_skew(F.col("r")).alias("abs_skew"))


def rmse_floor(df: DataFrame, b: Column, y: str = "y", p: str = "pred") -> DataFrame:
    """DG6: implied floor sqrt(mean((b y)^2)) if noise is proportional, vs the actual RMSE."""
    return df.agg(F.sqrt(F.avg(F.pow(b * F.col(y), 2))).alias("floor_rmse"),
                  F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), 2))).alias("model_rmse"))


def worst_rows(df: DataFrame, k: int = 15, cols: list[str] | None = None, key: str = "ID",
               y: str = "y", p: str = "pred") -> DataFrame:
    """DG7: the k rows with the largest |residual| (TakeOrderedAndProject), rounded to 1 dp."""
    r = F.col(y) - F.col(p)
    d = df.select(key, F.col(y).alias("price"), F.round(F.col(p), 1).alias("pred"), F.round(r, 1).alias("residual"),
                  F.abs(r).alias("_a"), *(cols or []))
    return d.orderBy(F.col("_a").desc(), F.col(key)).limit(k).drop("_a")


def segment_lift(df: DataFrame, cols: list[str], top: int = 4, y: str = "y", p: str = "pred") -> DataFrame:
    """DG8: share of each level among rows above P99 |r| divided by its overall share; top levels per column."""
    a = F.abs(F.col(y) - F.col(p))
    d = df.select(a.alias("_a"), *cols)
    thr = exact_quantiles(d, F.col("_a"), [0.99])[0]
    from ..operators.encode import long_values
    lv = long_values(d.withColumn("_big", F.col("_a") > F.lit(thr)), cols, key="_big")
    g = lv.groupBy("col_name", "value").agg(F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("_big")).alias("n_big"))
    tot = lv.groupBy("col_name").agg(F.count(F.lit(1)).alias("t_all"), F.count_if(F.col("_big")).alias("t_big"))
    j = g.join(tot, "col_name").filter(F.col("n_big") > 0)
    j = j.withColumn("lift", (F.col("n_big") / F.col("t_big")) / (F.col("n_all") / F.col("t_all")))
    from pyspark.sql import Window
    w = Window.partitionBy("col_name").orderBy(F.col("lift").desc(), F.col("value"))
    return j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).select("col_name", "value", "lift", "rank")


def interaction_screen(df: DataFrame, pairs: list[tuple[str, str]], r: str = "r") -> DataFrame:
    """DG9: per pair, 1 - var_pop(r - cell mean) / var_pop(r), number of cells, smallest cell.

    Cell sums for every pair come from one aggregation over a long view
    (row x pair); within-cell SSE = sum r^2 - (sum r)^2 / n per cell.
    """
    arr = F.array(*[F.struct(F.lit(f"{a}|{b}").alias("pair"),
                             F.concat_ws("|", F.coalesce(F.col(a).cast("string"), F.lit("NA")),
                                         F.coalesce(F.col(b).cast("string"), F.lit("NA"))).alias("cell")) for a, b in pairs])
    lv = df.select(F.col(r).alias("_r"), F.explode(arr).alias("_p")).select("_r", "_p.pair", "_p.cell")
    cells = lv.groupBy("pair", "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("_r").alias("s"), F.sum(F.col("_r") * F.col("_r")).alias("q"))
    per = cells.groupBy("pair").agg(
        F.sum("n").alias("N"), F.sum("s").alias("S"), F.sum("q").alias("Q"),
        F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("sse_within"),
        F.count(F.lit(1)).alias("cells"), F.min("n").alias("min_cell"))
    var_r = F.col("Q") / F.col("N") - F.pow(F.col("S") / F.col("N"), 2)
    return per.select("pair", (F.lit(1.0) - (F.col("sse_within") / F.col("N")) / var_r).alias("explained"),
                      "cells", "min_cell")


def accuracy_gate(pred: DataFrame, dev_mean: Column, lo: float = 100.0, hi: float = 20000.0,
                  y: str = "y", p: str = "pred") -> DataFrame:
    """DG10: holdout RMSE < 0.6 x RMSE of the dev-mean baseline, and predictions inside (lo, hi)."""
    return pred.agg(
        F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), 2))).alias("holdout_rmse"),
        F.sqrt(F.avg(F.pow(F.col(y) - dev_mean, 2))).alias("baseline_rmse"),
        F.count(F.lit(1)).alias("n"),
        F.bool_and((F.col(p) > lo) & (F.col(p) < hi)).alias("plausible"),
    ).withColumn("beats_baseline", F.col("holdout_rmse") < F.lit(0.6) * F.col("baseline_rmse"))
