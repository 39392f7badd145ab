"""Registered queries: quantile bins and error diagnostics (QB1, DG1-DG10).

The diagnosed predictions are the out-of-fold predictions of the one-factor
ridge (5 hash folds), rounded to 6 dp in both engines before binning.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cv
from ..operators import diagnostics as dg
from ..operators.group_models import fit_closed_form
from ..operators.split import make_dev_holdout
from ..sources.tables import device_rows, fold_rows
from ..functions.portable import unit_sql
from .q_models import RIDGE1
from .registry import query, rounded, sql_round
from .sqlgen import closed_form_preds_ctes, with_ctes

FEATS = ["gpu_model", "device_type", "brand", "os", "form_factor"]


def diag_base(spark, sf_dir, *carry):
    """The diagnosed predictions with the columns ``carry`` of their rows: what a query doesn't read is neither shuffled nor written."""
    rows = fold_rows(spark, sf_dir, *dict.fromkeys(["price", RIDGE1["level"], *carry]))
    p = cv.cv_predictions_folded(rows, RIDGE1, roles=("val",), carry=list(carry))
    return p.select("y", F.round("pred", 6).alias("pred"), *carry)


DIAG_CTES = [
    closed_form_preds_ctes(RIDGE1),
    "diag AS (SELECT p.ID, p.y, round(p.pred, 6) AS pred, " + ", ".join(f"d.{c}" for c in FEATS) +
    " FROM preds p JOIN device d ON d.ID = p.ID WHERE p.role = 'val')",
]


def edges_sql(col: str, src: str = "diag") -> str:
    probs = ", ".join(repr(i / 10) for i in range(11))
    return (f"(SELECT list_sort(list_distinct(quantile_cont({col}, [{probs}]))) "
            f"FROM {src})")


def label_sql(col: str, edges: str) -> str:
    return f"CAST(len(list_filter({edges}[2:len({edges}) - 1], lambda e: {col} > e)) AS INTEGER)"


@query("qb1_qcut_bins", sql_round(with_ctes(
    "SELECT decile, count(*) AS n, min(pred) AS lo, max(pred) AS hi FROM "
    f"(SELECT pred, {label_sql('pred', 'ed.e')} AS decile FROM diag CROSS JOIN (SELECT {edges_sql('pred')} AS e) ed) "
    "GROUP BY decile", *DIAG_CTES), ["lo", "hi"]))
def q_qb1(spark, sf_dir):
    b = dg.qcut(diag_base(spark, sf_dir), "pred", 10, "decile")
    return rounded(b.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.min("pred").alias("lo"), F.max("pred").alias("hi")))


@query("dg1_error_concentration", sql_round(with_ctes(
    "SELECT q AS top_fraction, k AS n_rows, sum(e) FILTER (WHERE rn <= k) / any_value(tot) AS share_of_squared_error, "
    "sqrt(coalesce(sum(e) FILTER (WHERE rn > k), 0) / any_value(n)) AS rmse_excluding_them FROM "
    "(SELECT e, rn, tot, n, q, CAST(greatest(1, round_even(q * n, 0)) AS BIGINT) AS k FROM "
    "(SELECT e, row_number() OVER (ORDER BY e DESC) AS rn, sum(e) OVER () AS tot, count(*) OVER () AS n FROM "
    "(SELECT (y - pred) * (y - pred) AS e FROM diag)) CROSS JOIN (SELECT unnest([0.001, 0.01, 0.05, 0.1]) AS q)) "
    "GROUP BY q, k", *DIAG_CTES), ["share_of_squared_error", "rmse_excluding_them"]))
def q_dg1(spark, sf_dir):
    return rounded(dg.error_concentration(diag_base(spark, sf_dir)))


def _decile_sql(col):
    return (f"SELECT {label_sql(col, 'ed.e')} AS decile, y, pred, y - pred AS err FROM diag "
            f"CROSS JOIN (SELECT {edges_sql(col)} AS e) ed")


@query("dg2_residual_by_decile", sql_round(with_ctes(
    "SELECT decile, count(*) AS n, avg(y) AS y_mean, avg(pred) AS pred_mean, avg(err) AS bias, sqrt(avg(err * err)) AS rmse "
    f"FROM ({_decile_sql('y')}) GROUP BY decile", *DIAG_CTES), ["y_mean", "pred_mean", "bias", "rmse"]))
def q_dg2(spark, sf_dir):
    return rounded(dg.residual_by_decile(diag_base(spark, sf_dir)))


DG3_SQL = ("SELECT decile, count(*) AS n, avg(pred) AS level, avg(err) AS bias, stddev_samp(err) AS resid_sd, "
           f"sqrt(avg(err * err)) AS rmse FROM ({_decile_sql('pred')}) GROUP BY decile")


@query("dg3_calibration_deciles", sql_round(with_ctes(DG3_SQL, *DIAG_CTES), ["level", "bias", "resid_sd", "rmse"]))
def q_dg3(spark, sf_dir):
    return rounded(dg.decile_table(diag_base(spark, sf_dir)))


NOISE_SQL = ("SELECT a, b, sum((resid_sd - a) ^ 2) AS sse_const, sum((resid_sd - b * level) ^ 2) AS sse_prop, "
             "CASE WHEN sum((resid_sd - b * level) ^ 2) < sum((resid_sd - a) ^ 2) THEN 'PROPORTIONAL' ELSE 'CONSTANT' END AS winner "
             "FROM t3 CROSS JOIN (SELECT avg(resid_sd) AS a, sum(resid_sd * level) / sum(level * level) AS b FROM t3) GROUP BY a, b")


@query("dg4_noise_shape", sql_round(with_ctes(NOISE_SQL, *DIAG_CTES, f"t3 AS ({DG3_SQL})"), ["a", "b", "sse_const", "sse_prop"]))
def q_dg4(spark, sf_dir):
    return rounded(dg.noise_shape(dg.decile_table(diag_base(spark, sf_dir))))


@query("dg5_residual_moments", sql_round(with_ctes(
    "SELECT stddev_pop(rel) AS rel_sd, avg(rel) AS rel_mean, skewness(rel) AS rel_skew, "
    "stddev_pop(r) AS abs_sd, avg(r) AS abs_mean, skewness(r) AS abs_skew FROM "
    "(SELECT y - pred AS r, (y - pred) / greatest(pred, 1.0) AS rel FROM diag)", *DIAG_CTES),
    ["rel_sd", "rel_mean", "rel_skew", "abs_sd", "abs_mean", "abs_skew"]))
def q_dg5(spark, sf_dir):
    return rounded(dg.residual_moments(diag_base(spark, sf_dir)))


@query("dg6_rmse_floor", sql_round(with_ctes(
    "SELECT sqrt(avg((ns.b * y) ^ 2)) AS floor_rmse, sqrt(avg((y - pred) ^ 2)) AS model_rmse FROM diag "
    "CROSS JOIN (SELECT b FROM (" + NOISE_SQL + ")) ns", *DIAG_CTES, f"t3 AS ({DG3_SQL})"), ["floor_rmse", "model_rmse"]))
def q_dg6(spark, sf_dir):
    d = diag_base(spark, sf_dir)
    b = dg.noise_shape(dg.decile_table(d)).select("b").scalar()
    return rounded(dg.rmse_floor(d, b))


@query("dg7_worst_rows", sql_round(with_ctes(
    "SELECT ID, y AS price, round(pred, 1) AS pred, round(y - pred, 1) AS residual, device_type, brand, gpu_model "
    "FROM diag ORDER BY abs(y - pred) DESC, ID LIMIT 15", *DIAG_CTES), ["price", "pred", "residual"]))
def q_dg7(spark, sf_dir):
    return rounded(dg.worst_rows(diag_base(spark, sf_dir, "ID", "device_type", "brand", "gpu_model"), 15, ["device_type", "brand", "gpu_model"]))


LIFT_COLS = ["device_type", "brand", "os", "form_factor"]


@query("dg8_segment_lift", sql_round(with_ctes(
    "SELECT col_name, value, lift, rank FROM (SELECT col_name, value, lift, CAST(row_number() OVER "
    "(PARTITION BY col_name ORDER BY lift DESC, value) AS INTEGER) AS rank FROM "
    "(SELECT g.col_name, g.value, (g.n_big / t.t_big) / (g.n_all / t.t_all) AS lift FROM "
    "(SELECT col_name, value, count(*) AS n_all, count(*) FILTER (WHERE big) AS n_big FROM lv GROUP BY ALL) g "
    "JOIN (SELECT col_name, count(*) AS t_all, count(*) FILTER (WHERE big) AS t_big FROM lv GROUP BY ALL) t USING (col_name) "
    "WHERE g.n_big > 0)) WHERE rank <= 4", *DIAG_CTES,
    "thr AS (SELECT quantile_cont(abs(y - pred), 0.99) AS t FROM diag)",
    "lv AS (" + " UNION ALL ".join(
        f"SELECT abs(y - pred) > (SELECT t FROM thr) AS big, '{c}' AS col_name, CAST({c} AS VARCHAR) AS value FROM diag"
        for c in LIFT_COLS) + ")"), ["lift"]))
def q_dg8(spark, sf_dir):
    return rounded(dg.segment_lift(diag_base(spark, sf_dir, *LIFT_COLS), LIFT_COLS).withColumn("rank", F.col("rank").cast("int")))


SCREEN_PAIRS = [("gpu_model", "device_type"), ("brand", "os"), ("device_type", "form_factor")]


@query("dg9_interaction_screen", sql_round(with_ctes(" UNION ALL ".join(
    f"SELECT '{a}|{b}' AS pair, 1 - (sum(q - s * s / n) / sum(n)) / (sum(q) / sum(n) - (sum(s) / sum(n)) ^ 2) AS explained, "
    f"count(*) AS cells, min(n) AS min_cell FROM (SELECT {a}, {b}, count(*) AS n, sum(y - pred) AS s, "
    f"sum((y - pred) ^ 2) AS q FROM diag GROUP BY {a}, {b})" for a, b in SCREEN_PAIRS), *DIAG_CTES), ["explained"]))
def q_dg9(spark, sf_dir):
    d = diag_base(spark, sf_dir, *dict.fromkeys(c for pair in SCREEN_PAIRS for c in pair)).withColumn("r", F.col("y") - F.col("pred"))
    return rounded(dg.interaction_screen(d, SCREEN_PAIRS))


@query("dg10_accuracy_gate", sql_round(with_ctes(
    "SELECT sqrt(avg((y - pred) ^ 2)) AS holdout_rmse, sqrt(avg((y - dm) ^ 2)) AS baseline_rmse, count(*) AS n, "
    "bool_and(pred > 100.0 AND pred < 20000.0) AS plausible, "
    "sqrt(avg((y - pred) ^ 2)) < 0.6 * sqrt(avg((y - dm) ^ 2)) AS beats_baseline FROM "
    "(SELECT hs.y, bb.b + coalesce(c.w * (c.ybar - bb.b), 0.0) AS pred, (SELECT avg(y) FROM hs WHERE role = 'dev') AS dm "
    "FROM hs CROSS JOIN bb LEFT JOIN cells c ON c.gpu_model = hs.gpu_model WHERE hs.role = 'holdout')",
    f"hs AS (SELECT ID, price AS y, gpu_model, CASE WHEN {unit_sql(42, 'ID')} < 0.2::DOUBLE THEN 'holdout' ELSE 'dev' END AS role FROM device)",
    "cells AS (SELECT gpu_model, avg(y) ybar, count(*) / (count(*) + 100.0::DOUBLE) w FROM hs WHERE role = 'dev' GROUP BY gpu_model)",
    "bb AS (SELECT sum(w * ybar) / sum(w) AS b FROM cells)"), ["holdout_rmse", "baseline_rmse"]))
def q_dg10(spark, sf_dir):
    d = make_dev_holdout(device_rows(spark, sf_dir, "ID", "gpu_model", "price")).select("ID", "gpu_model", F.col("price").alias("y"),
                                                              F.col("split").alias("role"), F.lit(0).alias("m"))
    dev = d.filter(F.col("role") == "dev")
    model = fit_closed_form(RIDGE1, dev.withColumnRenamed("y", "price"), ["m"], "price")
    hold = model.predict(d.filter(F.col("role") == "holdout"), "pred")
    dev_mean = dev.agg(F.avg("y")).scalar()
    return rounded(dg.accuracy_gate(hold, dev_mean))
