"""Registered queries: closed-form models, cross-validation and metrics (MD, CV, ME)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cv
from ..operators.group_models import fit_closed_form, fit_log_group_mean, predict_smeared, spec_levels
from ..operators.split import make_dev_holdout
from ..sources.tables import device_rows
from .registry import query, rounded, sql_round
from .sqlgen import FOLD_METRICS_SQL, closed_form_preds_ctes, cv_summary_sql, with_ctes
from ..functions.portable import unit_sql

RIDGE1 = {"kind": "ridge1", "level": "gpu_model", "alpha": 100.0}
RIDGE1_B = {"kind": "ridge1", "level": "device_type", "alpha": 10.0}
MEAN = {"kind": "mean"}
MEDIAN = {"kind": "median"}
BACKFIT = {"kind": "backfit", "levels": ["gpu_model", "device_type"], "lam": 5.0, "sweeps": 3}

FM_DOUBLES = ["rmse", "mae"]
SUMMARY_DOUBLES = ["train_rmse", "val_rmse", "train_mae", "val_mae", "val_rmse_std", "gap"]


def _fold_metrics_query(spec, repeats=1):
    def run(spark, sf_dir):
        preds = cv.cv_predictions_closed(device_rows(spark, sf_dir, "ID", "price", *spec_levels(spec)), spec, repeats=repeats)
        return rounded(cv.fold_metrics(preds))
    sql = sql_round(with_ctes(FOLD_METRICS_SQL.format(t="preds"), closed_form_preds_ctes(spec, repeats=repeats)),
                    FM_DOUBLES)
    return run, sql


def _summary_query(spec, model, repeats=1):
    def run(spark, sf_dir):
        preds = cv.cv_predictions_closed(device_rows(spark, sf_dir, "ID", "price", *spec_levels(spec)), spec, repeats=repeats)
        return rounded(cv.cv_summary(preds, model))
    sql = sql_round(with_ctes(cv_summary_sql("preds", model), closed_form_preds_ctes(spec, repeats=repeats)),
                    SUMMARY_DOUBLES)
    return run, sql


# MD4 + CV1 (first slice): one-factor ridge on gpu_model, 5 hash folds, per-fold metrics
_r, _s = _fold_metrics_query(RIDGE1)
query("md4_ridge1_cv_fold_metrics", _s)(_r)

# MD1 / MD2 baselines with CV1 summaries; 2 repeats exercise SP2 repeats
_r, _s = _summary_query(MEAN, "mean", repeats=2)
query("md1_mean_baseline_cv", _s)(_r)
_r, _s = _summary_query(MEDIAN, "median", repeats=1)
query("md2_median_baseline_cv", _s)(_r)
_r, _s = _summary_query(RIDGE1, "ridge1_gpu_model", repeats=2)
query("cv1_ridge1_summary", _s)(_r)

# MD17: additive backfitting over two factors (3 sweeps, unrolled in SQL)
_r, _s = _fold_metrics_query(BACKFIT)
query("md17_backfit_cv_fold_metrics", _s)(_r)


# CV2: OOF mean over 2 repeats per row
@query("cv2_oof_predictions", sql_round(with_ctes(
    "SELECT ID, first(y) AS y, avg(pred) AS oof, count(*) AS n_pred FROM preds WHERE role = 'val' GROUP BY ID",
    closed_form_preds_ctes(RIDGE1, repeats=2)), ["y", "oof"]))
def q_cv2(spark, sf_dir):
    preds = cv.cv_predictions_closed(device_rows(spark, sf_dir, "ID", "price", "gpu_model"), RIDGE1, repeats=2, roles=("val",))
    return rounded(cv.oof_predictions(preds))


# CV3: pooled OOF RMSE vs mean of fold RMSEs
@query("cv3_pooled_vs_fold_mean", sql_round(with_ctes(
    "SELECT (SELECT sqrt(avg((y - oof) * (y - oof))) FROM (SELECT ID, first(y) y, avg(pred) oof FROM preds "
    "WHERE role = 'val' GROUP BY ID)) AS pooled_oof_rmse, "
    "(SELECT avg(rmse) FROM (" + FOLD_METRICS_SQL.format(t="(SELECT * FROM preds WHERE role = 'val')") + ")) AS fold_mean_rmse",
    closed_form_preds_ctes(RIDGE1, repeats=2)), ["pooled_oof_rmse", "fold_mean_rmse"]))
def q_cv3(spark, sf_dir):
    preds = cv.cv_predictions_closed(device_rows(spark, sf_dir, "ID", "price", "gpu_model"), RIDGE1, repeats=2, roles=("val",))
    return rounded(cv.pooled_vs_fold_mean(preds))


# CV4 + CV5: paired per-fold difference, backfit vs one-factor ridge
def _paired_sql():
    a = closed_form_preds_ctes(BACKFIT, prefix="c_")
    b = closed_form_preds_ctes(RIDGE1, prefix="r_")
    body = (
        "SELECT 'backfit' AS candidate, count(*) AS k, avg(diff) AS mean_diff, stddev_samp(diff) AS sd_diff, "
        "CAST(count(CASE WHEN diff < 0 THEN 1 END) AS BIGINT) AS wins, "
        "stddev_samp(diff) / sqrt(count(*)) AS se, "
        "abs(avg(diff)) > 2.0 * stddev_samp(diff) / sqrt(count(*)) AS significant, "
        "CASE WHEN avg(diff) < -2.0 * stddev_samp(diff) / sqrt(count(*)) THEN 'HELPS' "
        "WHEN avg(diff) > 2.0 * stddev_samp(diff) / sqrt(count(*)) THEN 'hurts' ELSE 'no effect' END AS verdict "
        "FROM (SELECT c.repeat, c.fold, c.rmse - r.rmse AS diff FROM "
        f"({FOLD_METRICS_SQL.format(t='c_preds')}) c JOIN ({FOLD_METRICS_SQL.format(t='r_preds')}) r "
        "ON c.repeat = r.repeat AND c.fold = r.fold AND c.role = r.role WHERE c.role = 'val') d")
    return sql_round(with_ctes(body, a, b), ["mean_diff", "sd_diff", "se"])


@query("cv4_paired_difference", _paired_sql())
def q_cv4(spark, sf_dir):
    dev = device_rows(spark, sf_dir, "ID", "price", *BACKFIT["levels"])
    c = cv.cv_predictions_closed(dev, BACKFIT, roles=("val",))
    r = cv.cv_predictions_closed(dev, RIDGE1, roles=("val",))
    return rounded(cv.paired_difference(c, r, "backfit"))


# CV6: multi-seed robustness summary (3 seeds x 5 folds, two models)
SEEDS = (42, 7, 2024)


#: The blend's weights.
BLEND = {"ridge1": 0.3717, "mean": 0.6283}


def _seed_ctes():
    ctes, unions = [], []
    for s in SEEDS:
        for name, spec in (("ridge1", RIDGE1), ("mean", MEAN)):
            p = f"{name}_{s}_"
            ctes.append(closed_form_preds_ctes(spec, seed=s, prefix=p))
            unions.append(f"SELECT '{name}' AS model, {s} AS seed, ID, repeat, fold, role, y, pred FROM {p}preds")
    blend = " + ".join(f"{w}::DOUBLE * max(pred) FILTER (model = '{n}')" for n, w in BLEND.items())
    members = " UNION ALL ".join(unions)
    allp = ("SELECT * FROM members UNION ALL "
            f"SELECT 'blend' AS model, seed, ID, repeat, fold, role, max(y) AS y, {blend} AS pred FROM members GROUP BY seed, ID, repeat, fold, role")
    fm = ("SELECT model, seed, repeat, fold, role, sqrt(avg((y - pred) * (y - pred))) AS rmse, avg(abs(y - pred)) AS mae "
          f"FROM ({allp}) GROUP BY ALL")
    return [*ctes, f"members AS ({members})", f"fm AS ({fm})"]


def _robust_sql():
    body = (
        f"SELECT a.model, mean_rmse, sd_across_folds, mean_val_mae, sd_across_seed_means, worst_seed, best_seed, "
        "mean_train_rmse, mean_rmse - mean_train_rmse AS mean_gap FROM "
        "(SELECT model, avg(rmse) mean_rmse, stddev_samp(rmse) sd_across_folds, avg(mae) mean_val_mae FROM fm WHERE role = 'val' GROUP BY model) a "
        "JOIN (SELECT model, stddev_samp(sm) sd_across_seed_means, max(sm) worst_seed, min(sm) best_seed FROM "
        "(SELECT model, seed, avg(rmse) sm FROM fm WHERE role = 'val' GROUP BY model, seed) GROUP BY model) b ON a.model = b.model "
        "JOIN (SELECT model, avg(rmse) mean_train_rmse FROM fm WHERE role = 'train' GROUP BY model) c ON a.model = c.model")
    return sql_round(with_ctes(body, *_seed_ctes()),
                     ["mean_rmse", "sd_across_folds", "mean_val_mae", "sd_across_seed_means", "worst_seed", "best_seed",
                      "mean_train_rmse", "mean_gap"])


def _by_seed(spark, sf_dir):
    dev, out = device_rows(spark, sf_dir, "ID", "price", "gpu_model"), None
    for s in SEEDS:
        p = cv.cv_predictions_members(dev, {"ridge1": RIDGE1, "mean": MEAN}, BLEND, seed=s).withColumn("seed", F.lit(s))
        out = p if out is None else out.unionByName(p)
    return out


@query("cv6_robustness_summary", _robust_sql())
def q_cv6(spark, sf_dir):
    """Two members and their blend over three seeds and five folds."""
    return rounded(cv.robustness_summary(_by_seed(spark, sf_dir)))


@query("cv6_seed_table", sql_round(with_ctes(
    "SELECT model, " + ", ".join(f"avg(rmse) FILTER (seed = {s}) AS seed_{s}" for s in SEEDS) + " FROM fm WHERE role = 'val' GROUP BY model",
    *_seed_ctes()), [f"seed_{s}" for s in SEEDS]))
def q_cv6_seeds(spark, sf_dir):
    """Mean validation error of the members and their blend under each seed."""
    return rounded(cv.seed_table(_by_seed(spark, sf_dir), list(SEEDS)))


# ME1-ME3 on the holdout: model fitted on dev only, scored on both splits
def _holdout_ctes(spec):
    # dev/holdout split (SP1) then a single model (mid = constant) trained on dev
    from ..functions.portable import unit_sql as u
    split = f"CASE WHEN {u(42, 'ID')} < 0.2::DOUBLE THEN 'holdout' ELSE 'dev' END"
    lv = spec.get("level")
    lsel = f", {lv}" if lv else ""
    ctes = [f"hs AS (SELECT ID, price AS y{lsel}, {split} AS role FROM device)"]
    if spec["kind"] == "ridge1":
        a = float(spec["alpha"])
        ctes += [
            f"cells AS (SELECT {lv}, count(*) n, avg(y) ybar, count(*) / (count(*) + {a!r}::DOUBLE) w FROM hs WHERE role = 'dev' GROUP BY {lv})",
            "bb AS (SELECT sum(w * ybar) / sum(w) AS b FROM cells)",
            f"hp AS (SELECT hs.ID, hs.role, hs.y, bb.b + coalesce(c.w * (c.ybar - bb.b), 0.0) AS pred FROM hs CROSS JOIN bb LEFT JOIN cells c ON c.{lv} = hs.{lv})",
        ]
    return ctes


@query("me_holdout_metrics", sql_round(with_ctes(
    "SELECT role, count(*) AS n, sqrt(avg((y - pred) * (y - pred))) AS rmse, avg(abs(y - pred)) AS mae FROM hp GROUP BY role",
    *_holdout_ctes(RIDGE1)), ["rmse", "mae"]))
def q_me(spark, sf_dir):
    d = make_dev_holdout(device_rows(spark, sf_dir, "ID", "gpu_model", "price")).select("ID", "gpu_model", F.col("price").alias("y"),
                                                              F.col("split").alias("role"), F.lit(0).alias("m"))
    model = fit_closed_form(RIDGE1, d.filter(F.col("role") == "dev").withColumnRenamed("y", "price"), ["m"], "price")
    p = model.predict(d, "pred")
    return rounded(cv.metrics(p, by=["role"]))


@query("me3_train_val_gap", sql_round(with_ctes(
    "SELECT sqrt(avg(CASE WHEN role = 'dev' THEN (y - pred) * (y - pred) END)) AS train_rmse, "
    "sqrt(avg(CASE WHEN role = 'holdout' THEN (y - pred) * (y - pred) END)) AS val_rmse, "
    "sqrt(avg(CASE WHEN role = 'holdout' THEN (y - pred) * (y - pred) END)) - "
    "sqrt(avg(CASE WHEN role = 'dev' THEN (y - pred) * (y - pred) END)) AS gap FROM hp",
    *_holdout_ctes(RIDGE1)), ["train_rmse", "val_rmse", "gap"]))
def q_me3(spark, sf_dir):
    d = make_dev_holdout(device_rows(spark, sf_dir, "ID", "gpu_model", "price")).select("ID", "gpu_model", "price", F.col("split").alias("role"),
                                                              F.lit(0).alias("m"))
    model = fit_closed_form(RIDGE1, d.filter(F.col("role") == "dev"), ["m"], "price")
    p = model.predict(d, "pred").withColumnRenamed("price", "y")
    p = p.withColumn("role", F.when(F.col("role") == "dev", "train").otherwise("val"))
    return rounded(cv.train_val_gap(p))


# MD19: log-space group means with Duan smearing, fitted on dev, metrics per split
@query("md19_log_smearing", sql_round(with_ctes(
    "SELECT role, count(*) AS n, sqrt(avg((y - pred) * (y - pred))) AS rmse, avg(abs(y - pred)) AS mae, "
    "any_value(smear) AS smear FROM (SELECT hs.role, hs.y, exp(c.lm) * s.smear AS pred, s.smear FROM hs "
    "LEFT JOIN cells c ON c.gpu_model = hs.gpu_model CROSS JOIN sm s) GROUP BY role",
    f"hs AS (SELECT ID, price AS y, gpu_model, CASE WHEN {unit_sql(42, 'ID')} < 0.2::DOUBLE THEN 'holdout' ELSE 'dev' END AS role FROM device)",
    "cells AS (SELECT gpu_model, avg(ln(y)) AS lm FROM hs WHERE role = 'dev' GROUP BY gpu_model)",
    "sm AS (SELECT avg(exp(ln(hs.y) - c.lm)) AS smear FROM hs JOIN cells c USING (gpu_model) WHERE role = 'dev')"),
    ["rmse", "mae", "smear"]))
def q_md19(spark, sf_dir):
    d = make_dev_holdout(device_rows(spark, sf_dir, "ID", "gpu_model", "price")).select("ID", "gpu_model", "price", F.col("split").alias("role"),
                                                              F.lit(0).alias("m"))
    model, smear = fit_log_group_mean(d.filter(F.col("role") == "dev"), ["m"], "price", "gpu_model")
    p = predict_smeared(model, smear, d).join(smear, "m").withColumnRenamed("price", "y")
    return rounded(p.groupBy("role").agg(F.count(F.lit(1)).alias("n"), cv.rmse_expr().alias("rmse"),
                                         cv.mae_expr().alias("mae"), F.first("smear").alias("smear")))
