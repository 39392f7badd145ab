"""Metrics and cross-validation (ME1-ME3, CV1-CV6).

The central object is the *prediction table*, a long DataFrame
``(key, repeat, fold, role, y, pred)`` with role 'train' or 'val'. Every CV
statistic is SQL over it, so the same reductions serve closed-form models
(fitted for all folds in one aggregation) and ``pyspark.ml`` estimators
(fitted per fold from a small driver thread pool).
"""
from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .group_models import cv_score_view, fit_closed_form_cv, spec_levels
from .split import assign_folds
from .stages import predictions

PRED_COLS = ["repeat", "fold", "role", "y", "pred"]


# ----------------------------------------------------------------------------
# ME1-ME3
# ----------------------------------------------------------------------------
def rmse_expr(y: str = "y", p: str = "pred") -> Column:
    return F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), 2)))


def mae_expr(y: str = "y", p: str = "pred") -> Column:
    return F.avg(F.abs(F.col(y) - F.col(p)))


def metrics(df: DataFrame, y: str = "y", p: str = "pred", by: list[str] | None = None) -> DataFrame:
    """ME1/ME2 (optionally grouped): n, rmse, mae."""
    aggs = [F.count(F.lit(1)).alias("n"), rmse_expr(y, p).alias("rmse"), mae_expr(y, p).alias("mae")]
    return df.groupBy(*(by or [])).agg(*aggs)


def train_val_gap(df: DataFrame, role: str = "role", y: str = "y", p: str = "pred") -> DataFrame:
    """ME3: one row with train/val RMSE and gap = val - train."""
    m = df.groupBy().agg(
        F.sqrt(F.avg(F.when(F.col(role) == "train", F.pow(F.col(y) - F.col(p), 2)))).alias("train_rmse"),
        F.sqrt(F.avg(F.when(F.col(role) == "val", F.pow(F.col(y) - F.col(p), 2)))).alias("val_rmse"),
    )
    return m.withColumn("gap", F.col("val_rmse") - F.col("train_rmse"))


# ----------------------------------------------------------------------------
# Prediction tables
# ----------------------------------------------------------------------------
def cv_predictions_closed(df: DataFrame, spec: dict, key: str = "ID", target: str = "price", k: int = 5,
                          seed: int = 42, repeats: int = 1, roles=("train", "val"),
                          carry: list[str] | None = None) -> DataFrame:
    """Prediction table of a closed-form model: all folds fitted by one aggregation.

    ``carry`` columns ride along to the output (no join back to the source).
    """
    need = {spec.get("level")} | set(spec.get("levels", [])) - {None}
    levels = sorted(c for c in need if c)
    extra = [c for c in (carry or []) if c not in levels]
    folded = assign_folds(df.select(key, target, *levels, *extra), key, k, seed, repeats)
    return cv_predictions_folded(folded, spec, target, k, roles, [key, *(carry or [])]).select(key, *PRED_COLS, *(carry or []))


def cv_predictions_folded(folded: DataFrame, spec: dict, target: str = "price", k: int = 5, roles=("train", "val"),
                          carry: list[str] | None = None) -> DataFrame:
    """``cv_predictions_closed`` for rows that have their ``repeat`` and ``fold`` already: no key is needed."""
    scored = fit_closed_form_cv(spec, folded, k, target).predict(cv_score_view(folded, k, roles), "pred")
    return scored.select("repeat", F.col("f").alias("fold"), "role", F.col(target).alias("y"), "pred", *(carry or []))


def cv_predictions_members(df: DataFrame, specs: dict[str, dict], weights: dict[str, float], key: str = "ID", target: str = "price", k: int = 5,
                           seed: int = 42, repeats: int = 1, roles=("train", "val")) -> DataFrame:
    """Long prediction table (model, key, repeat, fold, role, y, pred) of several closed-form models and of their ``blend`` by
    fixed weights. Rows are folded and scored once, member after member on the same row, so the blend joins nothing."""
    levels = sorted({c for spec in specs.values() for c in [spec.get("level"), *spec.get("levels", [])] if c})
    folded = assign_folds(df.select(key, target, *levels), key, k, seed, repeats)
    rows = cv_score_view(folded, k, roles)
    for name, spec in specs.items():
        kept = list(rows.columns)
        rows = fit_closed_form_cv(spec, folded, k, target).predict(rows, f"_p_{name}").select(*kept, f"_p_{name}")
    blend = sum((F.lit(float(w)) * F.col(f"_p_{n}") for n, w in weights.items()), F.lit(0.0))
    cells = [F.struct(F.lit(n).alias("model"), F.col(f"_p_{n}").alias("pred")) for n in specs]
    each = F.explode(F.array(*cells, F.struct(F.lit("blend").alias("model"), blend.alias("pred")))).alias("_m")
    return rows.select(key, "repeat", F.col("f").alias("fold"), "role", F.col(target).alias("y"), each).select(
        "_m.model", key, "repeat", "fold", "role", "y", "_m.pred")


def oof_members(df: DataFrame, specs: dict[str, dict], key: str = "ID", target: str = "price", k: int = 5, seed: int = 42) -> DataFrame:
    """Wide out-of-fold table (key, y, one column per member) of closed-form models, written once: members score the same
    row one after the other, so one grouping by the key stands for one per member and their join. Rows without a finite
    target or member are dropped."""
    levels = sorted({c for spec in specs.values() for c in spec_levels(spec)})
    folded = assign_folds(df.select(key, target, *levels), key, k, seed)
    rows = cv_score_view(folded, k, ("val",))
    for name, spec in specs.items():
        kept = list(rows.columns)
        rows = fit_closed_form_cv(spec, folded, k, target).predict(rows, f"_p_{name}").select(*kept, f"_p_{name}")
    wide = rows.groupBy(key).agg(*[F.avg(f"_p_{n}").alias(n) for n in specs], F.first(target).alias("y"))
    ok = F.lit(True)
    for c in [*specs, "y"]:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(F.col(c))
    return written(wide.filter(ok), "oof-members")


def blend_folds_members(df: DataFrame, specs: dict[str, dict], weights: dict[str, float], key: str = "ID", target: str = "price", k: int = 5,
                        seed: int = 42) -> DataFrame:
    """BL7 for closed-form members: (key, repeat, fold, role, y, pred) of the blend under every fold model. Rows that share
    a key are added up once, as one row with a sum per fold model, before they are repeated for the models."""
    levels = sorted({c for spec in specs.values() for c in spec_levels(spec)})
    rows = assign_folds(df.select(key, target, *levels), key, k, seed)
    folded, blend = rows, [F.lit(0.0)] * k
    for name, spec in specs.items():
        model = fit_closed_form_cv(spec, folded, k, target)
        for f in range(k):
            kept = [c for c in rows.columns]
            rows = model.predict(rows.withColumn("f", F.lit(f)), f"_p{f}_{name}").select(*kept, f"_p{f}_{name}")
            blend[f] = blend[f] + F.lit(float(weights[name])) * F.col(f"_p{f}_{name}")
    keyed = rows.select(key, "repeat", F.col("fold").alias("_own"), F.col(target).alias("_y"), *[b.alias(f"_b{f}") for f, b in enumerate(blend)])
    keyed = keyed.groupBy(key, "repeat", "_own").agg(F.first("_y").alias("y"), *[F.sum(f"_b{f}").alias(f"_b{f}") for f in range(k)])
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("fold"), F.col(f"_b{f}").alias("pred")) for f in range(k)])).alias("_m")
    role = F.when(F.col("_m.fold") == F.col("_own"), "val").otherwise("train")
    return keyed.select(key, "repeat", "_own", "y", each).select(key, "repeat", "_m.fold", role.alias("role"), "y", "_m.pred")


def cv_predictions_estimator(df: DataFrame, make_estimator: Callable[[], object], key: str = "ID",
                             target: str = "price", k: int = 5, seed: int = 42, repeats: int = 1,
                             prediction_col: str = "prediction", threads: int = 4,
                             roles=("train", "val")) -> DataFrame:
    """Prediction table of any estimator with ``fit(df).transform(df)``; one fit per fold.

    Fits run from a small thread pool (each fit is itself a set of distributed
    Spark jobs and keeps its own training rows while it runs). The result is
    the union of per-fold scorings.
    """
    folded = assign_folds(df, key, k, seed, repeats)
    jobs = [(r, f) for r in range(repeats) for f in range(k)]
    first = make_estimator()
    shared = first.folds_of(folded, [key, "repeat", "fold", target]) if getattr(first, "shares_features", False) and prediction_col == "prediction" else None

    def one(job):
        r, f = job
        if shared:
            fit, rows = shared
            rep = rows.filter(F.col("repeat") == r)
            scored = predictions(fit((F.col("repeat") == r) & (F.col("fold") != f)), rep, engineered=True)
        else:
            rep = folded.filter(F.col("repeat") == r)
            model = make_estimator().fit(rep.filter(F.col("fold") != f))
            scored = model.transform(rep)
        role = F.when(F.col("fold") == f, "val").otherwise("train")
        out = scored.select(key, F.lit(r).alias("repeat"), F.lit(f).alias("fold"), role.alias("role"),
                            F.col(target).cast("double").alias("y"), F.col(prediction_col).cast("double").alias("pred"))
        return out.filter(F.col("role").isin(list(roles)))

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        parts = list(pool.map(one, jobs))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ----------------------------------------------------------------------------
# CV1-CV6
# ----------------------------------------------------------------------------
def fold_metrics(preds: DataFrame) -> DataFrame:
    """Per (repeat, fold, role): n, rmse, mae."""
    return metrics(preds, by=["repeat", "fold", "role"])


def cv_summary(preds: DataFrame, model: str = "model") -> DataFrame:
    """CV1: mean train/val RMSE and MAE over folds, val sd (ddof=1, 0 for one fold), gap."""
    fm = fold_metrics(preds)
    val, tr = F.col("role") == "val", F.col("role") == "train"
    s = fm.groupBy().agg(
        F.count(F.when(val, 1)).alias("n_folds"),
        F.avg(F.when(tr, F.col("rmse"))).alias("train_rmse"),
        F.avg(F.when(val, F.col("rmse"))).alias("val_rmse"),
        F.avg(F.when(tr, F.col("mae"))).alias("train_mae"),
        F.avg(F.when(val, F.col("mae"))).alias("val_mae"),
        F.coalesce(F.stddev_samp(F.when(val, F.col("rmse"))), F.lit(0.0)).alias("val_rmse_std"),
    )
    return s.select(F.lit(model).alias("model"), "*").withColumn("gap", F.col("val_rmse") - F.col("train_rmse"))


def oof_predictions(preds: DataFrame, key: str = "ID") -> DataFrame:
    """CV2: out-of-fold prediction per row = mean over repeats of its validation predictions."""
    v = preds.filter(F.col("role") == "val")
    return v.groupBy(key).agg(F.first("y").alias("y"), F.avg("pred").alias("oof"), F.count(F.lit(1)).alias("n_pred"))


def pooled_vs_fold_mean(preds: DataFrame, key: str = "ID") -> DataFrame:
    """CV3: the pooled OOF RMSE and the mean of per-fold RMSEs (two different statistics)."""
    oof = oof_predictions(preds, key)
    pooled = oof.agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("oof"), 2))).alias("pooled_oof_rmse"))
    fm = fold_metrics(preds.filter(F.col("role") == "val")).agg(F.avg("rmse"))
    return pooled.select("pooled_oof_rmse", fm.scalar().alias("fold_mean_rmse"))


def paired_difference(cand: DataFrame, ref: DataFrame, label: str = "candidate") -> DataFrame:
    """CV4 + CV5: per-fold validation RMSE differences of a candidate vs a reference.

    Both inputs are prediction tables over the same folds. Output: mean, sd
    (ddof=1), se = sd/sqrt(k), significant = |mean| > 2 se, verdict
    ('HELPS' / 'hurts' / 'no effect'), wins = folds where the candidate is better.
    """
    def val_rmse(p, name):
        return (fold_metrics(p.filter(F.col("role") == "val"))
                .select("repeat", "fold", F.col("rmse").alias(name)))

    d = val_rmse(cand, "c").join(val_rmse(ref, "r"), ["repeat", "fold"]).withColumn("diff", F.col("c") - F.col("r"))
    s = d.groupBy().agg(
        F.count(F.lit(1)).alias("k"),
        F.avg("diff").alias("mean_diff"),
        F.stddev_samp("diff").alias("sd_diff"),
        F.count_if(F.col("diff") < 0).alias("wins"),
    )
    se = F.col("sd_diff") / F.sqrt(F.col("k").cast("double"))
    return (s.withColumn("se", se)
            .withColumn("significant", F.abs(F.col("mean_diff")) > F.lit(2.0) * F.col("se"))
            .withColumn("verdict", F.when(F.col("mean_diff") < -2.0 * F.col("se"), "HELPS")
                        .when(F.col("mean_diff") > 2.0 * F.col("se"), "hurts").otherwise("no effect"))
            .select(F.lit(label).alias("candidate"), "*"))


def fold_table(preds_by_seed: DataFrame) -> DataFrame:
    """CV6: metrics per model, seed, repeat, fold and role; as small as that, written once for all summaries."""
    return written(metrics(preds_by_seed, by=["model", "seed", "repeat", "fold", "role"]), "cv6")


def seed_table(preds_by_seed: DataFrame, seeds: list[int]) -> DataFrame:
    """CV6: one row per model, its mean validation RMSE under each seed as ``seed_<seed>``."""
    v = fold_table(preds_by_seed).filter(F.col("role") == "val")
    wide = v.groupBy("model").pivot("seed", seeds).agg(F.avg("rmse"))
    return wide.select("model", *[F.col(str(s)).alias(f"seed_{s}") for s in seeds])


def robustness_summary(preds_by_seed: DataFrame) -> DataFrame:
    """CV6: per model over seeds x folds (input: prediction tables with ``model`` and ``seed``).

    mean_rmse, sd_across_folds, sd_across_seed_means, worst/best seed mean,
    mean_train_rmse, mean_gap, mean_val_mae.
    """
    fm = fold_table(preds_by_seed)
    v = fm.filter(F.col("role") == "val")
    t = fm.filter(F.col("role") == "train")
    per_seed = v.groupBy("model", "seed").agg(F.avg("rmse").alias("seed_mean"))
    a = v.groupBy("model").agg(F.avg("rmse").alias("mean_rmse"), F.stddev_samp("rmse").alias("sd_across_folds"),
                               F.avg("mae").alias("mean_val_mae"))
    b = per_seed.groupBy("model").agg(F.stddev_samp("seed_mean").alias("sd_across_seed_means"),
                                      F.max("seed_mean").alias("worst_seed"), F.min("seed_mean").alias("best_seed"))
    c = t.groupBy("model").agg(F.avg("rmse").alias("mean_train_rmse"))
    out = a.join(b, "model").join(c, "model")
    return out.withColumn("mean_gap", F.col("mean_rmse") - F.col("mean_train_rmse"))


def timed(fn, *args, **kwargs):
    """Run fn and return (result, elapsed seconds); elapsed is a volatile column (T17)."""
    t0 = time.perf_counter()
    res = fn(*args, **kwargs)
    return res, time.perf_counter() - t0
