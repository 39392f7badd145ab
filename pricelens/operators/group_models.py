"""Closed-form additive models fitted by grouped aggregation (MD1, MD2, MD4, MD17, MD19).

These models are sums of per-level effects, so fitting them is a handful of
``groupBy`` aggregations (map-side combined: the shuffle carries one row per
model x level per partition) and scoring is an equi-join on (model id, level).

Many models are fitted at once: every row of the training view carries the
model-id columns (``mid``), e.g. (repeat, f) for k-fold CV, where a row sits in
the training set of every fold except its own. One aggregation then fits all
folds together instead of k separate jobs.

Model tables grow with the number of levels, which is data dependent: a fit writes
them once and counts them. Up to ``BROADCAST_ROWS`` rows they are broadcast, so that
scoring moves no row; beyond that the join is a shuffle join (with skew splitting).
Without that AQE would learn a table's size only after the rows had been shuffled.
Intercept tables, whose size is the number of models, are always broadcast.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.selection import quantiles_by
from ..session import written

BROADCAST_ROWS = 100_000    # rows of a model table (ids, level, effect) that are sent to every task, a few MB


# ----------------------------------------------------------------------------
# Views: which rows train / score which model
# ----------------------------------------------------------------------------
def cv_train_view(folded: DataFrame, k: int) -> DataFrame:
    """Training rows per fold model: each row joins the k-1 models of the other folds."""
    return (folded.withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            .filter(F.col("f") != F.col("fold")))


def cv_score_view(folded: DataFrame, k: int, roles=("train", "val")) -> DataFrame:
    """Scoring rows per fold model with role 'val' (own fold) or 'train' (other folds)."""
    if tuple(roles) == ("val",):
        return folded.withColumn("f", F.col("fold")).withColumn("role", F.lit("val"))
    out = (folded.withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
           .withColumn("role", F.when(F.col("f") == F.col("fold"), "val").otherwise("train")))
    return out if set(roles) == {"train", "val"} else out.filter(F.col("role").isin(list(roles)))


# ----------------------------------------------------------------------------
# Models
# ----------------------------------------------------------------------------
@dataclass
class GroupModel:
    """A fitted additive model: intercept per model id + effect tables per level column."""

    mid: list[str]
    intercept: DataFrame                      # mid..., b
    effects: dict[str, DataFrame] = field(default_factory=dict)  # level -> (mid..., level, e_<level>)

    def predict(self, rows: DataFrame, out: str = "pred") -> DataFrame:
        res = rows.join(F.broadcast(self.intercept), self.mid, "left")  # size = number of models
        total = F.col("_b")
        for lvl, tab in self.effects.items():
            ecol = f"e_{lvl}"
            res = res.join(tab, self.mid + [lvl], "left")
            total = total + F.coalesce(F.col(ecol), F.lit(0.0))
        keep = [c for c in rows.columns]
        return res.select(*keep, total.alias(out))


def settled(table: DataFrame, name: str) -> DataFrame:
    """A model table computed once; small enough, it is broadcast by every join with it."""
    table = written(table, name)
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def cells_of(train: DataFrame, mid: list[str], levels: list[str], target: str) -> DataFrame:
    """One row per model and combination of levels: _n rows with target sum _s. All fits below run on it."""
    return train.groupBy(*mid, *levels).agg(F.count(F.lit(1)).alias("_n"), F.sum(target).alias("_s"))


def cv_cells(folded: DataFrame, k: int, levels: list[str], target: str) -> DataFrame:
    """Cells of every fold model (repeat, f): rows are summed once per fold, and only those sums are repeated
    for the k - 1 models that train on the fold."""
    own = folded.groupBy("repeat", "fold", *levels).agg(F.count(F.lit(1)).alias("_n"), F.sum(target).alias("_s"))
    each = own.withColumn("f", F.explode(F.sequence(F.lit(0), F.lit(k - 1)))).filter(F.col("f") != F.col("fold"))
    return each.groupBy("repeat", "f", *levels).agg(F.sum("_n").alias("_n"), F.sum("_s").alias("_s"))


def fit_mean(train: DataFrame, mid: list[str], target: str) -> GroupModel:
    """MD1: DummyRegressor('mean')."""
    return mean_from_cells(cells_of(train, mid, [], target), mid)


def mean_from_cells(cells: DataFrame, mid: list[str]) -> GroupModel:
    return GroupModel(mid, settled(cells.groupBy(*mid).agg((F.sum("_s") / F.sum("_n")).alias("_b")), "intercept"))


def fit_median(train: DataFrame, mid: list[str], target: str) -> GroupModel:
    """MD2: DummyRegressor('median'): exact median, middle pair averaged (T2), by bounded selection passes."""
    return GroupModel(mid, settled(quantiles_by(train, mid, target, [0.5]).withColumnRenamed("q0", "_b"), "intercept"))


def fit_one_factor_ridge(train: DataFrame, mid: list[str], target: str, level: str, alpha: float) -> GroupModel:
    """MD4 + EN6 on one text column: closed-form ridge with an unpenalised intercept.

    w_l = n_l / (n_l + alpha); b = sum w_l ybar_l / sum w_l; effect_l = w_l (ybar_l - b).
    """
    return one_factor_from_cells(cells_of(train, mid, [level], target), mid, level, alpha)


def one_factor_from_cells(cells: DataFrame, mid: list[str], level: str, alpha: float) -> GroupModel:
    cells = written(cells.withColumn("ybar", F.col("_s") / F.col("_n"))
                    .withColumn("w", F.col("_n") / (F.col("_n") + F.lit(float(alpha)))), "cells")
    b = settled(cells.groupBy(*mid).agg((F.sum(F.col("w") * F.col("ybar")) / F.sum("w")).alias("_b")), "intercept")
    eff = (cells.join(F.broadcast(b), mid)
           .select(*mid, level, (F.col("w") * (F.col("ybar") - F.col("_b"))).alias(f"e_{level}")))
    return GroupModel(mid, b, {level: settled(eff, "effects")})


def fit_backfit(train: DataFrame, mid: list[str], target: str, levels: list[str], lam: float,
                sweeps: int = 3) -> GroupModel:
    """MD17 re-aimed: cyclic backfitting of a one-feature-per-term additive model.

    Intercept fixed at the training mean; each step refits one feature's level
    effects on the partial residual, shrunk as sum(r) / (n + lam). Additive by
    construction.
    """
    return backfit_from_cells(cells_of(train, mid, levels, target), mid, levels, lam, sweeps)


def backfit_from_cells(cells: DataFrame, mid: list[str], levels: list[str], lam: float, sweeps: int = 3) -> GroupModel:
    """Backfitting on the sums per combination of levels: the data are read once, however many sweeps run.

    Every new effect table (model ids x levels rows) is written below spark.checkpoint.dir, which cuts it from
    its lineage, so the plan stays the same size.
    """
    cells = written(cells, "cells")
    b = settled(cells.groupBy(*mid).agg((F.sum("_s") / F.sum("_n")).alias("_b")), "intercept")
    base = cells.join(F.broadcast(b), mid)      # one row per model
    effects: dict[str, DataFrame] = {}
    for _ in range(sweeps):
        for lvl in levels:
            rows, fitted = base, F.col("_b")
            for o in levels:
                if o != lvl and o in effects:
                    rows = rows.join(effects[o], mid + [o], "left")
                    fitted = fitted + F.coalesce(F.col(f"e_{o}"), F.lit(0.0))
            tab = (rows.groupBy(*mid, lvl)
                   .agg((F.sum(F.col("_s") - F.col("_n") * fitted) / (F.sum("_n") + F.lit(float(lam)))).alias(f"e_{lvl}")))
            effects[lvl] = settled(tab, "effects")
    return GroupModel(mid, b, effects)


def fit_log_group_mean(train: DataFrame, mid: list[str], target: str, level: str) -> tuple[GroupModel, DataFrame]:
    """MD19 helper: group means of log(y) plus the Duan smearing factor per model.

    smear = mean(exp(log y - fit)) over training rows; prediction = exp(fit) * smear.
    """
    logged = train.withColumn("_ly", F.log(F.col(target)))
    cells = settled(logged.groupBy(*mid, level).agg(F.avg("_ly").alias(f"e_{level}")), "effects")
    model = GroupModel(mid, settled(cells.select(*mid, F.lit(0.0).alias("_b")).distinct(), "intercept"), {level: cells})
    fitted = model.predict(logged, "_fit")
    smear = settled(fitted.groupBy(*mid).agg(F.avg(F.exp(F.col("_ly") - F.col("_fit"))).alias("smear")), "smear")
    return model, smear


def predict_smeared(model: GroupModel, smear: DataFrame, rows: DataFrame, out: str = "pred") -> DataFrame:
    p = model.predict(rows, "_logpred").join(F.broadcast(smear), model.mid)
    return p.withColumn(out, F.exp("_logpred") * F.col("smear")).drop("_logpred", "smear")


def fit_closed_form(spec: dict, train: DataFrame, mid: list[str], target: str) -> GroupModel:
    """Dispatch on a spec dict: {'kind': 'mean'|'median'|'ridge1'|'backfit', ...}."""
    if spec["kind"] == "median":
        return fit_median(train, mid, target)
    return fit_from_cells(spec, cells_of(train, mid, spec_levels(spec), target), mid)


def fit_closed_form_cv(spec: dict, folded: DataFrame, k: int, target: str) -> GroupModel:
    """All fold models (repeat, f) of a spec from one pass over the folded rows."""
    if spec["kind"] == "median":
        return fit_median(cv_train_view(folded, k), ["repeat", "f"], target)
    return fit_from_cells(spec, cv_cells(folded, k, spec_levels(spec), target), ["repeat", "f"])


def spec_levels(spec: dict) -> list[str]:
    return [spec["level"]] if spec.get("level") else list(spec.get("levels", []))


def fit_from_cells(spec: dict, cells: DataFrame, mid: list[str]) -> GroupModel:
    kind = spec["kind"]
    if kind == "mean":
        return mean_from_cells(cells, mid)
    if kind == "ridge1":
        return one_factor_from_cells(cells, mid, spec["level"], spec.get("alpha", 1.0))
    if kind == "backfit":
        return backfit_from_cells(cells, mid, spec["levels"], spec.get("lam", 1.0), spec.get("sweeps", 3))
    raise ValueError(f"no closed form for model kind {kind!r}")
