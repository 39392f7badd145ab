"""Blending of out-of-fold predictions (BL1-BL8).

Member predictions live in a long OOF table ``(key, model, y, oof)``. A blend
needs only the k x k Gram matrix of the members (plus X'y, y'y, n), which is
one aggregation over the wide (pivoted) table; every weight search then runs
on that tiny matrix on the driver, and every reported RMSE is recomputed in
Spark from the weights. One Gram pass serves all subsets (BL5).
"""
from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cv import oof_predictions, rmse_expr
from .stages import predictions


def oof_long(preds_by_model: dict[str, DataFrame], key: str = "ID") -> DataFrame:
    """(key, model, y, oof) from prediction tables keyed by model name."""
    out = None
    for name, p in preds_by_model.items():
        o = oof_predictions(p, key).select(key, F.lit(name).alias("model"), "y", "oof")
        out = o if out is None else out.unionByName(o)
    return out


def oof_wide(long: DataFrame, members: list[str], key: str = "ID") -> DataFrame:
    """Pivot to one column per member (explicit values: no extra distinct pass); non-finite rows dropped."""
    j = long.groupBy(key).agg(*[F.max(F.when(F.col("model") == m, F.col("oof"))).alias(m) for m in members], F.max("y").alias("y"))
    ok = F.lit(True)
    for m in members + ["y"]:
        ok = ok & F.col(m).isNotNull() & ~F.isnan(F.col(m))
    return j.filter(ok)


def gram(wide: DataFrame, members: list[str]) -> tuple[np.ndarray, np.ndarray, float, int]:
    """(X'X, X'y, y'y, n) in one aggregation."""
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(F.col("y") * F.col("y")).alias("yy")]
    for i, a in enumerate(members):
        aggs.append(F.sum(F.col(a) * F.col("y")).alias(f"xy{i}"))
        for j in range(i, len(members)):
            aggs.append(F.sum(F.col(a) * F.col(members[j])).alias(f"g{i}_{j}"))
    r = wide.agg(*aggs).first()
    k = len(members)
    G = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            G[i, j] = G[j, i] = r[f"g{i}_{j}"]
    b = np.array([r[f"xy{i}"] for i in range(k)])
    return G, b, float(r["yy"]), int(r["n"])


def _solved(G: np.ndarray, b: np.ndarray, idx: list[int]) -> np.ndarray:
    try:
        return np.linalg.solve(G[np.ix_(idx, idx)], b[idx])
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(G[np.ix_(idx, idx)], b[idx], rcond=None)[0]


def nnls_gram(G: np.ndarray, b: np.ndarray, start: list[int] = ()) -> np.ndarray:
    """Exact NNLS min ||y - Xw||^2, w >= 0, from the Gram matrix by growing and shrinking a set of members in use, for any
    number of members. ``start``: a set to begin with, for instance that of a similar problem."""
    k, w = len(b), np.zeros(len(b))
    used = list(start)
    while used and (ws := _solved(G, b, used)).min() <= 0:      # a feasible point to start from
        used = [i for i, v in zip(used, ws) if v > 0]
    if used:
        w[used] = ws
    limit = 1e-12 * float(np.abs(b).max(initial=0))
    refused: set[int] = set()
    for _ in range(100 * (k + 1)):
        gain = b - G @ w
        gain[[*used, *refused]] = -np.inf
        j = int(gain.argmax()) if k else 0
        if not k or gain[j] <= limit:
            return w
        trial, own = [*used, j], w.copy()
        while trial:
            ws = _solved(G, b, trial)
            if ws.min() > 0:
                break
            # as far towards the solution as all weights stay at or above zero; those that reach it leave
            now = own[trial]
            share = min(o / (o - v) if o > v else 0.0 for o, v in zip(now, ws) if v <= 0)
            own[trial] = now + share * (ws - now)
            left = [i for i, v in zip(trial, ws) if own[i] <= 1e-15 * max(1.0, np.abs(own).max()) and v <= 0]
            own[left] = 0.0
            trial = [i for i in trial if i not in left]
        if j not in trial:      # rounding: it would leave at once
            refused.add(j)
            continue
        refused.clear()
        used, w = trial, np.zeros(k)
        w[used] = ws
    raise RuntimeError("the sets in use did not settle")


def normalise(w: np.ndarray) -> np.ndarray:
    t = w.sum()
    return w / t if t > 0 else np.full(len(w), 1.0 / len(w))


def blended(wide: DataFrame, members: list[str], weights) -> DataFrame:
    pred = sum((F.lit(float(w)) * F.col(m) for m, w in zip(members, weights)), F.lit(0.0))
    return wide.withColumn("pred", pred)


def blend_search(wide: DataFrame, members: list[str]) -> tuple[dict[str, float], DataFrame]:
    """BL1: NNLS weights normalised to sum 1 (uniform if all zero); RMSE with the unrounded weights,
    weights reported rounded to 6 dp afterwards."""
    G, b, _, _ = gram(wide, members)
    w = normalise(nnls_gram(G, b))
    r = blended(wide, members, w).agg(rmse_expr("y", "pred").alias("rmse"))
    return {m: round(float(x), 6) for m, x in zip(members, w)}, r


def average_rmse(wide: DataFrame, members: list[str]) -> DataFrame:
    """BL4: simple average of the members."""
    return blended(wide, members, [1.0 / len(members)] * len(members)).agg(rmse_expr("y", "pred").alias("rmse"))


def subset_search(wide: DataFrame, members: list[str]) -> DataFrame:
    """BL5: every subset of size >= 2, average and NNLS, from one Gram pass; gain vs best single.

    RMSE of weights w from the quadratic form: (y'y - 2 w'b + w'Gw) / n.
    """
    G, b, yy, n = gram(wide, members)
    singles = {m: float(np.sqrt(max(yy - 2 * b[i] + G[i, i], 0.0) / n)) for i, m in enumerate(members)}
    best_single = min(singles.values())
    rows, active = [], {}       # members in use per subset: the start for the subsets with one more
    for size in range(2, len(members) + 1):
        for subset in itertools.combinations(range(len(members)), size):
            idx = list(subset)
            Gs, bs = G[np.ix_(idx, idx)], b[idx]
            fitted = nnls_gram(Gs, bs, [idx.index(i) for i in active.get(subset[:-1], ())])
            active[subset] = tuple(i for i, v in zip(idx, fitted) if v > 0)
            for combiner, w in (("average", np.full(size, 1.0 / size)), ("nnls", normalise(fitted))):
                sse = yy - 2 * w @ bs + w @ Gs @ w
                r = float(np.sqrt(max(sse, 0.0) / n))
                rows.append((combiner, "+".join(members[i] for i in idx), r, float(best_single - r)))
    spark = wide.sparkSession
    return spark.createDataFrame(rows, "combiner string, members string, rmse double, gain_vs_best_single double") \
        .orderBy("rmse")


def honest_blend(wide: DataFrame, members: list[str], half: str = "half") -> DataFrame:
    """BL6: weights fitted on half 'A', scored on half 'B', against the best single member on 'B'."""
    a, bh = wide.filter(F.col(half) == "A"), wide.filter(F.col(half) == "B")
    G, b, yy, n = gram(a, members)
    w = normalise(nnls_gram(G, b))
    blend_b = blended(bh, members, w)
    aggs = [rmse_expr("y", "pred").alias("blend_rmse")] + [rmse_expr("y", m).alias(f"rmse_{m}") for m in members]
    r = blend_b.agg(*aggs)
    best = F.least(*[F.col(f"rmse_{m}") for m in members]) if len(members) > 1 else F.col(f"rmse_{members[0]}")
    return r.select("blend_rmse", best.alias("best_single_rmse"), (best - F.col("blend_rmse")).alias("honest_gain"))


def derived_blend_folds(preds_by_model: dict[str, DataFrame], weights: dict[str, float], key: str = "ID") -> DataFrame:
    """BL7: blend predictions derived from member fold predictions, no refit: sum w * pred per (key, repeat, fold, role)."""
    out = None
    for name, p in preds_by_model.items():
        q = p.select(key, "repeat", "fold", "role", "y", (F.col("pred") * F.lit(float(weights[name]))).alias("wp"))
        out = q if out is None else out.unionByName(q)
    return out.groupBy(key, "repeat", "fold", "role").agg(F.first("y").alias("y"), F.sum("wp").alias("pred"))


def residual_correlation(wide: DataFrame, members: list[str]) -> DataFrame:
    """BL8: pairwise Pearson correlation of member residuals (one aggregation, long output)."""
    aggs = []
    for a, b in itertools.combinations(members, 2):
        aggs.append(F.corr(F.col("y") - F.col(a), F.col("y") - F.col(b)).alias(f"{a}__{b}"))
    r = wide.agg(*aggs)
    pairs = [F.struct(F.lit(a).alias("member_a"), F.lit(b).alias("member_b"), F.col(f"{a}__{b}").alias("corr"))
             for a, b in itertools.combinations(members, 2)]
    return r.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")


STACK_ALPHAS = (0.01, 0.1, 1.0, 10.0)


def stack_weights(wide: DataFrame, members: list[str], alphas=STACK_ALPHAS) -> tuple[float, np.ndarray, float, float]:
    """BL3: ridge meta-learner with intercept over member OOF predictions, alpha chosen by
    exact leave-one-out error.

    Two aggregations give means and centred products; for each alpha the LOO
    residual is e_i / (1 - h_i) with h_i = 1/n + (x_i - m)' (C + alpha I)^-1 (x_i - m),
    evaluated for every alpha in one pass (k x k matrices as literals, k <= 10).
    Returns (alpha, coefficients, intercept, loo_rmse).
    """
    k = len(members)
    means = wide.agg(*[F.avg(m).alias(m) for m in members], F.avg("y").alias("y")).first()
    mx, my = np.array([means[m] for m in members]), means["y"]
    # products of centred columns: no cancellation when the members are close to each other
    C, cy, _, n = gram(wide.select(*[(F.col(m) - F.lit(float(means[m]))).alias(m) for m in [*members, "y"]]), members)
    fits = []
    for a in alphas:
        ainv = np.linalg.inv(C + a * np.eye(k))
        w = ainv @ cy
        fits.append((a, w, float(my - mx @ w), ainv))
    aggs = []
    for i, (a, w, b0, ainv) in enumerate(fits):
        xc = [F.col(m) - F.lit(float(mx[j])) for j, m in enumerate(members)]
        quad = sum((F.lit(float(ainv[p, q])) * xc[p] * xc[q] for p in range(k) for q in range(k)), F.lit(0.0))
        h = F.lit(1.0 / n) + quad
        e = F.col("y") - F.lit(b0) - sum((F.lit(float(w[j])) * F.col(m) for j, m in enumerate(members)), F.lit(0.0))
        aggs.append(F.avg(F.pow(e / (F.lit(1.0) - h), 2)).alias(f"loo{i}"))
    loo = wide.agg(*aggs).first()
    best = min(range(len(fits)), key=lambda i: loo[f"loo{i}"])
    a, w, b0, _ = fits[best]
    return float(a), w, b0, float(np.sqrt(loo[f"loo{best}"]))


def stacking(wide: DataFrame, members: list[str], alphas=STACK_ALPHAS) -> DataFrame:
    """BL3 as a table: (member, coef) sorted by coef desc, with alpha, intercept and loo_rmse."""
    a, w, b0, loo = stack_weights(wide, members, alphas)
    rows = sorted(((m, round(float(c), 4)) for m, c in zip(members, w)), key=lambda t: -t[1])
    return wide.sparkSession.createDataFrame([(m, c, a, b0, loo) for m, c in rows],
                                             "member string, coef double, alpha double, intercept double, loo_rmse double")


def chain_predictions(df: DataFrame, fitted: dict[str, object]) -> DataFrame:
    """``df`` plus ``_p_<member>``: members score the same rows one after the other, so nothing is joined."""
    done: list[str] = []
    out = df.select("*", F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_raw"))
    for n, m in fitted.items():
        scored = predictions(m, out)
        out = scored.select("_raw", *done, F.col("prediction").alias(f"_p_{n}")).select("_raw.*", "_raw", *done, f"_p_{n}")
        done.append(f"_p_{n}")
    return out.select("_raw.*", *done)


def member_oof(df: DataFrame, members: dict[str, object], key: str, target: str, n_splits: int, seed: int) -> DataFrame:
    """Wide out-of-fold table of the members on the rows of ``df``, written once: every Gram and score reads it."""
    from ..session import written
    from .cv import cv_predictions_estimator
    preds = {n: cv_predictions_estimator(df, lambda est=est: est, key, target, n_splits, seed, roles=("val",)) for n, est in members.items()}
    return written(oof_wide(oof_long(preds, key), list(members), key), "oof")


class StackedEnsemble:
    """BL3: ridge on the members' out-of-fold predictions, members refitted on all training rows."""

    def __init__(self, members: dict[str, object], key: str = "ID", target: str = "price", n_splits: int = 5, seed: int = 42,
                 alphas=STACK_ALPHAS):
        self.members, self.key, self.target, self.n_splits, self.seed, self.alphas = members, key, target, n_splits, seed, alphas

    def fit(self, df: DataFrame) -> "StackedEnsembleModel":
        names = list(self.members)
        wide = member_oof(df, self.members, self.key, self.target, self.n_splits, self.seed)
        self.alpha, w, b0, self.loo_rmse = stack_weights(wide, names, self.alphas)
        return StackedEnsembleModel({n: est.fit(df) for n, est in self.members.items()}, dict(zip(names, map(float, w))), b0)


class StackedEnsembleModel:
    def __init__(self, fitted: dict[str, object], weights: dict[str, float], intercept: float):
        self.fitted, self.weights, self.intercept = fitted, weights, intercept

    def transform(self, df: DataFrame) -> DataFrame:
        pred = sum((F.lit(w) * F.col(f"_p_{n}") for n, w in self.weights.items()), F.lit(self.intercept))
        return chain_predictions(df, self.fitted).withColumn("prediction", pred).drop(*[f"_p_{n}" for n in self.fitted])


class WeightedEnsemble:
    """BL2: members (fit(df) -> model with transform(df) adding ``prediction``) blended with
    fixed (normalised) weights, or weights learned by BL1 on internal k-fold OOF of the
    training rows; members are then refitted on all training rows."""

    def __init__(self, members: dict[str, object], weights: dict[str, float] | None = None, key: str = "ID",
                 target: str = "price", n_splits: int = 5, seed: int = 42):
        self.members, self.weights, self.key, self.target = members, weights, key, target
        self.n_splits, self.seed = n_splits, seed

    def fit(self, df: DataFrame) -> "WeightedEnsembleModel":
        names = list(self.members)
        if self.weights:
            w = normalise(np.array([float(self.weights[n]) for n in names]))
        else:
            wide = member_oof(df, self.members, self.key, self.target, self.n_splits, self.seed)
            G, b, _, _ = gram(wide, names)
            w = normalise(nnls_gram(G, b))
        fitted = {n: est.fit(df) for n, est in self.members.items()}
        return WeightedEnsembleModel(fitted, dict(zip(names, w)), self.key)


class WeightedEnsembleModel:
    def __init__(self, fitted: dict[str, object], weights: dict[str, float], key: str = "ID"):
        self.fitted, self.weights, self.key = fitted, weights, key

    def transform(self, df: DataFrame) -> DataFrame:
        pred = sum((F.lit(float(self.weights[n])) * F.col(f"_p_{n}") for n in self.fitted), F.lit(0.0))
        return chain_predictions(df, self.fitted).withColumn("prediction", pred).drop(*[f"_p_{n}" for n in self.fitted])

    def weight_table(self) -> list[tuple[str, float]]:
        return sorted(((n, round(w, 4)) for n, w in self.weights.items()), key=lambda t: -t[1])
