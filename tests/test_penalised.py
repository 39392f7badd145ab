"""Lasso and elastic net: coordinate descent on cross products against the optimality conditions on the rows."""
from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.operators import linear as ln
from pricelens.operators.features import FeatureConfig, engineer
from pricelens.operators.split import assign_folds
from pricelens.operators.stages import build_model


def gap(x, y, w, l1, l2):
    """Largest violation of the optimality conditions of 1/(2n)||y - Xw||^2 + l1|w| + l2/2 ||w||^2."""
    slope = x.T @ (y - x @ w) / len(y) - l2 * w
    return max(np.abs(slope[w != 0] - l1 * np.sign(w[w != 0])).max(initial=0), (np.abs(slope[w == 0]) - l1).max(initial=0))


@pytest.mark.parametrize("l1,l2", [(0.05, 0.0), (0.3, 0.0), (0.1, 0.2), (5.0, 0.0), (0.0, 0.5)])
def test_coordinate_descent_is_optimal(l1, l2):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 40)) @ np.diag(np.r_[np.ones(20), np.full(20, 0.1)])
    x[:, 5] = x[:, 4]                       # a repeated column
    x[:, 6] = 0.0
    y = x @ np.r_[rng.normal(size=8), np.zeros(32)] + rng.normal(size=300)
    w = ln.coordinate_descent(x.T @ x, x.T @ y, 300, l1, l2, np.zeros(40))
    assert gap(x, y, w, l1, l2) < 1e-9
    assert l1 < 5 or not w.any()


@pytest.mark.parametrize("l1_ratio,alphas", [(1.0, [0.3, 30.0, 3.0]), (0.5, [1.0, 0.1])])
def test_path_equals_descent_on_the_rows(device_small, l1_ratio, alphas):
    d = assign_folds(engineer(device_small, FeatureConfig()), "ID", 3, 42)
    feats = ["gpu_model", "ram_gb", "display_size_in", "device_type"]
    scan = {(r["alpha"], r["fold"], r["role"]): r["rmse"]
            for r in ln.ridge_scan(d, {"v": (feats, "onehot")}, alphas, k=3, l1_ratio=l1_ratio).collect()}
    p = d.select("fold", "price", *feats).toPandas()
    own = p["fold"] != 1
    cols = []
    for c in ("gpu_model", "device_type"):
        v = p[c].fillna(p[c][own].mode().min())
        cols += [(v == level).astype(float) for level in sorted(v[own].unique())]
    for c in ("ram_gb", "display_size_in"):
        v = p[c].astype(float).fillna(p[c][own].median())
        cols.append((v - v[own].mean()) / v[own].std(ddof=0))
        if p[c][own].isna().any():
            m = p[c].isna().astype(float)
            cols.append((m - m[own].mean()) / m[own].std(ddof=0))
    x, y = np.stack(cols, axis=1), p["price"].to_numpy()
    mx, my = x[own].mean(axis=0), y[own].mean()
    for alpha in alphas:
        c = x[own] - mx
        w = ln.coordinate_descent(c.T @ c, c.T @ (y[own] - my), own.sum(), alpha * l1_ratio, alpha * (1 - l1_ratio), np.zeros(len(mx)))
        assert gap(c, y[own] - my, w, alpha * l1_ratio, alpha * (1 - l1_ratio)) < 1e-6
        e = y - my - (x - mx) @ w
        for role, rows in (("train", own), ("val", ~own)):
            assert abs(scan[(alpha, 1, role)] - np.sqrt((e[rows] ** 2).mean())) < 1e-6


@pytest.mark.parametrize("family,hyper,l1,l2", [("lasso", {"alpha": 5.0}, 5.0, 0.0), ("elasticnet", {"alpha": 2.0, "l1_ratio": 0.5}, 1.0, 1.0)])
def test_fitted_pipelines_are_optimal(device_small, family, hyper, l1, l2):
    rows = device_small.select("ID", "price", "ram_gb", "display_size_in", "gpu_model")
    model = build_model(family, tol=1e-12, **hyper).fit(rows)
    enc = model.stages[1].transform(model.stages[0].transform(rows)).select("features", "price").toPandas()
    x, y = np.stack([v.toArray() for v in enc["features"]]), enc["price"].to_numpy()
    w = np.array(model.stages[-1].coefficients.toArray())
    assert gap(x - x.mean(axis=0), y - y.mean(), np.where(np.abs(w) < 1e-9, 0, w), l1, l2) < 1e-3 * np.abs((x - x.mean(axis=0)).T @ (y - y.mean()) / len(y)).max()
