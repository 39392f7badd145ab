"""Distributed ranks and Spearman's rho against numpy, with ties, missing values and many tasks."""
from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.functions import ranks
from pricelens.operators import audit
from pricelens.operators import encode as en


@pytest.mark.parametrize("per_task", [200_000, 40])
def test_ranks_of_values(spark, monkeypatch, per_task):
    monkeypatch.setattr(ranks, "ROWS", per_task)
    rng = np.random.default_rng(2)
    rows = [("a", f"é{v:03d}", int(c)) for v, c in zip(range(150), rng.integers(1, 9, 150))] + [("b", "x", 3), ("c", "Z", 2), ("c", "a", 5)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(g, v, int(c), "kept") for g, v, c in rows], "col_name string, value string, c long, more string")
    got = {(r["col_name"], r["value"]): (r["place"], r["below"], r["more"]) for r in ranks.distinct_ranks(df).collect()}
    for g in "abc":
        below = 0
        for place, (v, c) in enumerate(sorted((v, int(c)) for h, v, c in rows if h == g)):
            assert got[(g, v)] == (place, below, "kept")
            below += c
    assert len(got) == len(rows)


def average_ranks(x):
    order = np.argsort(x, kind="stable")
    out = np.empty(len(x))
    out[order] = np.arange(1, len(x) + 1)
    for v in np.unique(x):
        out[x == v] = out[x == v].mean()
    return out


def test_spearman_matches_numpy(spark, monkeypatch):
    monkeypatch.setattr(ranks, "ROWS", 50)
    rng = np.random.default_rng(3)
    n = 400
    y = np.round(rng.normal(size=n), 1)
    cols = {"cont": y + rng.normal(size=n), "ties": rng.integers(0, 4, n) + (y > 0), "flat": np.zeros(n), "holes": np.where(rng.random(n) < 0.3, np.nan, -y + rng.normal(size=n))}
    data = [(float(a), *[None if np.isnan(c[i]) else float(c[i]) for c in cols.values()]) for i, a in enumerate(y)] + [(None, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(data, "price double, " + ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = {r["col_name"]: r["rho"] for r in audit.spearman_with_target(df, list(cols)).collect()}
    for c, x in cols.items():
        ok = ~np.isnan(x)
        if c == "flat":
            assert got[c] is None
        else:
            assert got[c] == pytest.approx(np.corrcoef(average_ranks(x[ok]), average_ranks(y[ok]))[0, 1], abs=1e-12)


def test_empty_vocabulary(spark):
    empty = spark.createDataFrame([], "s string, t string")
    assert en.vocabulary(empty, ["s", "t"]).collect() == []
    assert [tuple(r) for r in en.vocabulary(spark.createDataFrame([("b", None), ("a", None)], "s string, t string"), ["s", "t"]).orderBy("idx").collect()] == [("s", "a", 0), ("s", "b", 1)]
