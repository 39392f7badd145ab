"""Portable hashing, statistics conventions (T-list) and exact selection."""
from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.functions.portable import POISSON_CUTS, hash_int, poisson1
from pricelens.functions.selection import exact_quantiles, kth_largest, kth_smallest
from pricelens.functions.stats import adjusted_skew, half_even
from pricelens.operators.diagnostics import qcut_edges, qcut_label


def test_portable_hash_value(spark):
    v = spark.range(1).select(hash_int(42, F.lit("17")).alias("h")).first()["h"]
    assert v == 2470515424


def test_poisson_weights_mean_one(spark):
    df = spark.range(20000).select(poisson1((hash_int(7, F.col("id")) + 0.5) / 4294967296.0).alias("w"))
    m = df.agg(F.avg("w"), F.variance("w")).first()
    assert abs(m[0] - 1.0) < 0.03 and abs(m[1] - 1.0) < 0.05
    assert POISSON_CUTS[0] == pytest.approx(math.exp(-1))


def test_median_averages_middle_pair_T2(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert df.agg(F.percentile("x", 0.5)).first()[0] == 2.5
    assert exact_quantiles(df, F.col("x"), [0.5]) == [2.5]


def test_skew_and_sd_conventions_T3_T5(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    r = df.agg(adjusted_skew(F.col("x")).alias("adj"), F.skewness("x").alias("pop"),
               F.stddev_samp("x").alias("s"), F.stddev_pop("x").alias("p")).first()
    assert r["adj"] == pytest.approx(1.76363, abs=1e-5)
    assert r["pop"] == pytest.approx(1.01823, abs=1e-5)
    assert r["s"] == pytest.approx(4.08248, abs=1e-5)
    assert r["p"] == pytest.approx(3.53553, abs=1e-5)


def test_half_even_rounding_T11(spark):
    r = spark.range(1).select(half_even(F.lit(2.5)).alias("a"), half_even(F.lit(3.5)).alias("b")).first()
    assert (r["a"], r["b"]) == (2.0, 4.0)


def test_qcut_with_ties_T4(spark):
    vals = [1, 2, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(vals)], "x double, i int")
    edges = qcut_edges(df, F.col("x"), 10)
    labels = [r["b"] for r in df.select(qcut_label(F.col("x"), edges).alias("b"), "i").orderBy("i").collect()]
    assert labels == [0, 0, 0, 0, 2, 3, 4, 5, 6, 7, 8, 8]


def test_grouped_quantiles_match_numpy(spark):
    from pricelens.functions.selection import grouped_quantiles
    rng = np.random.default_rng(9)
    a, b = rng.lognormal(size=2000), rng.integers(0, 7, 2000).astype(float)
    b[::5] = np.nan
    rows = [(float(x), None if np.isnan(y) else float(y)) for x, y in zip(a, b)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    got = grouped_quantiles(df, ["a", "b"], [0.1, 0.5, 0.9])
    np.testing.assert_allclose(got["a"], np.quantile(a, [0.1, 0.5, 0.9]), rtol=1e-12)
    np.testing.assert_allclose(got["b"], np.quantile(b[~np.isnan(b)], [0.1, 0.5, 0.9]), rtol=1e-12)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_selection_matches_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.lognormal(size=3000), np.full(200, 1.5), rng.integers(0, 5, 300).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(7)
    probs = [0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, F.col("x"), probs)
    np.testing.assert_allclose(got, np.quantile(x, probs), rtol=1e-12)
    srt = np.sort(x)
    ks = [1, 17, 1600, len(x)]
    small, n = kth_smallest(df, F.col("x"), ks)
    assert n == len(x) and [small[k] for k in ks] == [srt[k - 1] for k in ks]
    large, _ = kth_largest(df, F.col("x"), [1, 5])
    assert large[1] == srt[-1] and large[5] == srt[-5]


@pytest.mark.parametrize("accuracy", [10_000, 100])
def test_quantiles_of_many_groups_are_exact(spark, monkeypatch, accuracy):
    from pricelens.functions import selection
    monkeypatch.setattr(selection, "ACCURACY", accuracy)
    rng = np.random.default_rng(7)
    rows = [(f"g{i % 40}" if i % 7 else None, int(i % 2), float(v)) for i, v in enumerate(np.round(rng.normal(size=6000) * 1e3, 1))]
    rows += [("hot", 0, float(v)) for v in rng.lognormal(size=3000)] + [("one", 0, 5.0), ("none", 1, None), ("nan", 1, float("nan")), ("same", 1, 2.0), ("same", 1, 2.0)]
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(rows, "a string, b int, v double").repartition(5)
    got = {(r["a"], r["b"]): [r[f"q{j}"] for j in range(5)] for r in selection.quantiles_by(df, ["a", "b"], "v", probs).collect()}
    own = {}
    for a, b, v in rows:
        own.setdefault((a, b), []).append(v)
    assert set(got) == set(own)
    for key, values in own.items():
        values = [v for v in values if v is not None and v == v]
        assert got[key] == (pytest.approx(np.quantile(values, probs), rel=1e-12) if values else [None] * 5)
