"""Linear fits from counted moments and scores by level, against encoded vectors."""
from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pricelens.operators import cv
from pricelens.operators.linear_rows import LinearScorer, factored
from pricelens.operators.stages import PenalisedLinear, build_model, predictions


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"k{i}", None if i % 7 == 0 else "ab'é"[i % 4], None if i % 9 == 0 else float(i % 3) - 1.0, i * 0.37 % 11, 0.0 if i % 2 else -0.0,
             10.0 + 3 * (i % 4) + (i % 3) + i % 5 * 0.1) for i in range(300)]
    return spark.createDataFrame(data, "ID string, g string, few double, many double, zero double, price double").repartition(4).cache()


def unseen(spark):
    return spark.createDataFrame([("n1", "never", 7.0, None, 0.0, 1.0), ("n2", None, None, 2.5, None, 1.0)],
                                 "ID string, g string, few double, many double, zero double, price double")


@pytest.mark.parametrize("kind", ["onehot", "levels", "levels_plus", "ordinal", "native"])
@pytest.mark.parametrize("transform", [None, "log"])
def test_scores_by_level_equal_those_of_vectors(spark, rows, kind, transform, tmp_path):
    model = build_model("ridge", preprocessor=kind, target_transform=transform, alpha=3.0).fit(rows)
    model.write().save(f"{tmp_path}/m")
    loaded, d = PipelineModel.load(f"{tmp_path}/m"), rows.unionByName(unseen(spark))
    assert LinearScorer.of(loaded.stages[1], loaded.stages[2]) is not None
    want = {r["ID"]: r["prediction"] for r in model.transform(d).collect()}
    for m in (model, loaded):
        got = predictions(m, d)
        assert "features" not in got.columns
        assert {r["ID"]: r["prediction"] for r in got.collect()} == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("family,hyper", [("ridge", {"alpha": 3.0}), ("lasso", {"alpha": 0.05}), ("elasticnet", {"alpha": 0.05, "tol": 1e-3})])
def test_a_fit_on_moments_equals_the_fit_on_rows(rows, family, hyper, monkeypatch):
    counted = build_model(family, preprocessor="levels_plus", **hyper).fit(rows)
    monkeypatch.setattr(PenalisedLinear, "fit_rows", lambda self, d, rep: self._fit(rep.transform(d).select("features", "price")))
    encoded = build_model(family, preprocessor="levels_plus", **hyper).fit(rows)
    a, b = counted.stages[2], encoded.stages[2]
    np.testing.assert_allclose(a.coefficients.toArray(), b.coefficients.toArray(), rtol=1e-6, atol=1e-8)
    assert a.intercept == pytest.approx(b.intercept, rel=1e-7) and a.summary.totalIterations == b.summary.totalIterations
    assert a.summary.numInstances < b.summary.numInstances            # as many rows as columns, not as rows


def test_factored_rows_have_the_moments():
    x = np.random.default_rng(1).normal(size=(500, 6)) * [1, 1e3, 1, 1e-3, 1, 5] + 2
    x[:, 4] = x[:, 0] + x[:, 2]
    x[:, 5] = 1.0
    centred = x - x.mean(0)
    few, weight = factored(centred.T @ centred, x.mean(0), 500.0)
    assert weight * len(few) == pytest.approx(500)
    np.testing.assert_allclose(few.mean(0), x.mean(0), rtol=1e-9)
    np.testing.assert_allclose(weight * few.T @ few, x.T @ x, rtol=1e-9)


def test_folds_share_the_features(rows):
    made = []
    spec = lambda: made.append(build_model("ridge", alpha=3.0)) or made[-1]
    got = {(r["ID"], r["fold"]): r for r in cv.cv_predictions_estimator(rows, spec, k=3).collect()}
    assert len(made) == 1 and len(got) == 3 * rows.count()
    folded = cv.assign_folds(rows, "ID", 3, 42)
    model = build_model("ridge", alpha=3.0).fit(folded.filter("fold <> 1"))
    for r in model.transform(folded).collect():
        own = got[(r["ID"], 1)]
        assert own["pred"] == pytest.approx(r["prediction"], rel=1e-8) and own["role"] == ("val" if r["fold"] == 1 else "train")


def test_settings_are_put_back(spark, rows):
    from pricelens.session import METHOD_LIMIT, compiled, written
    before = spark.conf.get(METHOD_LIMIT, None)
    with compiled(spark), pytest.raises(Exception):
        written(rows.withColumn("bad", F.raise_error(F.lit("x"))), "bad")
    assert spark.conf.get(METHOD_LIMIT, None) == before
