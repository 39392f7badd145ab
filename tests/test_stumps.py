"""Boosted stumps in Gram space against Spark's own, and from one scan for all folds."""
from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from pricelens.operators import additive_stumps as st
from pricelens.operators import explain as sh
from pricelens.operators.attribution import attribution
from pricelens.operators.stages import build_model


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(9)
    n = 500
    a, b, g = rng.integers(0, 14, n) / 2, rng.integers(-5, 6, n).astype(float), rng.choice(list("pqrst"), n)
    y = np.sin(a) * 5 + (b > 1) * 3 + np.vectorize(dict(zip("pqrst", [0, 4, -2, 1, 7])).get)(g) + rng.normal(size=n) * 0.3
    df = spark.createDataFrame([(i, float(p), float(q), str(s), float(t)) for i, (p, q, s, t) in enumerate(zip(a, b, g, y))],
                               "ID long, a double, b double, g string, y double")
    df = StringIndexer(inputCol="g", outputCol="gi").fit(df).transform(df)
    return VectorAssembler(inputCols=["a", "b", "gi"], outputCol="features").transform(df).cache()


def test_equals_sparks_boosted_stumps(table):
    rounds, rate = 30, 0.2
    theirs = GBTRegressor(maxIter=rounds, maxDepth=1, stepSize=rate, labelCol="y").fit(table).transform(table)
    # Spark's squared loss fits trees to twice the residual, and doesn't shrink the first one
    ours = st.AdditiveStumps(nEstimators=rounds, learningRate=2 * rate, firstTreeFull=True, labelCol="y").fit(table).transform(table)
    a = [r["prediction"] for r in theirs.orderBy("ID").collect()]
    b = [r["prediction"] for r in ours.orderBy("ID").collect()]
    assert np.allclose(a, b, atol=1e-8)


def test_folds_and_stages_equal_separate_fits(table):
    folded = table.withColumn("fold", (F.col("ID") % 3).cast("int"))
    got = {(r["rounds"], r["fold"], r["role"]): (r["n"], r["rmse"]) for r in st.stumps_cv(folded, (5, 40), 0.3, k=3, min_rows=4, target="y").collect()}
    for rounds in (5, 40):
        train = folded.filter("fold <> 1")
        model = st.AdditiveStumps(nEstimators=rounds, learningRate=0.3, minRows=4, labelCol="y").fit(train)
        for role, part in (("train", train), ("val", folded.filter("fold = 1"))):
            r = model.transform(part).agg(F.count("*").alias("n"), F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2)).alias("rmse")).first()
            assert got[(rounds, 1, role)][0] == r["n"] and abs(got[(rounds, 1, role)][1] - r["rmse"]) < 1e-8


def test_missing_numbers_unseen_categories_and_constant_targets(spark, table):
    model = st.AdditiveStumps(nEstimators=50, learningRate=0.3, labelCol="y").fit(table)
    terms, base = model.attribution_terms()
    x = np.array([[np.nan, 0.0, 1.0], [1.0, np.nan, 9.0], [1.0, 2.0, np.nan]])
    assert np.isfinite(terms(x)).all()
    assert np.isclose((terms(x) + 0)[1, 2], (terms(x) + 0)[2, 2])      # neither has a bin: the table's mean is taken off
    flat = st.AdditiveStumps(nEstimators=5, labelCol="c").fit(table.withColumn("c", F.lit(3.0)))
    assert {r["prediction"] for r in flat.transform(table).collect()} == {3.0}
    with pytest.raises(ValueError):
        st.AdditiveStumps(labelCol="y").fit(table.limit(0))


def test_many_values_are_cut_at_quantiles(spark):
    rows = spark.range(3000).select(F.array((F.col("id") * 7919 % 3001).cast("double"), F.lit(float("nan"))).alias("x"))
    bins = st.find_bins(rows, {}, 2, 16)
    assert 12 <= bins.sizes[0] <= 16 and bins.sizes[1] == 1
    counts = np.bincount(bins.codes(np.array([r["x"] for r in rows.collect()]))[:, 0])
    assert counts.max() < 2.5 * 3000 / 16


def test_factory_pipeline_saves_loads_and_is_additive(device_small, tmp_path):
    dev, rows = device_small.filter("pmod(hash(ID), 5) <> 0"), device_small.filter("pmod(hash(ID), 5) = 0").limit(50).cache()
    model = build_model("stumps", n_estimators=200, learning_rate=0.1).fit(dev)
    long, base = attribution(model, rows)
    pred = model.transform(rows).select("ID", F.col("prediction").alias("pred"))
    assert sh.additivity_check(long, base, pred).first()["max_abs_diff"] < 1e-6
    model.write().overwrite().save(f"file://{tmp_path}/m")
    again = PipelineModel.load(f"file://{tmp_path}/m").transform(rows)
    key = lambda df, c: [round(r[c], 9) for r in df.orderBy("ID").select(c).collect()]
    assert key(again, "prediction") == key(pred, "pred")
