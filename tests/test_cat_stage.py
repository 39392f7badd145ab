"""The ordered-statistics stage: no row sees its own target, new rows look up, the fitted pipeline is saved whole."""
from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pricelens.functions.portable import hash_int
from pricelens.operators import encode as en
from pricelens.operators import explain as sh
from pricelens.operators.attribution import attribution
from pricelens.operators.blend import WeightedEnsembleModel
from pricelens.operators.cat_stage import OrderedTargetEncoder, ordered_stats
from pricelens.operators.stages import build_model


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(6)
    n = 300
    a = [str(v) if v else None for v in rng.choice(["x", "x", "x", "y", "z", ""], n)]
    b = [f"l{v}" for v in rng.integers(0, 40, n)]
    num = [float(v) if v > -1 else None for v in rng.normal(size=n)]
    return spark.createDataFrame([(f"k{i}", a[i], b[i], num[i], float(v)) for i, v in enumerate(rng.normal(size=n) * 10 + 50)],
                                 "ID string, a string, b string, num double, y double").repartition(4).cache()


@pytest.mark.parametrize("chunk", [50_000, 16])
def test_ordered_statistics_match_a_loop(rows, monkeypatch, chunk):
    monkeypatch.setattr(en, "CHUNK_ROWS", chunk)
    full = en.missing_sentinel(rows, ["a", "b"])
    got = {r["ID"]: r["ts"] for r in ordered_stats(full, ["a", "b"], "y", "ID", 1.0, 42).collect()}
    data = full.withColumn("h", hash_int(42, F.col("ID"))).orderBy("h", "ID").collect()
    prior = np.mean([r["y"] for r in data])
    seen = defaultdict(list)
    for r in data:
        want = [(sum(seen[c, r[c]]) + prior) / (len(seen[c, r[c]]) + 1) for c in ("a", "b")]
        assert np.allclose(got[r["ID"]], want)
        for c in ("a", "b"):
            seen[c, r[c]].append(r["y"])


def _plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended")


def test_ordered_statistics_and_small_level_tables_move_no_row_twice(spark, rows):
    full = en.missing_sentinel(rows, ["a", "b"])
    stats = ordered_stats(full, ["a", "b"], "y", "ID", 1.0, 42)
    assert not re.search(r"hashpartitioning\((ID|_k)#", _plan(stats))       # nothing long is gathered by the key
    model = OrderedTargetEncoder(colsJson='["a", "num", "b"]', labelCol="y").fit(rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in _plan(model.transform(rows))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ordered_statistics_of_repeated_missing_and_single_rows(spark):
    data = [("k1", "x", 1.0), ("k2", "x", 2.0), ("k2", "x", 2.0), (None, "x", 9.0), ("k3", "never", None)]
    out = ordered_stats(spark.createDataFrame(data, "ID string, a string, y double"), ["a"], "y", "ID", 1.0, 42).collect()
    assert sorted(r["ID"] for r in out) == ["k1", "k2", "k2", "k3"]          # a row without a key is not encoded
    assert len({r["ts"][0] for r in out if r["ID"] == "k2"}) == 1
    assert {r["ts"][0] for r in out if r["ID"] == "k3"} == {3.5}             # the first of its level: the prior


def test_new_rows_look_up_and_unseen_levels_have_the_prior(spark, rows):
    model, train = OrderedTargetEncoder(colsJson='["a", "num", "b"]', labelCol="y").fit_rows(rows)
    assert train.count() == 300 and train.columns == ["features", "y"]
    data = rows.collect()
    prior = np.mean([r["y"] for r in data])
    mean = lambda c, v: (sum(r["y"] for r in data if r[c] == v) + prior) / (sum(r[c] == v for r in data) + 1)
    low = min(r["num"] for r in data if r["num"] is not None) - 1
    new = spark.createDataFrame([(1, "x", "l3", 0.5), (2, None, "never", None), (3, "x", "l3", float("nan"))], "n int, a string, b string, num double")
    out = {r["n"]: r["features"].toArray() for r in model.transform(new).collect()}
    assert np.allclose(out[1], [0.5, mean("a", "x"), mean("b", "l3")])
    assert np.allclose(out[2], [low, mean("a", None), prior]) and np.allclose(out[3], [low, mean("a", "x"), mean("b", "l3")])
    assert model.transform(new).columns == [*new.columns, "features"]


def test_factory_model_fits_saves_loads_scores_and_is_explained(device_small, tmp_path):
    dev, hold = device_small.filter("pmod(hash(ID), 5) <> 0"), device_small.filter("pmod(hash(ID), 5) = 0").limit(40).cache()
    model = build_model("cat", iterations=4, depth=4, learning_rate=0.3).fit(dev)
    model.write().overwrite().save(f"file://{tmp_path}/m")
    again = PipelineModel.load(f"file://{tmp_path}/m")
    a, b = ({r["ID"]: r["prediction"] for r in m.transform(hold).select("ID", "prediction").collect()} for m in (model, again))
    assert a == b and len(a) == 40
    base = np.std([r["price"] for r in hold.collect()])
    error = np.sqrt(np.mean([(r["price"] - a[r["ID"]]) ** 2 for r in hold.collect()]))
    assert error < 0.8 * base
    blend = WeightedEnsembleModel({"cat": again, "mean": build_model("mean").fit(dev)}, {"cat": 0.7, "mean": 0.3})
    long, start = attribution(blend, hold)
    assert sh.additivity_check(long, start, blend.transform(hold).select("ID", F.col("prediction").alias("pred"))).first()["max_abs_diff"] < 1e-6
    assert {r["feature"] for r in long.select("feature").distinct().collect()} >= {"brand", "gpu_model", "ram_gb"}
