"""Frozen schemas, representations, ridge scans, CSV contract, hyperparameters, exact selection at the extremes."""
from __future__ import annotations

import tempfile

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.functions.selection import exact_quantiles, quantiles_by
from pricelens.operators import linear as ln
from pricelens.operators.diagnostics import qcut_edges
from pricelens.operators.features import FeatureConfig, engineer
from pricelens.operators.split import assign_folds, make_dev_holdout, sample_rows
from pricelens.operators.stages import FeatureEngineer, Representation, build_model, make_estimator
from pricelens.sources import io
from pricelens.sources.tables import device_frame, fold_rows


# ---------------------------------------------------------------------------- schema and representation
def test_bookkeeping_columns_never_become_features(device_small):
    raw = FeatureEngineer.of().fit(device_small).feature_names()
    busy = assign_folds(make_dev_holdout(device_small), "ID").withColumn("m", F.lit(0)).withColumn("role", F.lit("val"))
    assert FeatureEngineer.of().fit(busy).feature_names() == raw
    assert not {"split", "fold", "repeat", "m", "role"} & set(raw)


def test_unseen_level_encodes_as_all_zeros(spark):
    fit = spark.createDataFrame([("a",), ("b",), ("c",)], "g string")
    rep = Representation(kind="onehot", featureColsJson='["g"]').fit(fit)
    out = rep.transform(spark.createDataFrame([("b",), ("zz",)], "g string")).select(vector_to_array("features").alias("v")).collect()
    assert [list(r["v"]) for r in out] == [[0.0, 1.0, 0.0], [0.0, 0.0, 0.0]]


@pytest.mark.parametrize("kind", ["onehot", "levels_plus"])
def test_ridge_is_the_direct_solution(device_small, kind):
    dev = device_small.limit(1500)
    model = build_model("ridge", preprocessor=kind, alpha=10.0).fit(dev)
    lr = model.stages[-1]
    assert lr.summary.totalIterations == 0
    enc = model.transform(dev).select(vector_to_array("features").alias("x"), "price", "prediction").toPandas()
    x, y = np.stack(enc["x"]), enc["price"].to_numpy()
    xc = x - x.mean(0)
    w = np.linalg.solve(xc.T @ xc + 10.0 * np.eye(x.shape[1]), xc.T @ (y - y.mean()))
    np.testing.assert_allclose(enc["prediction"], y.mean() + xc @ w, rtol=1e-9)


@pytest.mark.parametrize("kind,alpha", [("onehot", 10.0), ("levels", 100.0), ("levels_plus", 100.0)])
def test_scan_equals_fit_per_fold(device_small, kind, alpha):
    d = assign_folds(device_small, "ID", 3, 42)
    d = d.withColumn("os", F.when(F.col("fold") + F.length("ID") > 15, F.col("os"))).cache()      # text with holes
    feats = FeatureEngineer.of().fit(d).feature_names()
    scan = {(r["fold"], r["role"]): r for r in ln.ridge_scan(engineer(d), {"v": (feats, kind)}, [alpha], k=3).collect()}
    model = build_model("ridge", preprocessor=kind, alpha=alpha).fit(d.filter("fold <> 1"))
    p = model.transform(d).withColumn("role", F.when(F.col("fold") == 1, "val").otherwise("train"))
    e = F.col("price") - F.col("prediction")
    for r in p.groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae")).collect():
        got = scan[(1, r["role"])]
        assert got["n"] == r["n"] and got["rmse"] == pytest.approx(r["rmse"], rel=1e-7) and got["mae"] == pytest.approx(r["mae"], rel=1e-7)
    d.unpersist()


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (3.0, 0.0)], "battery_wh double, psu_watts double")
    rows = engineer(df, FeatureConfig()).collect()
    assert (rows[0]["has_battery"], rows[0]["battery_wh"]) == (0, None) and rows[1]["has_battery"] == 1


# ---------------------------------------------------------------------------- hyperparameters
def test_hyperparameters_are_mapped_or_refused():
    cat = make_estimator("cat", iterations=800, learning_rate=0.06, depth=6)
    assert (cat.getMaxIter(), cat.getMaxDepth(), cat.getStepSize()) == (800, 6, 0.06)
    assert make_estimator("lgbm", num_leaves=31).getMaxDepth() == 5
    with pytest.warns(UserWarning, match="l2_leaf_reg"):
        make_estimator("cat", l2_leaf_reg=10.0)
    for name, bad in (("ridge", {"iterations": 3}), ("hgb", {"leafs": 3}), ("mean", {"alpha": 1.0}), ("rf", {"alpha": 1.0})):
        with pytest.raises(ValueError):
            make_estimator(name, **bad)


# ---------------------------------------------------------------------------- CSV
SCHEMA = T.StructType([T.StructField("ID", T.StringType()), T.StructField("a", T.DoubleType()), T.StructField("b", T.LongType())])


def _csv(text: str) -> str:
    path = tempfile.mkdtemp(prefix="/tmp/pl-test-") + "/in.csv"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_columns_go_by_name(spark):
    rows = io.load_raw(spark, _csv("b,extra,ID,a\n1,x,k1,7.5\n2,y,k2,NaN\n3,,k3,\n"), SCHEMA).collect()
    assert [(r["ID"], r["a"], r["b"]) for r in rows] == [("k1", 7.5, 1), ("k2", None, 2), ("k3", None, 3)]


def test_csv_refuses_missing_columns_and_bad_rows(spark):
    with pytest.raises(ValueError, match="price"):
        io.load_raw(spark, _csv("ID,a,b\nk,1,2\n"), SCHEMA, target="price")
    with pytest.raises(ValueError, match="lacks b"):
        io.load_raw(spark, _csv("ID,a\nk,1\n"), SCHEMA)
    assert io.load_raw(spark, _csv("ID,a\nk,1\n"), SCHEMA, optional=("b",)).columns == ["ID", "a"]
    with pytest.raises(Exception):
        io.load_raw(spark, _csv("ID,a,b\nk,one,2\n"), SCHEMA).collect()
    with pytest.raises(Exception):
        io.load_raw(spark, _csv("ID,a,b\nk,1,2,3\n"), SCHEMA).collect()


# ---------------------------------------------------------------------------- diagnosed rows
def test_fold_rows_are_the_folded_device_rows_without_what_nobody_reads(spark, tmp_path):
    lines = [(o, p, 7, n, float(n), 10.25 * n, 0.01, 0.02, "R", "F") for o in (1, 2, 3, None) for p in (1, 2, 9) for n in (1, 2)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                            "l_discount double, l_tax double, l_returnflag string, l_linestatus string"),
        "part": ([(1, "a b", "B1", "PROMO", 3, 5.0), (2, None, "B2", None, 4, 6.0)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "orders": ([(1, "O", 9.0, "1-URGENT"), (2, "F", 8.0, None), (2, "P", 7.0, "2-HIGH")], "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        df = df.withColumn("o_orderdate", F.lit("1995-01-02").cast("timestamp")) if name == "orders" else df
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    cols = ["price", "gpu_model", "os", "ID"]
    want = assign_folds(device_frame(spark, str(tmp_path)).select(*cols)).select("repeat", "fold", *cols)
    got = fold_rows(spark, str(tmp_path), *cols)
    assert got.columns == want.columns and got.count() == 12
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert fold_rows(spark, str(tmp_path), "price", "gpu_model").columns == ["repeat", "fold", "price", "gpu_model"]


# ---------------------------------------------------------------------------- selection
def test_quantiles_over_the_range_of_a_double(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([np.exp(rng.normal(0, 90, 1500)) * rng.choice([-1, 1], 1500), np.zeros(40)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(3)
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    np.testing.assert_allclose(exact_quantiles(df, "x", probs), np.quantile(x, probs), rtol=1e-12)


def test_edges_of_a_small_scale_column(spark):
    df = spark.createDataFrame([(i * 1e-9,) for i in range(100)], "x double")
    assert len(qcut_edges(df, F.col("x"), 10)) == 11


def test_quantiles_by_group(spark):
    rows = [(g, float(v)) for g, n in (("a", 5), ("b", 8), (None, 3)) for v in range(n)]
    got = {r["g"]: r["q0"] for r in quantiles_by(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", [0.5], block=2).collect()}
    assert got == {"a": 2.0, "b": 3.5, None: 1.0}


def test_sample_order_is_one_rule(spark):
    df = spark.range(500).withColumnRenamed("id", "ID")
    small = {r["ID"] for r in sample_rows(df, 20).collect()}
    assert len(small) == 20 and small <= {r["ID"] for r in sample_rows(df, 21).collect()}
