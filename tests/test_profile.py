"""Value counts from one pass, and scans that follow from counts of codes."""
from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.operators import linear as ln
from pricelens.operators.profile import profile


def _rows(spark, n=400):
    data = [(i % 5, None if i % 7 == 0 else "é" * (i % 3), None if i % 11 == 0 else float(i % 4) - 1.0, math.sin(i), 3.0 * (i % 4) + i % 3 + 0.01 * i)
            for i in range(n)]
    return spark.createDataFrame(data, "fold int, g string, few double, many double, price double")


def test_profile_counts_every_value(spark):
    d = _rows(spark).unionByName(spark.createDataFrame([(0, "z", -0.0, None, 1.0), (0, None, float("nan"), 0.5, 1.0)], "fold int, g string, few double, many double, price double"))
    got, rows = profile(d.repartition(3), ["g"], ["few", "many"], F.col("fold"), 5, limit=50), d.collect()
    assert got.n == len(rows) and got.rows.tolist() == [sum(r["fold"] == f for r in rows) for f in range(5)]
    for v, n in got.text["g"].items():
        assert n.tolist() == [sum(r["fold"] == f and r["g"] == v for r in rows) for f in range(5)]
    few, many = got.numbers["few"], got.numbers["many"]
    assert few.distinct() == 5 and len(few.values) == 6                 # 0.0 and -0.0 are one number, but two texts
    held = [r["few"] for r in rows if r["few"] is not None and not math.isnan(r["few"])]
    assert few.median() == np.median(held) and few.missing.sum() == sum(r["few"] is None for r in rows)
    own = [r["few"] for r in rows if r["few"] is not None and not math.isnan(r["few"]) and r["fold"] != 2]
    assert few.median(np.arange(5) != 2) == np.median(own)
    assert many.values is None and many.total == pytest.approx(sum(r["many"] for r in rows if r["many"] is not None))
    assert many.square == pytest.approx(sum(r["many"] ** 2 for r in rows if r["many"] is not None)) and many.missing.sum() == 1


def test_profile_of_no_rows_and_of_a_column_without_values(spark):
    d = _rows(spark, 6).withColumn("few", F.lit(None).cast("double")).withColumn("g", F.lit(None).cast("string"))
    got = profile(d, ["g"], ["few"])
    assert got.mode("g") is None and got.numbers["few"].median() is None and got.numbers["few"].missing.tolist() == [6]
    none = profile(d.limit(0), ["g"], ["few"])
    assert none.n == 0 and none.text["g"] == {} and none.numbers["few"].distinct() == 0


def test_squared_errors_follow_from_the_cross_products(spark):
    products = ln.CrossProducts(_rows(spark), ["g", "few", "many"])
    variants = {"all": (["g", "few", "many"], "levels_plus"), "one": (["many"], "onehot")}
    want = {(r["variant"], r["fold"], r["role"]): r for r in products.scan(variants, [1.0]).collect()}
    products.rows = products.rows.filter(F.raise_error(F.lit("the rows are read again")).isNotNull())
    got = products.scan(variants, [1.0], absolute=False).collect()
    assert len(got) == len(want) == 20
    for r in got:
        own = want[(r["variant"], r["fold"], r["role"])]
        assert r["n"] == own["n"] and r["rmse"] == pytest.approx(own["rmse"], rel=1e-9)


def test_errors_of_rows_without_a_target_are_null(spark):
    d = _rows(spark).withColumn("price", F.when(F.col("many") < 0.99, F.col("price")))
    products = ln.CrossProducts(d, ["g", "few"])
    for absolute in (True, False):
        assert all(r["rmse"] is None for r in products.scan({"v": (["g", "few"], "levels")}, [1.0], absolute=absolute).collect())
