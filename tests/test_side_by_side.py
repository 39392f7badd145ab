"""Steps that must not repeat or move rows: shared draws, broadcast model tables, members on one row, cross products used twice."""
import pytest
from pyspark.sql import functions as F

from pricelens.operators import blend as bl
from pricelens.operators import bootstrap as bs
from pricelens.operators import cv
from pricelens.operators import linear as ln
from pricelens.operators.group_models import fit_closed_form
from pricelens.operators.split import assign_folds
from pricelens.operators.stages import build_model

SPECS = {"a": {"kind": "ridge1", "level": "g", "alpha": 10.0}, "b": {"kind": "backfit", "levels": ["g", "h"], "lam": 2.0, "sweeps": 2}}


@pytest.fixture(scope="module")
def rows(spark):
    out = [(f"k{i % 380}", "pqr"[i % 3] if i % 7 else None, "uv"[i % 2], float(100 + (i * 37) % 91 + 10 * (i % 3)), float(i % 11)) for i in range(400)]
    return spark.createDataFrame(out, "ID string, g string, h string, price double, x double").cache()


def _same(a, b, keys, places=9):
    a, b = ({tuple(r[k] for k in keys): r.asDict() for r in d.collect()} for d in (a, b))
    assert a.keys() == b.keys() and a
    for k, r in a.items():
        for c, v in r.items():
            assert v == (pytest.approx(b[k][c], abs=10 ** -places) if isinstance(v, float) else b[k][c]), (k, c)


def _groups(rows):
    wide = rows.select("ID", F.col("price").alias("y"), (F.col("x") > 2).alias("in_1"), (F.col("x") <= 7).alias("in_2"),
                       (F.col("price") * 0.9).alias("p"), F.lit(120.0).alias("q"))
    cells = [F.struct(F.lit(m).alias("model"), F.lit(s).alias("iseed"), F.col(f"in_{s}").alias("own"), F.col(m).alias("pred")) for m in "pq" for s in (1, 2)]
    long = wide.select("ID", "y", F.explode(F.array(*cells)).alias("c")).select("ID", "y", "c.*").filter("own")
    return wide, long


def test_weights_drawn_once_give_the_figures_of_repeated_rows(rows):
    wide, long = _groups(rows)
    got = bs.bootstrap_ci_side_by_side(wide, {(m, s): (f"in_{s}", m) for m in "pq" for s in (1, 2)}, ["model", "iseed"], n_boot=12, seed=3)
    _same(got, bs.bootstrap_ci_portable(long, n_boot=12, seed=3, by=["model", "iseed"]), ["model", "iseed"])


def test_exact_draws_serve_several_predictions(rows):
    one = rows.dropDuplicates(["ID"])
    _, long = _groups(one)
    wide = long.groupBy("ID", "y", "iseed").pivot("model", ["p", "q"]).agg(F.first("pred"))
    got = bs.bootstrap_ci_bucketed(wide, p={"p": "p", "q": "q"}, n_boot=40, seed=3, by=["iseed"])
    _same(got, bs.bootstrap_ci_bucketed(long, n_boot=40, seed=3, by=["model", "iseed"]), ["model", "iseed"])


def test_path_of_known_nodes_changes_no_draw():
    known = {}
    for leaf in (0, 1, 2, 3, 7, 5):
        assert (bs.leaf_draws(leaf, 5000, 20, 9, known) == bs.leaf_draws(leaf, 5000, 20, 9)).all()


def test_scoring_shuffles_no_rows(spark, rows):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for spec in SPECS.values():
            d = rows.withColumn("m", F.lit(0))
            out = fit_closed_form(spec, d, ["m"], "price").predict(d)
            assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
            assert out.count() == rows.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_members_on_one_row_equal_their_join(rows):
    preds = {n: cv.cv_predictions_closed(rows, s, roles=("val",)) for n, s in SPECS.items()}
    one = rows.dropDuplicates(["ID"])
    preds_one = {n: cv.cv_predictions_closed(one, s, roles=("val",)) for n, s in SPECS.items()}
    _same(cv.oof_members(one, SPECS), bl.oof_wide(bl.oof_long(preds_one), list(SPECS)), ["ID"])
    got, want = cv.oof_members(rows, SPECS), bl.oof_wide(bl.oof_long(preds), list(SPECS))
    _same(got.drop("y"), want.drop("y"), ["ID"])       # the target of a repeated key is any of its rows'


def test_blend_of_folds_adds_repeated_keys_once(rows):
    w = {"a": 0.3, "b": 0.7}
    preds = {n: cv.cv_predictions_closed(rows, s) for n, s in SPECS.items()}
    _same(cv.blend_folds_members(rows, SPECS, w).drop("y"), bl.derived_blend_folds(preds, w).drop("y"), ["ID", "repeat", "fold", "role"])


def test_cross_products_of_all_features_serve_some(rows):
    d = assign_folds(rows, "ID", 5, 42)
    both = ln.CrossProducts(d, ["g", "h", "x"])
    _same(both.scan({"v": (["g", "x"], "levels_plus")}, [10.0]), ln.ridge_scan(d, {"v": (["g", "x"], "levels_plus")}, [10.0]), ["variant", "alpha", "fold", "role"], 6)


def test_a_fit_keeps_no_encoded_rows(spark, rows, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    kept = []
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(self) or self)
    build_model("ridge", alpha=10.0).fit(rows)
    build_model("rf", n_estimators=2, max_depth=2).fit(rows)
    assert not kept


def test_a_stream_takes_as_many_files_as_there_are_partitions(spark, rows, tmp_path, monkeypatch):
    from pricelens.plans import q_score
    monkeypatch.setattr(q_score, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    d = rows.select("ID", "g", "price").withColumn("split", F.lit("dev")).repartition(9)
    out = q_score._streamed(spark, d, build_model("ridge", alpha=10.0).fit(rows.select("ID", "g", "price")))
    assert out.count() == rows.count()
    assert len(list(tmp_path.glob("st1/*/incoming/part-*.parquet"))) == 9
