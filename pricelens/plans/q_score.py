"""Registered queries: batch scoring, persistence, experiment log, streaming scoring, learning curve
(SC1, IO4, IO5, IO8, IO10, IO11, CV9)."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.portable import hash_int_sql, unit_sql
from ..operators import cv
from ..operators.group_models import fit_one_factor_ridge
from ..operators.split import nested_prefixes
from ..operators.stages import build_model
from ..session import scratch_path, written
from ..sources import io
from ..sources.tables import DEVICE_COLS, device_frame, device_rows
from ..operators.split import make_dev_holdout
from .registry import query, rounded, sql_round
from .sqlgen import closed_form_preds_ctes, cv_summary_sql, with_ctes


def _fit_ridge(spark, sf_dir):
    d = make_dev_holdout(device_rows(spark, sf_dir, *DEVICE_COLS))
    model = build_model("ridge", alpha=10.0).fit(d.filter(F.col("split") == "dev"))
    return d, model


def _fit_one_factor(spark, sf_dir):
    """The saved-model form of the closed-form ridge on one column, so that scoring has an oracle."""
    d = make_dev_holdout(device_rows(spark, sf_dir, "ID", "gpu_model", "price"))
    model = build_model("ridge", alpha=10.0).fit(d.filter(F.col("split") == "dev"))
    return d, model


_SPLIT = f"CASE WHEN {unit_sql(42, 'ID')} < 0.2::DOUBLE THEN 'holdout' ELSE 'dev' END"
_ONE_FACTOR = [
    f"hs AS (SELECT ID, price, gpu_model, {_SPLIT} AS split FROM device)",
    "cl AS (SELECT gpu_model, avg(price) AS ybar, count(*) / (count(*) + 10.0::DOUBLE) AS w FROM hs WHERE split = 'dev' GROUP BY 1)",
    "bb AS (SELECT sum(w * ybar) / sum(w) AS b FROM cl)",
    "sc AS (SELECT ID, split, price, bb.b + coalesce(cl.w * (cl.ybar - bb.b), 0.0) AS predicted_price FROM hs CROSS JOIN bb "
    "LEFT JOIN cl USING (gpu_model))",
]


@query("sc1_batch_scoring")
def q_sc1(spark, sf_dir):
    """Every row of the frame scored by the full ridge pipeline."""
    d, model = _fit_ridge(spark, sf_dir)
    return rounded(io.predict_frame(d.drop("split"), model, check=False))


@query("sc1_one_factor_scoring", sql_round(with_ctes("SELECT ID, predicted_price FROM sc", *_ONE_FACTOR), ["predicted_price"]))
def q_sc1_one(spark, sf_dir):
    d, model = _fit_one_factor(spark, sf_dir)
    return rounded(io.predict_frame(d.drop("split"), model))


@query("io4_predict_csv", sql_round(with_ctes("SELECT ID, predicted_price FROM sc", *_ONE_FACTOR), ["predicted_price"]))
def q_io4(spark, sf_dir):
    """All rows through CSV files with permuted columns, a further column and the target."""
    d, model = _fit_one_factor(spark, sf_dir)
    run = uuid.uuid4().hex[:8]
    src, out = scratch_path(spark, f"io4/{run}/input"), scratch_path(spark, f"io4/{run}/output")
    raw = d.select("price", F.lit("x").alias("note"), "gpu_model", "ID")
    raw.write.mode("overwrite").option("header", True).csv(src)
    io.predict_csv(spark, src, out, model, d.drop("split").schema)
    return rounded(spark.read.option("header", True).schema("ID string, predicted_price double").csv(out))


@query("io5_save_load_roundtrip", with_ctes("SELECT count(*) AS n, 0.0::DOUBLE AS max_abs_diff FROM device"))
def q_io5(spark, sf_dir):
    """A loaded model predicts what the saved one does, row by row."""
    from .train import load_model, save_model
    d, model = _fit_one_factor(spark, sf_dir)
    again = load_model(save_model(model, scratch_path(spark, f"io5/{uuid.uuid4().hex[:8]}/model")))
    a = model.transform(d).select("ID", "gpu_model", "price", F.col("prediction").alias("a"))
    both = again.transform(a)
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("a") - F.col("prediction"))).alias("max_abs_diff"))


def _pooled_sql():
    from .q_models import RIDGE1
    return sql_round(with_ctes("SELECT count(*) AS n, sqrt(avg((y - pred) ^ 2)) AS pooled_rmse, count(*) AS n_first FROM preds WHERE role = 'val'",
                               closed_form_preds_ctes(RIDGE1)), ["pooled_rmse"])


@query("io8_oof_cache", _pooled_sql())
def q_io8(spark, sf_dir):
    from .q_models import RIDGE1
    dev = device_rows(spark, sf_dir, "ID", "price", "gpu_model")
    path = scratch_path(spark, f"io8/{uuid.uuid4().hex[:8]}")
    n = dev.count()

    def compute():
        return cv.oof_predictions(cv.cv_predictions_closed(dev, RIDGE1, roles=("val",)))
    first = io.cached_oof(spark, path, "ridge1", compute, n)
    second = io.cached_oof(spark, path, "ridge1", compute, n)   # reused: same row count
    return rounded(second.agg(F.count(F.lit(1)).alias("n"), cv.rmse_expr("y", "oof").alias("pooled_rmse"))
                   .select("*", F.lit(first.count()).cast("long").alias("n_first")))


@query("io6_run_metadata", with_ctes(
    "SELECT count(*) FILTER (split = 'dev') AS n_dev, count(*) FILTER (split = 'holdout') AS n_holdout, "
    "round(sqrt(avg((price - predicted_price) ^ 2) FILTER (split = 'dev')), 4) AS train_rmse, "
    "round(avg(abs(price - predicted_price)) FILTER (split = 'dev'), 4) AS train_mae, "
    "round(sqrt(avg((price - predicted_price) ^ 2) FILTER (split = 'holdout')), 4) AS holdout_rmse, "
    "round(avg(abs(price - predicted_price)) FILTER (split = 'holdout'), 4) AS holdout_mae FROM sc", *_ONE_FACTOR))
def q_io6(spark, sf_dir):
    """IO6: the metadata that a training run writes, read back from its file."""
    from .train import train_job
    cfg = {"name": "one_factor", "kind": "single", "seed": 42, "members": [{"model": "ridge", "hyperparameters": {"alpha": 10.0}}]}
    out = scratch_path(spark, f"io6/{uuid.uuid4().hex[:8]}")
    train_job(spark, sf_dir, cfg, out_dir=out, columns=["ID", "gpu_model", "price"])
    fields = ("n_dev", "n_holdout", "train_rmse", "train_mae", "holdout_rmse", "holdout_mae")
    meta = spark.read.text(f"{out}/metadata")
    return meta.select(*[F.get_json_object("value", f"$.{f}").cast("long" if f.startswith("n_") else "double").alias(f) for f in fields])


@query("io9_result_tables", with_ctes(
    "SELECT f.fmt, count(*) AS n, round(sum(price), 2) AS total FROM device CROSS JOIN (SELECT unnest(['parquet', 'csv', 'json']) AS fmt) f GROUP BY f.fmt"))
def q_io9(spark, sf_dir):
    """IO9: the frame's prices written in every format and read again."""
    d, run = device_frame(spark, sf_dir).select("ID", "price"), uuid.uuid4().hex[:8]
    out = None
    for fmt in ("parquet", "csv", "json"):
        path = io.write_table(d, scratch_path(spark, f"io9/{run}/{fmt}"), fmt)
        reader = spark.read.schema(d.schema)
        back = reader.option("header", True).csv(path) if fmt == "csv" else reader.json(path) if fmt == "json" else reader.parquet(path)
        row = back.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("total")).select(F.lit(fmt).alias("fmt"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def _logged():
    from .q_models import BACKFIT, MEAN, MEDIAN, RIDGE1
    return (("mean", MEAN), ("median", MEDIAN), ("ridge1", RIDGE1), ("backfit", BACKFIT))


def _leaderboard_sql():
    ctes = [closed_form_preds_ctes(spec, prefix=f"{name}_") for name, spec in _logged()]
    rows = " UNION ALL ".join(f"SELECT 'exp_000{i + 1}' AS experiment_id, s.* FROM ({cv_summary_sql(f'{name}_preds', name)}) s"
                              for i, (name, _) in enumerate(_logged()))
    return with_ctes("SELECT experiment_id, model, 'closed_form' AS preprocessing, round(val_rmse, 4) AS validation_rmse, "
                     "round(val_rmse_std, 4) AS validation_rmse_std, round(train_rmse, 4) AS train_rmse, round(val_mae, 4) AS validation_mae, "
                     f"'cv closed form' AS notes FROM ({rows})", *ctes)


def _tracked(spark, sf_dir):
    dev = device_rows(spark, sf_dir, "ID", "price", "gpu_model", "device_type")
    tracker = io.ExperimentTracker(spark, scratch_path(spark, f"io10/{uuid.uuid4().hex[:8]}/results"))
    for name, spec in _logged():
        summary, secs = cv.timed(lambda sp=spec, nm=name: written(cv.cv_summary(cv.cv_predictions_closed(dev, sp), nm), "summary"))
        tracker.append(summary, model=name, features={"levels": spec.get("levels", spec.get("level"))}, preprocessing="closed_form",
                       hyperparameters=spec, seed=42, validation_strategy="5-fold hash", fit_seconds=round(secs, 2), notes="cv closed form")
    return tracker


def logged_experiments(spark, sf_dir):
    """The log of four cross-validated models."""
    return _tracked(spark, sf_dir).load()


@query("io10_io11_leaderboard", _leaderboard_sql())
def q_io10(spark, sf_dir):
    return _tracked(spark, sf_dir).leaderboard(15)


def _streamed(spark, d, model):
    """``d`` written as arriving files, four at least and as many as it has partitions, and scored as a stream."""
    from ..streaming.score_stream import score_stream
    run = uuid.uuid4().hex[:8]
    src = scratch_path(spark, f"st1/{run}/incoming")
    raw = d.drop("split", "price")
    raw = raw if raw.rdd.getNumPartitions() >= 4 else raw.repartition(4)
    raw.write.mode("overwrite").parquet(src)
    out = scratch_path(spark, f"st1/{run}/scored")
    q = score_stream(spark, src, raw.schema, model, out, scratch_path(spark, f"st1/{run}/ckpt"))
    q.awaitTermination()
    return rounded(spark.read.parquet(out).select("ID", "predicted_price"))


@query("st1_streaming_scoring")
def q_st1(spark, sf_dir):
    return _streamed(spark, *_fit_ridge(spark, sf_dir))


@query("st1_one_factor_streaming", sql_round(with_ctes("SELECT ID, predicted_price FROM sc", *_ONE_FACTOR), ["predicted_price"]))
def q_st1_one(spark, sf_dir):
    return _streamed(spark, *_fit_one_factor(spark, sf_dir))


# ----------------------------------------------------------------------------
# CV9: learning curve with the closed-form ridge (oracle-checked)
# ----------------------------------------------------------------------------
LC_SEEDS = (42, 7, 2024)
LC_VAL_SHARE = 0.15             # validation block, as a share of all rows
LC_PARTS = (1, 2, 4, 8, 16, 32)     # training sizes in 32nds of the pool: the last is the whole pool
ALPHA = 100.0


def lc_sizes(n: int) -> tuple[int, list[int]]:
    n_val = int(n * LC_VAL_SHARE)
    return n_val, [(n - n_val) * p // LC_PARTS[-1] for p in LC_PARTS]


def learning_curve_points(spark, sf_dir):
    d = device_rows(spark, sf_dir, "ID", "gpu_model", "price")
    n_val, each = lc_sizes(d.count())
    parts = []
    for s in LC_SEEDS:
        p = nested_prefixes(d, each, n_val, seed=s).withColumn("seed", F.lit(s))
        parts.append(p)
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    sizes = F.array(*[F.lit(x) for x in each])
    train = (allp.filter((F.col("role") == "pool") & F.col("min_size").isNotNull())
             .withColumn("n_train", F.explode(F.filter(sizes, lambda x: x >= F.col("min_size")))))
    model = fit_one_factor_ridge(train, ["seed", "n_train"], "price", "gpu_model", ALPHA)
    val = allp.filter(F.col("role") == "val").withColumn("n_train", F.explode(sizes))
    scored = model.predict(val, "pred")
    return scored.groupBy("seed", "n_train").agg(F.sqrt(F.avg(F.pow(F.col("price") - F.col("pred"), 2))).alias("val_rmse"))


def learning_curve(points):
    """mean / sd (ddof=1) per size; rmse^2 = a + b / n fitted over all points; extrapolation to twice the pool; last drop."""
    per = points.groupBy("n_train").agg(F.avg("val_rmse").alias("mean_rmse"),
                                        F.stddev_samp("val_rmse").alias("sd_rmse"))
    fit = points.agg(F.regr_intercept(F.pow("val_rmse", 2), 1.0 / F.col("n_train")).alias("a"),
                     F.regr_slope(F.pow("val_rmse", 2), 1.0 / F.col("n_train")).alias("b"))
    top = per.agg(F.max_by("mean_rmse", "n_train").alias("last"), F.max("n_train").alias("n")).crossJoin(F.broadcast(fit))   # one row each
    half = per.agg(F.sort_array(F.collect_list(F.struct("n_train", "mean_rmse")), asc=False)[1]["mean_rmse"].alias("before"))
    one = top.crossJoin(half).select("a", "b", F.sqrt(F.col("a") + F.col("b") / (2.0 * F.col("n"))).alias("extrapolated_rmse"),
                                     (F.col("before") - F.col("last")).alias("last_drop"))
    return per.crossJoin(F.broadcast(one)).select("n_train", "mean_rmse", "sd_rmse", "a", "b", "extrapolated_rmse", "last_drop")


def _lc_sql():
    ranked = " UNION ALL ".join(
        f"SELECT {s} AS seed, ID, gpu_model, price, row_number() OVER (ORDER BY {hash_int_sql(s, 'ID')}, ID) AS rk FROM device"
        for s in LC_SEEDS)
    parts = ", ".join(map(str, LC_PARTS))
    ctes = [
        f"sz AS (SELECT count(*) AS n, CAST(floor(count(*) * {LC_VAL_SHARE!r}::DOUBLE) AS BIGINT) AS n_val FROM device)",
        f"zz AS (SELECT n_val, CAST((n - n_val) * p // {LC_PARTS[-1]} AS INTEGER) AS n_train FROM sz CROSS JOIN (SELECT unnest([{parts}]) AS p))",
        f"rk AS ({ranked})",
        "tr AS (SELECT r.*, z.n_train FROM rk r JOIN zz z ON r.rk > z.n_val AND r.rk <= z.n_val + z.n_train)",
        f"cells AS (SELECT seed, n_train, gpu_model, avg(price) AS ybar, count(*) / (count(*) + {ALPHA!r}::DOUBLE) AS w FROM tr GROUP BY ALL)",
        "bb AS (SELECT seed, n_train, sum(w * ybar) / sum(w) AS b FROM cells GROUP BY ALL)",
        "vl AS (SELECT r.*, z.n_train FROM rk r JOIN zz z ON r.rk <= z.n_val)",
        "pts AS (SELECT v.seed, v.n_train, sqrt(avg((v.price - (bb.b + coalesce(c.w * (c.ybar - bb.b), 0.0))) ^ 2)) AS val_rmse "
        "FROM vl v JOIN bb ON bb.seed = v.seed AND bb.n_train = v.n_train LEFT JOIN cells c ON c.seed = v.seed AND "
        "c.n_train = v.n_train AND c.gpu_model = v.gpu_model GROUP BY v.seed, v.n_train)",
        "per AS (SELECT n_train, avg(val_rmse) AS mean_rmse, stddev_samp(val_rmse) AS sd_rmse FROM pts GROUP BY n_train)",
        "fit AS (SELECT regr_intercept(val_rmse ^ 2, 1.0 / n_train) AS a, regr_slope(val_rmse ^ 2, 1.0 / n_train) AS b FROM pts)",
        "lst AS (SELECT n_train, mean_rmse, row_number() OVER (ORDER BY n_train DESC) AS rn FROM per)",
    ]
    body = ("SELECT n_train, mean_rmse, sd_rmse, a, b, sqrt(a + b / (2.0 * (SELECT max(n_train) FROM per))) AS extrapolated_rmse, "
            "(SELECT mean_rmse FROM lst WHERE rn = 2) - (SELECT mean_rmse FROM lst WHERE rn = 1) AS last_drop FROM per CROSS JOIN fit")
    return with_ctes(body, *ctes)


@query("cv9_learning_curve", sql_round(_lc_sql(), ["mean_rmse", "sd_rmse", "a", "b", "extrapolated_rmse", "last_drop"]))
def q_cv9(spark, sf_dir):
    return rounded(learning_curve(learning_curve_points(spark, sf_dir)))
