"""Registered queries: attribution and reports (SH1-SH3, SH5-SH9).

Explained rows: SP5 sample of ``N_SAMPLE`` holdout rows, the documented default, (hash order). Members fitted on
dev: A = backfitted additive model over (gpu_model, device_type); B =
one-factor ridge on device_type. Ensemble weights are the reference's fixed
final-blend weights.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.portable import hash_int, hash_int_sql, unit_sql
from ..operators import explain as sh
from ..operators.group_models import fit_backfit, fit_one_factor_ridge
from ..operators.split import make_dev_holdout
from ..sources.tables import DEVICE_COLS, device_frame, device_rows
from .registry import query, rounded, sql_round
from .sqlgen import with_ctes

LEVELS = ["gpu_model", "device_type"]
LAM, SWEEPS = 5.0, 3
ALPHA_B = 10.0
# The blend's weights and the default number of explained rows.
W_A, W_B = 0.6283, 0.3717
N_SAMPLE = 2000


def setup(spark, sf_dir):
    d = make_dev_holdout(device_frame(spark, sf_dir)).select("ID", "gpu_model", "device_type", "price", "split",
                                                              F.lit(0).alias("m"))
    dev = d.filter(F.col("split") == "dev")
    hold = d.filter(F.col("split") == "holdout")
    sample = hold.withColumn("_h", hash_int(42, F.col("ID"))).orderBy("_h", "ID").limit(N_SAMPLE).drop("_h")
    a = fit_backfit(dev, ["m"], "price", LEVELS, LAM, SWEEPS)
    b = fit_one_factor_ridge(dev, ["m"], "price", "device_type", ALPHA_B)
    return sample, a, b


def attributions(spark, sf_dir):
    sample, a, b = setup(spark, sf_dir)
    la, ba = sh.additive_attribution(a, sample)
    lb, bb = sh.additive_attribution(b, sample)
    long, base = sh.ensemble_attribution([(W_A, la, ba), (W_B, lb, bb)])
    preds = a.predict(sample, "pa").join(b.predict(sample, "pb").select("ID", "pb"), "ID") \
        .withColumn("pred", F.lit(W_A) * F.col("pa") + F.lit(W_B) * F.col("pb"))
    return sample, a, b, long, base, preds


# ---------------------------------------------------------------------------- SQL twins
SPLIT = f"CASE WHEN {unit_sql(42, 'ID')} < 0.2::DOUBLE THEN 'holdout' ELSE 'dev' END"


def _fit_ctes() -> list[str]:
    ctes = [
        f"hs AS (SELECT ID, price AS y, gpu_model, device_type, {SPLIT} AS role FROM device)",
        "dv AS (SELECT * FROM hs WHERE role = 'dev')",
        f"smp AS (SELECT * FROM hs WHERE role = 'holdout' ORDER BY {hash_int_sql(42, 'ID')}, ID LIMIT {N_SAMPLE})",
        "bfb AS (SELECT avg(y) AS b FROM dv)",
    ]
    cur = {lv: None for lv in LEVELS}
    step = 0
    for _ in range(SWEEPS):
        for lv in LEVELS:
            joins, resid = "", "t.y - bfb.b"
            for o in LEVELS:
                if o != lv and cur[o] is not None:
                    joins += f" LEFT JOIN {cur[o]} eo_{o} ON eo_{o}.{o} = t.{o}"
                    resid += f" - coalesce(eo_{o}.e, 0.0)"
            name = f"bf{step}_{lv}"
            ctes.append(f"{name} AS (SELECT t.{lv}, sum({resid}) / (count(*) + {LAM!r}::DOUBLE) AS e FROM dv t "
                        f"CROSS JOIN bfb{joins} GROUP BY t.{lv})")
            cur[lv] = name
            step += 1
    ctes += [
        f"rc AS (SELECT device_type, avg(y) AS ybar, count(*) / (count(*) + {ALPHA_B!r}::DOUBLE) AS w FROM dv GROUP BY device_type)",
        "rb AS (SELECT sum(w * ybar) / sum(w) AS b FROM rc)",
        "re AS (SELECT rc.device_type, rc.w * (rc.ybar - rb.b) AS e FROM rc CROSS JOIN rb)",
        "ctr AS (SELECT s.ID, s.gpu_model, s.device_type, bfb.b AS ba, coalesce(g.e, 0.0) AS a_g, coalesce(dd.e, 0.0) AS a_d, "
        "rb.b AS bb, coalesce(r.e, 0.0) AS b_d FROM smp s CROSS JOIN bfb CROSS JOIN rb "
        f"LEFT JOIN {cur['gpu_model']} g ON g.gpu_model = s.gpu_model LEFT JOIN {cur['device_type']} dd ON dd.device_type = s.device_type "
        "LEFT JOIN re r ON r.device_type = s.device_type)",
        "mn AS (SELECT avg(a_g) AS m_ag, avg(a_d) AS m_ad, avg(b_d) AS m_bd, avg(ba) AS m_ba, avg(bb) AS m_bb FROM ctr)",
        f"base AS (SELECT {W_A!r} * (m_ba + m_ag + m_ad) + {W_B!r} * (m_bb + m_bd) AS base FROM mn)",
        f"lng AS (SELECT ID, 'gpu_model' AS feature, gpu_model AS value, {W_A!r} * (a_g - m_ag) AS shap FROM ctr, mn "
        f"UNION ALL SELECT ID, 'device_type', device_type, {W_A!r} * (a_d - m_ad) + {W_B!r} * (b_d - m_bd) FROM ctr, mn)",
        f"prd AS (SELECT ID, {W_A!r} * (ba + a_g + a_d) + {W_B!r} * (bb + b_d) AS pred FROM ctr)",
    ]
    return ctes


FIT = _fit_ctes()


# ---------------------------------------------------------------------------- SH1
@query("sh1_source_feature_mapping", with_ctes(
    "SELECT col AS column, CASE WHEN strpos(col, '__lvl_') > 0 THEN split_part(col, '__lvl_', 1) "
    "WHEN starts_with(col, 'missingindicator_') THEN substr(col, 18) WHEN starts_with(col, 'cat__') THEN substr(col, 6) "
    "WHEN starts_with(col, 'num__') THEN substr(col, 6) ELSE col END AS feature FROM names",
    f"names AS (SELECT DISTINCT 'gpu_model__lvl_' || gpu_model AS col FROM device WHERE {unit_sql(42, 'ID')} >= 0.2::DOUBLE "
    f"UNION SELECT DISTINCT 'brand__lvl_' || brand FROM device WHERE {unit_sql(42, 'ID')} >= 0.2::DOUBLE "
    "UNION SELECT 'missingindicator_battery_wh' UNION SELECT 'cat__os' UNION SELECT 'num__ram_gb' UNION SELECT 'res_ppi')"))
def q_sh1(spark, sf_dir):
    dev = make_dev_holdout(device_frame(spark, sf_dir)).filter(F.col("split") == "dev")
    names = dev.select(F.concat(F.lit("gpu_model__lvl_"), "gpu_model").alias("col")).union(
        dev.select(F.concat(F.lit("brand__lvl_"), "brand").alias("col"))).distinct()
    fixed = spark.createDataFrame([(n,) for n in ("missingindicator_battery_wh", "cat__os", "num__ram_gb", "res_ppi")], "col string")
    allc = names.unionByName(fixed)
    return allc.select(F.col("col").alias("column"), sh.source_feature_col(F.col("col")).alias("feature"))


# ---------------------------------------------------------------------------- SH2
@query("sh2_aggregate_by_feature", sql_round(with_ctes(
    "SELECT c.ID, 'device_type' AS feature, c.b_d - (SELECT sum(p * e) FROM (SELECT re.e, coalesce(sh.p, 0.0) AS p FROM re "
    "LEFT JOIN (SELECT device_type, count(*) / (SELECT count(*) FROM smp) AS p FROM smp GROUP BY device_type) sh "
    "USING (device_type))) AS shap FROM ctr c", *FIT), ["shap"]))
def q_sh2(spark, sf_dir):
    sample, _, b = setup(spark, sf_dir)
    return rounded(sh.aggregate_sparse(*sh.sparse_attribution(b, sample, "device_type"), sample))


# ---------------------------------------------------------------------------- SH3
@query("sh3_linear_attribution", sql_round(with_ctes(
    "SELECT ID, feature, value, shap, base FROM (SELECT ID, 'gpu_model' AS feature, gpu_model AS value, a_g - m_ag AS shap FROM ctr, mn "
    "UNION ALL SELECT ID, 'device_type', device_type, a_d - m_ad FROM ctr, mn) CROSS JOIN (SELECT m_ba + m_ag + m_ad AS base FROM mn)",
    *FIT), ["shap", "base"]))
def q_sh3(spark, sf_dir):
    sample, a, _ = setup(spark, sf_dir)
    long, base = sh.additive_attribution(a, sample)
    return rounded(long.select("*", base.select("base").scalar().alias("base")))


# ---------------------------------------------------------------------------- SH5 / SH6
@query("sh5_ensemble_attribution", sql_round(with_ctes(
    "SELECT ID, feature, value, shap, (SELECT base FROM base) AS base FROM lng", *FIT), ["shap", "base"]))
def q_sh5(spark, sf_dir):
    _, _, _, long, base, _ = attributions(spark, sf_dir)
    return rounded(long.select("*", base.select("base").scalar().alias("base")))


@query("sh6_additivity_check", sql_round(with_ctes(
    "SELECT count(*) AS n, max(abs((SELECT base FROM base) + s - pred)) AS max_abs_diff FROM "
    "(SELECT ID, sum(shap) AS s FROM lng GROUP BY ID) JOIN prd USING (ID)", *FIT), ["max_abs_diff"]))
def q_sh6(spark, sf_dir):
    _, _, _, long, base, preds = attributions(spark, sf_dir)
    return rounded(sh.additivity_check(long, base, preds))


# ---------------------------------------------------------------------------- SH7-SH9
RANK_SQL = ("SELECT feature, avg(abs(shap)) AS mean_abs_shap, avg(shap) AS mean_shap, "
            "CAST(row_number() OVER (ORDER BY avg(abs(shap)) DESC, feature) AS INTEGER) AS rank FROM lng GROUP BY feature")


@query("sh7_global_ranking", sql_round(with_ctes(RANK_SQL, *FIT), ["mean_abs_shap", "mean_shap"]))
def q_sh7(spark, sf_dir):
    _, _, _, long, _, _ = attributions(spark, sf_dir)
    return rounded(sh.global_ranking(long))


@query("sh8_effect_by_level", sql_round(with_ctes(
    "SELECT l.feature, l.value AS level, avg(l.shap) AS mean_shap, count(*) AS size FROM lng l JOIN "
    "(SELECT feature FROM (SELECT r.feature, r.rank FROM rk r JOIN (SELECT feature, count(DISTINCT value) AS nd FROM lng GROUP BY feature) d "
    "USING (feature) WHERE r.rank <= 18 AND d.nd <= 16 ORDER BY r.rank LIMIT 6)) k USING (feature) GROUP BY l.feature, l.value",
    *FIT, f"rk AS ({RANK_SQL})"), ["mean_shap"]))
def q_sh8(spark, sf_dir):
    _, _, _, long, _, _ = attributions(spark, sf_dir)
    return rounded(sh.effect_by_level(long, sh.global_ranking(long)))


@query("sh9_local_report", sql_round(with_ctes(
    "SELECT feature, value, shap, abs(shap) AS abs_shap, CASE WHEN shap >= 0 THEN 'up' ELSE 'down' END AS direction, "
    "CAST(row_number() OVER (PARTITION BY shap >= 0 ORDER BY abs(shap) DESC, feature) AS INTEGER) AS pos FROM lng "
    f"WHERE ID = (SELECT ID FROM smp ORDER BY {hash_int_sql(42, 'ID')}, ID LIMIT 1)", *FIT),
    ["shap", "abs_shap"]))
def q_sh9(spark, sf_dir):
    sample, _, _, long, _, _ = attributions(spark, sf_dir)
    first = sample.withColumn("_h", hash_int(42, F.col("ID"))).orderBy("_h", "ID").select("ID").first()["ID"]
    return rounded(sh.local_report(long, first).withColumn("pos", F.col("pos").cast("int")))


# ---------------------------------------------------------------------------- fitted pipelines
def _ridge_pipeline(spark, sf_dir):
    from ..operators.split import sample_rows
    from ..operators.stages import build_model
    d = make_dev_holdout(device_rows(spark, sf_dir, *DEVICE_COLS))
    model = build_model("ridge", preprocessor="levels_plus", alpha=100.0).fit(d.filter(F.col("split") == "dev"))
    sample = sample_rows(d.filter(F.col("split") == "holdout"), N_SAMPLE)
    return model, sample


@query("sh3_pipeline_attribution")
def q_sh3_pipeline(spark, sf_dir):
    """Attribution of the fitted ridge pipeline by engineered feature, with its additivity error."""
    model, sample = _ridge_pipeline(spark, sf_dir)
    long, base, _ = sh.linear_attribution(model, sample)
    chk = sh.additivity_check(long, base, model.transform(sample).select("ID", F.col("prediction").alias("pred"))).first()
    return rounded(sh.global_ranking(long).select("*", F.lit(chk["max_abs_diff"]).alias("max_abs_diff"), F.lit(chk["n"]).alias("n")))


@query("sh7_column_ranking")
def q_sh7_columns(spark, sf_dir):
    """Encoded columns of the fitted ridge pipeline by mean |phi|."""
    model, sample = _ridge_pipeline(spark, sf_dir)
    return rounded(sh.linear_attribution(model, sample)[2])
