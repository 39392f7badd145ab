"""Registered queries: dataset audit (AU1-AU12) over the engineered device frame."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.portable import unit_sql
from ..operators import audit as au
from ..operators import diagnostics as dg
from ..operators import features as fe
from ..operators.split import make_dev_holdout
from ..sources.tables import DEVICE_COLS, device_frame, device_rows
from .q_diag import edges_sql, label_sql
from .registry import query, rounded, sql_round
from .sqlgen import with_ctes

PROFILE = [("ID", "string"), ("brand", "string"), ("model_line", "string"), ("cpu_family", "string"),
           ("battery_wh", "double"), ("psu_watts", "double"), ("ram_gb", "double"), ("cpu_threads", "int"),
           ("res_ppi", "double"), ("price", "double")]

ENG_SQL = """SELECT *, string_split(model, ' ')[2] AS model_line,
  regexp_replace(regexp_replace(cpu_model, '[-\\s]?\\d{3,}$', ''), '^\\s+|\\s+$', '', 'g') AS cpu_family,
  CAST(coalesce(battery_wh > 0, false) AS INTEGER) AS has_battery,
  nullif(CAST(battery_wh AS DOUBLE), 0.0) AS battery_wh_n, nullif(CAST(psu_watts AS DOUBLE), 0.0) AS psu_watts_n,
  sqrt(TRY_CAST(string_split(resolution, 'x')[1] AS DOUBLE) ^ 2 + TRY_CAST(string_split(resolution, 'x')[2] AS DOUBLE) ^ 2)
    / nullif(CAST(display_size_in AS DOUBLE), 0.0) AS res_ppi
FROM device"""
ENG = [f"eng0 AS ({ENG_SQL})",
       "eng AS (SELECT * EXCLUDE (battery_wh, psu_watts, battery_wh_n, psu_watts_n), battery_wh_n AS battery_wh, "
       "psu_watts_n AS psu_watts FROM eng0)"]


def eng(spark, sf_dir):
    return fe.engineer(device_frame(spark, sf_dir), drop=())


@query("au1_column_profile", sql_round(with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS col_name, '{t}' AS dtype, CAST(count(*) - count({c}) AS BIGINT) AS n_missing, "
    f"count(DISTINCT {c}) AS n_distinct, count(DISTINCT {c}) / (SELECT count(*) FROM eng) * 100.0 AS pct_unique FROM eng"
    for c, t in PROFILE), *ENG), ["pct_unique"]))
def q_au1(spark, sf_dir):
    return rounded(au.column_profile(eng(spark, sf_dir), [c for c, _ in PROFILE]))


FEATS_NO_TARGET = [c for c in DEVICE_COLS if c not in ("ID", "price")]


def _dup_sql(cols, name):
    return (f"SELECT '{name}' AS scope, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicates FROM "
            f"(SELECT count(*) AS c FROM device GROUP BY {', '.join(cols)})")


@query("au2_duplicate_counts", with_ctes(" UNION ALL ".join([
    _dup_sql(DEVICE_COLS, "full_row"), _dup_sql([c for c in DEVICE_COLS if c != "ID"], "ignoring_id"),
    _dup_sql(FEATS_NO_TARGET, "features_only")])))
def q_au2(spark, sf_dir):
    return au.duplicate_counts(device_frame(spark, sf_dir))


AU3_COLS = ["ID", "brand", "battery_wh", "psu_watts", "res_ppi", "price"]


@query("au3_key_audit", with_ctes(
    "SELECT count(DISTINCT ID) = count(*) AS key_unique, min(ID) AS key_min, max(ID) AS key_max, "
    "CAST(" + " + ".join(f"count(*) - count({c})" for c in AU3_COLS) + " AS BIGINT) AS missing_cells FROM eng", *ENG))
def q_au3(spark, sf_dir):
    return au.key_audit(eng(spark, sf_dir).select(*AU3_COLS))


SPEAR = ["ram_gb", "cpu_threads", "gpu_tier", "weight_kg", "cpu_base_ghz", "battery_wh", "res_ppi"]


def _spear_sql():
    parts = []
    for c in SPEAR:
        parts.append(
            f"SELECT '{c}' AS col_name, corr(rx, ry) AS rho, abs(corr(rx, ry)) AS abs_rho FROM ("
            f"SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, "
            f"rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM "
            f"(SELECT CAST({c} AS DOUBLE) AS x, price AS y FROM eng WHERE {c} IS NOT NULL))")
    return " UNION ALL ".join(parts)


@query("au4_spearman", sql_round(with_ctes(_spear_sql(), *ENG), ["rho", "abs_rho"]))
def q_au4(spark, sf_dir):
    return rounded(au.spearman_with_target(eng(spark, sf_dir), SPEAR))


@query("au5_target_by_decile", sql_round(with_ctes(
    f"SELECT {label_sql('weight_kg', 'ed.e')} AS decile, count(*) AS n, avg(price) AS mean_target FROM device "
    f"CROSS JOIN (SELECT {edges_sql('weight_kg', 'device')} AS e) ed GROUP BY 1"), ["mean_target"]))
def q_au5(spark, sf_dir):
    d = dg.qcut(device_frame(spark, sf_dir).select("weight_kg", "price"), "weight_kg", 10, "decile")
    return rounded(d.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.avg("price").alias("mean_target")))


PCTS = (0.01, 0.25, 0.5, 0.75, 0.95, 0.99)


@query("au6_describe_target", sql_round(with_ctes(
    "SELECT count(price) AS count, avg(price) AS mean, stddev_samp(price) AS std, min(price) AS min, max(price) AS max, "
    "skewness(price) AS skew, " + ", ".join(f"quantile_cont(price, {p}) AS p{int(round(p * 100)):02d}" for p in PCTS)
    + " FROM device"), ["mean", "std", "min", "max", "skew"] + [f"p{int(round(p * 100)):02d}" for p in PCTS]))
def q_au6(spark, sf_dir):
    return rounded(au.describe(device_frame(spark, sf_dir), "price", PCTS))


def _hist_sql(expr, name):
    return (f"SELECT '{name}' AS series, b AS bin, mn + b * w AS lo, mn + (b + 1) * w AS hi, count(*) AS n FROM "
            f"(SELECT CAST(least(floor((v - mn) / w), 79) AS INTEGER) AS b, mn, w FROM "
            f"(SELECT {expr} AS v FROM device) CROSS JOIN (SELECT min({expr}) AS mn, (max({expr}) - min({expr})) / 80 AS w FROM device)) "
            "GROUP BY b, mn, w")


@query("au7_histograms", sql_round(with_ctes(_hist_sql("price", "price") + " UNION ALL " + _hist_sql("ln(price)", "log_price")),
                                   ["lo", "hi"]))
def q_au7(spark, sf_dir):
    d = device_rows(spark, sf_dir, "price")
    return rounded(au.histogram(d, F.col("price"), 80, "price").unionByName(au.histogram(d, F.log("price"), 80, "log_price")))


RATIO_COLS = ["model_line", "brand", "gpu_model", "cpu_family", "device_type"]


def _ratio_sql(cols, src, y="price"):
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS col_name, count(*) AS n_levels, sum(n * (ym - m) ^ 2) / any_value(NN) AS between_var, "
            f"any_value(v) * (count(*) - 1) / any_value(NN) AS expected_if_noise, "
            f"(sum(n * (ym - m) ^ 2) / any_value(NN)) / (any_value(v) * (count(*) - 1) / any_value(NN)) AS ratio FROM "
            f"(SELECT CAST({c} AS VARCHAR) AS lv, count(*) AS n, avg({y}) AS ym FROM {src} GROUP BY 1) "
            f"CROSS JOIN (SELECT count(*) AS NN, avg({y}) AS m, var_samp({y}) AS v FROM {src}) GROUP BY m")
    return " UNION ALL ".join(parts)


@query("au8_variance_ratio", sql_round(with_ctes(_ratio_sql(RATIO_COLS, "eng"), *ENG),
                                       ["between_var", "expected_if_noise", "ratio"]))
def q_au8(spark, sf_dir):
    return rounded(au.variance_ratio(eng(spark, sf_dir), RATIO_COLS))


@query("au9_conditional_ratio", sql_round(with_ctes(
    _ratio_sql(["cell"], "cr", "r").replace("SELECT 'cell' AS col_name", "SELECT 'cpu_model|cpu_family' AS col_name"), *ENG,
    "cr AS (SELECT cpu_family || '|' || cpu_model AS cell, price - avg(price) OVER (PARTITION BY cpu_family) AS r FROM eng)"),
    ["between_var", "expected_if_noise", "ratio"]))
def q_au9(spark, sf_dir):
    return rounded(au.conditional_variance_ratio(eng(spark, sf_dir), "cpu_model", "cpu_family"))


@query("au10_crosstab", with_ctes(
    "SELECT device_type, count(*) FILTER (WHERE has_battery = 0) AS n_0, count(*) FILTER (WHERE has_battery = 1) AS n_1 "
    "FROM eng GROUP BY device_type", *ENG))
def q_au10(spark, sf_dir):
    return au.crosstab(eng(spark, sf_dir), "device_type", "has_battery")


@query("au11_box_stats", sql_round(with_ctes(
    "SELECT q.gpu_tier, q.n, q.q1, q.median, q.q3, min(CASE WHEN d.price >= q.q1 - 1.5 * (q.q3 - q.q1) THEN d.price END) AS whisker_lo, "
    "max(CASE WHEN d.price <= q.q3 + 1.5 * (q.q3 - q.q1) THEN d.price END) AS whisker_hi FROM device d JOIN "
    "(SELECT gpu_tier, count(*) AS n, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median, "
    "quantile_cont(price, 0.75) AS q3 FROM device GROUP BY gpu_tier) q ON q.gpu_tier = d.gpu_tier "
    "GROUP BY q.gpu_tier, q.n, q.q1, q.median, q.q3"), ["q1", "median", "q3", "whisker_lo", "whisker_hi"]))
def q_au11(spark, sf_dir):
    return rounded(au.box_stats(device_frame(spark, sf_dir), "gpu_tier"))


@query("au12_split_sanity", sql_round(with_ctes(
    f"SELECT CASE WHEN {unit_sql(42, 'ID')} < 0.2::DOUBLE THEN 'holdout' ELSE 'dev' END AS split, count(*) AS n, "
    "avg(price) AS mean_target, stddev_samp(price) AS sd_target FROM device GROUP BY 1"), ["mean_target", "sd_target"]))
def q_au12(spark, sf_dir):
    return rounded(au.split_sanity(make_dev_holdout(device_frame(spark, sf_dir))))
