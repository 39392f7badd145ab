"""Registered queries: learned encodings (EN1-EN8, EN11, EN12, EN17).

Fit rows are the dev split with the label 'Brand#1' taken as missing, so that
transform time sees an unseen category; no row is left out. ``brand_gap`` is the
brand with NULL wherever the discount is zero, to exercise missing categories.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.portable import hash_int_sql, unit_sql
from ..operators import encode as en
from ..operators import features as fe
from ..operators.split import make_dev_holdout
from ..sources.tables import device_frame
from .registry import query, rounded, sql_round
from .sqlgen import with_ctes

TEXT = ["device_type", "brand_gap", "os", "gpu_model", "model_line"]
NUMS = ["battery_wh", "psu_watts", "power_watts", "ram_gb", "cpu_threads", "res_ppi", "weight_kg"]


def base(spark, sf_dir):
    d = fe.engineer(device_frame(spark, sf_dir))
    d = d.withColumn("brand_gap", F.when(F.col("has_battery") == 1, F.col("brand")))
    return make_dev_holdout(d)


def fit_rows(d):
    hide = [F.when(F.col(c) != "Brand#1", F.col(c)).alias(c) if c in ("brand", "brand_gap") else F.col(c) for c in d.columns]
    return d.filter(F.col("split") == "dev").select(*hide)


# SQL twin of base(): engineered columns needed here, computed directly
BASE_SQL = f"""SELECT ID, price, brand, device_type, os, gpu_model,
  string_split(model, ' ')[2] AS model_line,
  CASE WHEN coalesce(battery_wh > 0, false) THEN brand END AS brand_gap,
  nullif(CAST(battery_wh AS DOUBLE), 0.0) AS battery_wh, nullif(CAST(psu_watts AS DOUBLE), 0.0) AS psu_watts,
  CAST(charger_watts AS DOUBLE) + CAST(psu_watts AS DOUBLE) AS power_watts, ram_gb, cpu_threads, gpu_tier,
  sqrt(TRY_CAST(string_split(resolution, 'x')[1] AS DOUBLE) ^ 2 + TRY_CAST(string_split(resolution, 'x')[2] AS DOUBLE) ^ 2)
    / nullif(CAST(display_size_in AS DOUBLE), 0.0) AS res_ppi, weight_kg,
  CASE WHEN {unit_sql(42, 'ID')} < 0.2::DOUBLE THEN 'holdout' ELSE 'dev' END AS split
FROM device"""
FIT_SQL = ("SELECT * REPLACE (CASE WHEN brand <> 'Brand#1' THEN brand END AS brand, "
           "CASE WHEN brand_gap <> 'Brand#1' THEN brand_gap END AS brand_gap) FROM base WHERE split = 'dev'")


def _long_sql(src: str, cols: list[str], key: bool = False) -> str:
    k = "ID, " if key else ""
    return " UNION ALL ".join(f"SELECT {k}'{c}' AS col_name, CAST({c} AS VARCHAR) AS value FROM {src}" for c in cols)


VOCAB_SQL = (f"SELECT col_name, value, CAST(row_number() OVER (PARTITION BY col_name ORDER BY value) - 1 AS INTEGER) AS idx "
             f"FROM (SELECT DISTINCT col_name, value FROM ({_long_sql('fit', TEXT)}) WHERE value IS NOT NULL)")


def ctes(*more):
    return [f"base AS ({BASE_SQL})", f"fit AS ({FIT_SQL})", *more]


@query("en1_vocabulary", with_ctes("SELECT * FROM vocab", *ctes(f"vocab AS ({VOCAB_SQL})")))
def q_en1_vocab(spark, sf_dir):
    return en.vocabulary(fit_rows(base(spark, sf_dir)), TEXT)


@query("en1_native_codes", with_ctes(
    "SELECT b.ID, " + ", ".join(f"v_{c}.idx AS {c}" for c in TEXT) + " FROM base b " + " ".join(
        f"LEFT JOIN vocab v_{c} ON v_{c}.col_name = '{c}' AND v_{c}.value = b.{c}" for c in TEXT),
    *ctes(f"vocab AS ({VOCAB_SQL})")))
def q_en1_codes(spark, sf_dir):
    d = base(spark, sf_dir)
    v = en.vocabulary(fit_rows(d), TEXT)
    return en.apply_ordinal(d.select("ID", *TEXT), v, TEXT, unknown=None)


@query("en2_missing_sentinel", with_ctes(
    "SELECT coalesce(brand_gap, '__missing__') AS brand_gap, count(*) AS n FROM base GROUP BY 1", *ctes()))
def q_en2(spark, sf_dir):
    d = en.missing_sentinel(base(spark, sf_dir).select("brand_gap"), ["brand_gap"])
    return d.groupBy("brand_gap").agg(F.count(F.lit(1)).alias("n"))


MODE_SQL = ("SELECT col_name, value, n FROM (SELECT col_name, value, count(*) AS n, row_number() OVER "
            "(PARTITION BY col_name ORDER BY count(*) DESC, value ASC) AS rn FROM "
            f"({_long_sql('fit', TEXT)}) WHERE value IS NOT NULL GROUP BY col_name, value) WHERE rn = 1")


@query("en3_most_frequent", with_ctes(MODE_SQL, *ctes()))
def q_en3(spark, sf_dir):
    return en.most_frequent(fit_rows(base(spark, sf_dir)), TEXT)


def _num_stats_sql(cols):
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS col_name, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median, "
            f"CAST(count(*) - count({c}) AS BIGINT) AS n_missing, "
            f"(coalesce(sum(CAST({c} AS DOUBLE)), 0) + (count(*) - count({c})) * coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0)) / count(*) AS mean, "
            f"sqrt(greatest((coalesce(sum(CAST({c} AS DOUBLE) ^ 2), 0) + (count(*) - count({c})) * coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0) ^ 2) / count(*) "
            f"- ((coalesce(sum(CAST({c} AS DOUBLE)), 0) + (count(*) - count({c})) * coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0)) / count(*)) ^ 2, 0)) AS sd_pop "
            "FROM fit")
    return " UNION ALL ".join(parts)


@query("en4_en5_en8_numeric_stats", sql_round(with_ctes(_num_stats_sql(NUMS), *ctes()), ["median", "mean", "sd_pop"]))
def q_en458(spark, sf_dir):
    return rounded(en.numeric_stats(fit_rows(base(spark, sf_dir)), NUMS))


@query("en6_onehot_long", with_ctes(
    "SELECT l.ID, l.col_name || '_' || l.value AS feature, 1.0::DOUBLE AS value FROM "
    f"({_long_sql('base', TEXT, key=True)}) l "
    "JOIN vocab v ON v.col_name = l.col_name AND v.value = l.value", *ctes(f"vocab AS ({VOCAB_SQL})")))
def q_en6(spark, sf_dir):
    d = base(spark, sf_dir)
    v = en.vocabulary(fit_rows(d), TEXT)
    return en.one_hot_long(d, v, TEXT)


@query("en7_ordinal_codes", with_ctes(
    "SELECT b.ID, " + ", ".join(f"coalesce(v_{c}.idx, -1) AS {c}" for c in TEXT) + " FROM base b " + " ".join(
        f"LEFT JOIN modes m_{c} ON m_{c}.col_name = '{c}' LEFT JOIN vocab v_{c} ON v_{c}.col_name = '{c}' "
        f"AND v_{c}.value = coalesce(b.{c}, m_{c}.value)" for c in TEXT),
    *ctes(f"vocab AS ({VOCAB_SQL})", f"modes AS ({MODE_SQL})")))
def q_en7(spark, sf_dir):
    d = base(spark, sf_dir)
    fit = fit_rows(d)
    modes = {r["col_name"]: r["value"] for r in en.most_frequent(fit, TEXT).collect()}  # one row per column
    v = en.vocabulary(fit, TEXT)
    return en.apply_ordinal(en.impute_text(d.select("ID", *TEXT), modes), v, TEXT, unknown=-1)


def _scaled_sql(cols):
    sel = []
    for c in cols:
        x = f"CAST(b.{c} AS DOUBLE)"
        sel.append(f"(coalesce({x}, s_{c}.median) - s_{c}.mean) / (CASE WHEN s_{c}.sd_pop > 0 THEN s_{c}.sd_pop ELSE 1.0 END) AS {c}")
    joins = " ".join(f"JOIN st s_{c} ON s_{c}.col_name = '{c}'" for c in cols)
    return f"SELECT b.ID, {', '.join(sel)} FROM base b {joins}"


@query("en8_standardized", sql_round(with_ctes(_scaled_sql(NUMS), *ctes(f"st AS ({_num_stats_sql(NUMS)})")), NUMS))
def q_en8(spark, sf_dir):
    d = base(spark, sf_dir)
    prep = en.NumericPrep.fit(fit_rows(d), NUMS, scale=True)
    cols = [(n, e) for n, e in prep.columns() if not n.startswith(en.INDICATOR_PREFIX)]
    return rounded(d.select("ID", *[e.alias(n) for n, e in cols]))


ROUTE_NUMS = ["battery_wh", "ram_gb", "cpu_threads", "gpu_tier", "res_ppi", "weight_kg", "cpu_base_ghz"]


@query("en11_level_routing", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS col_name, CASE WHEN count(DISTINCT CAST({c} AS DOUBLE)) <= 60 THEN 'level' ELSE 'wide' END AS route "
    "FROM fitall" for c in ROUTE_NUMS) + " UNION ALL SELECT 'device_type' AS col_name, 'level' AS route",
    f"fitall AS (SELECT nullif(CAST(battery_wh AS DOUBLE), 0.0) AS battery_wh, ram_gb, cpu_threads, gpu_tier, weight_kg, cpu_base_ghz, "
    "sqrt(TRY_CAST(string_split(resolution, 'x')[1] AS DOUBLE) ^ 2 + TRY_CAST(string_split(resolution, 'x')[2] AS DOUBLE) ^ 2) "
    f"/ nullif(CAST(display_size_in AS DOUBLE), 0.0) AS res_ppi FROM device WHERE {unit_sql(42, 'ID')} >= 0.2::DOUBLE)"))
def q_en11(spark, sf_dir):
    d = make_dev_holdout(fe.engineer(device_frame(spark, sf_dir))).filter(F.col("split") == "dev")
    level, wide = en.route_levels(d, ["device_type"], ROUTE_NUMS)
    rows = [(c, "level") for c in level] + [(c, "wide") for c in wide]
    return spark.createDataFrame(rows, "col_name string, route string")


LVL = [("cpu_threads", True), ("gpu_tier", True), ("ram_gb", True), ("device_type", False), ("brand_gap", False)]


@query("en12_level_labels", with_ctes("SELECT ID, " + ", ".join(
    (f"coalesce(CAST(CAST({c} AS DOUBLE) AS VARCHAR), '__missing__') AS {c}__lvl" if num else
     f"coalesce(CAST({c} AS VARCHAR), '__missing__') AS {c}__lvl") for c, num in LVL) + " FROM base", *ctes()))
def q_en12(spark, sf_dir):
    d = base(spark, sf_dir)
    return d.select("ID", *[en.level_label(c, num).alias(c + en.LEVEL_SUFFIX) for c, num in LVL])


EN17_A = 5.0


@query("en17_ordered_target_stats", sql_round(with_ctes(
    f"SELECT ID, brand, price, (coalesce(sum(price) OVER w, 0) + {EN17_A!r} * (SELECT avg(price) FROM dv)) / "
    f"(count(*) OVER w + {EN17_A!r}) AS ots FROM dv "
    f"WINDOW w AS (PARTITION BY brand ORDER BY {hash_int_sql(42, 'ID')}, ID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
    *ctes("dv AS (SELECT * FROM base WHERE split = 'dev')")), ["price", "ots"]))
def q_en17(spark, sf_dir):
    d = base(spark, sf_dir).filter(F.col("split") == "dev")
    return rounded(en.ordered_target_stats(d, "brand", "price", a=EN17_A))


@query("en17_scoring_statistic", sql_round(with_ctes(
    f"SELECT brand, (sum(price) + {EN17_A!r} * (SELECT avg(price) FROM dv)) / (count(*) + {EN17_A!r}) AS te FROM dv GROUP BY brand",
    *ctes("dv AS (SELECT * FROM base WHERE split = 'dev')")), ["te"]))
def q_en17b(spark, sf_dir):
    d = base(spark, sf_dir).filter(F.col("split") == "dev")
    return rounded(en.target_stats_table(d, "brand", "price", a=EN17_A))
