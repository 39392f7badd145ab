"""Registered queries: sources, splits and row-wise features (IO, SP, FE, PR)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.portable import hash_int, hash_int_sql, unit_sql
from ..operators import features as fe
from ..operators import split as sp
from ..operators.cv import metrics
from ..operators.group_models import fit_one_factor_ridge
from ..sources.tables import DEVICE_COLS, device_frame
from .registry import query, rounded, sql_round
from .sqlgen import with_ctes

DEVICE_DOUBLES = ["ram_gb", "battery_wh", "charger_watts", "psu_watts", "cpu_base_ghz", "cpu_boost_ghz",
                  "display_size_in", "weight_kg", "price"]


# ----------------------------------------------------------------------------
# IO1: the reference-shaped raw table derived from lineitem ⋈ part ⋈ orders
# ----------------------------------------------------------------------------
@query("io1_device_frame", sql_round(with_ctes("SELECT * FROM device"), DEVICE_DOUBLES))
def q_io1(spark, sf_dir):
    return rounded(device_frame(spark, sf_dir))


# ----------------------------------------------------------------------------
# SP1-SP8
# ----------------------------------------------------------------------------
SPLIT_SQL = f"CASE WHEN {unit_sql(42, 'ID')} < 0.2::DOUBLE THEN 'holdout' ELSE 'dev' END"


@query("sp1_dev_holdout_split", with_ctes(f"SELECT ID, {SPLIT_SQL} AS split FROM device"))
def q_sp1(spark, sf_dir):
    return sp.make_dev_holdout(device_frame(spark, sf_dir)).select("ID", "split")


@query("io3_dev_holdout_pieces", sql_round(with_ctes(
    f"SELECT {SPLIT_SQL} AS split, count(*) AS n_rows, avg(price) AS mean_target FROM device GROUP BY 1"),
    ["mean_target"]))
def q_io3(spark, sf_dir):
    x_dev, y_dev, x_hold, y_hold = sp.load_dev_holdout(device_frame(spark, sf_dir))
    dev = y_dev.agg(F.lit("dev").alias("split"), F.count(F.lit(1)).alias("n_rows"), F.avg("price").alias("mean_target"))
    hold = y_hold.agg(F.lit("holdout").alias("split"), F.count(F.lit(1)).alias("n_rows"), F.avg("price").alias("mean_target"))
    return rounded(dev.unionByName(hold))


@query("sp2_kfold_assignment", with_ctes(
    "SELECT ID, CAST(rr.range AS INTEGER) AS repeat, "
    f"CAST({hash_int_sql('(42 + rr.range)', 'ID')} % 5 AS INTEGER) AS fold FROM device CROSS JOIN range(2) rr"))
def q_sp2(spark, sf_dir):
    return sp.assign_folds(device_frame(spark, sf_dir).select("ID"), "ID", k=5, seed=42, repeats=2)


INNER_SEEDS = (42, 7, 2024)


@query("sp3_inner_splits", with_ctes(" UNION ALL ".join(
    f"SELECT {s} AS seed, CASE WHEN {unit_sql(s, 'ID')} < 0.25::DOUBLE THEN 'val' ELSE 'train' END AS part, "
    "count(*) AS n FROM device GROUP BY 1, 2" for s in INNER_SEEDS)))
def q_sp3(spark, sf_dir):
    dev = device_frame(spark, sf_dir).select("ID")
    out = None
    for s in INNER_SEEDS:
        part = sp.hash_split(dev, "ID", 0.25, s, label="part", test_name="val", train_name="train")
        g = part.groupBy(F.lit(s).alias("seed"), "part").agg(F.count(F.lit(1)).alias("n"))
        out = g if out is None else out.unionByName(g)
    return out


def _ranked_sql(seed: int, extra: str = "") -> str:
    return (f"SELECT ID{extra}, row_number() OVER (ORDER BY {hash_int_sql(seed, 'ID')}, ID) AS rk, "
            "count(*) OVER () AS n_all FROM device")


@query("sp3_fixed_size_split", with_ctes(
    "SELECT ID, CASE WHEN rk <= 12000 THEN 'val' ELSE 'train' END AS split FROM r", f"r AS ({_ranked_sql(2024)})"))
def q_sp3b(spark, sf_dir):
    return sp.exact_split(device_frame(spark, sf_dir).select("ID"), "ID", 2024, n_test=12000,
                          test_name="val", train_name="train")


@query("sp4_half_split", with_ctes(
    "SELECT ID, CASE WHEN rk <= round(n_all * 0.5) THEN 'A' ELSE 'B' END AS half FROM r", f"r AS ({_ranked_sql(0)})"))
def q_sp4(spark, sf_dir):
    return sp.half_split(device_frame(spark, sf_dir).select("ID"), "ID", seed=0)


@query("sp5_sample_rows", sql_round(with_ctes(
    "SELECT ID, price FROM r WHERE rk <= 500", f"r AS ({_ranked_sql(42, ', price')})"), ["price"]))
def q_sp5(spark, sf_dir):
    return rounded(sp.sample_rows(device_frame(spark, sf_dir).select("ID", "price"), 500, seed=42))


LC_SIZES = [2000, 4000, 8000, 16000, 32000]
LC_VAL = 12000


def _prefix_case_sql() -> str:
    arms = " ".join(f"WHEN rk <= {LC_VAL + s} THEN {s}" for s in sorted(LC_SIZES))
    return f"CASE WHEN rk <= {LC_VAL} THEN NULL {arms} ELSE NULL END"


@query("sp6_nested_prefixes", with_ctes(
    f"SELECT CASE WHEN rk <= {LC_VAL} THEN 'val' ELSE 'pool' END AS role, {_prefix_case_sql()} AS min_size, "
    "count(*) AS n FROM r GROUP BY 1, 2", f"r AS ({_ranked_sql(42)})"))
def q_sp6(spark, sf_dir):
    d = sp.nested_prefixes(device_frame(spark, sf_dir).select("ID"), LC_SIZES, LC_VAL, seed=42)
    return d.groupBy("role", "min_size").agg(F.count(F.lit(1)).alias("n"))


@query("sp8_head_tail", sql_round(with_ctes(
    "(SELECT 'head' AS part, ID, price FROM device ORDER BY ID ASC LIMIT 5) UNION ALL "
    "(SELECT 'tail' AS part, ID, price FROM device ORDER BY ID DESC LIMIT 5)"), ["price"]))
def q_sp8(spark, sf_dir):
    d = device_frame(spark, sf_dir).select("ID", "price")
    h = sp.head(d, 5).select(F.lit("head").alias("part"), "ID", "price")
    t = sp.tail(d, 5).select(F.lit("tail").alias("part"), "ID", "price")
    return rounded(h.unionByName(t))


# ----------------------------------------------------------------------------
# FE1-FE16, PR1
# ----------------------------------------------------------------------------
def engineer_sql(cfg: fe.FeatureConfig) -> tuple[str, list[str]]:
    """DuckDB twin of ``features.engineer`` over ``device``; returns (select, double cols)."""
    cols = dict.fromkeys(DEVICE_COLS)
    ex = {c: c for c in DEVICE_COLS}
    dbl = set(DEVICE_DOUBLES)

    def put(n, e, is_dbl=True):
        ex[n] = e
        cols[n] = None
        if is_dbl:
            dbl.add(n)
        else:
            dbl.discard(n)

    d = lambda c: f"CAST({c} AS DOUBLE)"
    nz = lambda e: f"nullif({e}, 0.0)"
    l2 = lambda e: f"(CASE WHEN {e} IS NULL THEN NULL ELSE log2(greatest({e}, 1.0)) END)"
    if cfg.model_decomp:
        put("model_line", "string_split(model, ' ')[2]", False)
    if cfg.cpu_decomp:
        put("cpu_family", f"regexp_replace(regexp_replace(cpu_model, '{fe.CPU_FAMILY_PATTERN}', ''), '^\\s+|\\s+$', '', 'g')", False)
        if cfg.cpu_generation:
            num = f"nullif(regexp_extract(cpu_model, '{fe.CPU_NUMBER_PATTERN}', 1), '')"
            put("cpu_generation", f"TRY_CAST((CASE WHEN length({num}) >= 5 THEN substr({num}, 1, 2) ELSE substr({num}, 1, 1) END) AS DOUBLE)")
    if cfg.structural_zeros:
        put("has_battery", "CAST(coalesce(battery_wh > 0, false) AS INTEGER)", False)
        put("has_psu", "CAST(coalesce(psu_watts > 0, false) AS INTEGER)", False)
        put("power_watts", f"{d('charger_watts')} + {d('psu_watts')}")
        for c in fe.STRUCTURAL_ZERO_COLS:
            put(c, nz(d(c)))
    if cfg.resolution:
        w = "TRY_CAST(string_split(resolution, 'x')[1] AS DOUBLE)"
        h = "TRY_CAST(string_split(resolution, 'x')[2] AS DOUBLE)"
        put("res_width", w)
        put("res_height", h)
        put("res_pixels", f"({w} * {h})")
        put("res_aspect", f"({w} / {nz(h)})")
        put("res_ppi", f"(sqrt({w} * {w} + {h} * {h}) / {nz(d('display_size_in'))})")
    if cfg.capacity:
        put("cpu_total_ghz", f"{d('cpu_cores')} * {d('cpu_boost_ghz')}")
        put("threads_per_core", f"{d('cpu_threads')} / {nz(d('cpu_cores'))}")
        put("ghz_headroom", f"{d('cpu_boost_ghz')} - {d('cpu_base_ghz')}")
        put("ram_per_core", f"{d('ram_gb')} / {nz(d('cpu_cores'))}")
        put("storage_total_gb", f"{d('storage_gb')} * {d('storage_drive_count')}")
        put("vram_x_gpu_tier", f"{d('vram_gb')} * {d('gpu_tier')}")
        put("tier_sum", f"{d('cpu_tier')} + {d('gpu_tier')}")
        put("tier_product", f"{d('cpu_tier')} * {d('gpu_tier')}")
        if "res_pixels" in cols:
            put("pixel_rate", f"{ex['res_pixels']} * {d('refresh_hz')}")
        put("age_years", f"{float(fe.REFERENCE_YEAR)!r}::DOUBLE - {d('release_year')}")
        put("wh_per_kg", f"{d(ex['battery_wh'])} / {nz(d('weight_kg'))}")
    if cfg.premium:
        if "cpu_family" in cols:
            fam = f"coalesce({ex['cpu_family']}, '')"
            put("is_apple_silicon", f"CAST(starts_with({fam}, '{fe.PREMIUM_PREFIX}') AS INTEGER)", False)
            ends = " OR ".join(f"ends_with({fam}, '{s}')" for s in fe.PREMIUM_SUFFIXES)
            put("is_apple_high_end", f"CAST(starts_with({fam}, '{fe.PREMIUM_PREFIX}') AND ({ends}) AS INTEGER)", False)
        put("ram_log2", l2(d("ram_gb")))
        put("is_high_ram", f"CAST(coalesce(ram_gb >= {fe.HIGH_RAM_GB}, false) AS INTEGER)", False)
        put("is_top_gpu", f"CAST(coalesce(gpu_tier >= {fe.TOP_GPU_TIER}, false) AS INTEGER)", False)
        put("premium_score", f"{d('cpu_tier')} * 2.0 + {d('gpu_tier')} * 2.0 + {l2(d('ram_gb'))}")
        put("storage_log2", l2(d("storage_gb")))
    keep = [c for c in cols if c not in fe.RAW_DROP_COLS]
    return "SELECT " + ", ".join(f"{ex[c]} AS {c}" for c in keep) + " FROM device", [c for c in keep if c in dbl]


def _fe_query(name, cfg):
    sel, dbls = engineer_sql(cfg)

    @query(name, sql_round(with_ctes(sel), dbls))
    def run(spark, sf_dir):
        return rounded(fe.engineer(device_frame(spark, sf_dir), cfg))
    return run


_fe_query("fe_default_families", fe.FeatureConfig())
_fe_query("fe_all_families", fe.ALL_ON)
_fe_query("fe_structural_only", fe.FeatureConfig(model_decomp=False, cpu_decomp=False, resolution=False))

def _varied(d):
    """Stand-in input: processor names of four makes, with and without numbers, and memory sizes on either side of the limit."""
    make, n = F.col("cpu_cores") % 4, F.col("cpu_threads").cast("int")
    cpu = (F.when(make == 1, F.concat(F.lit("Apple M1 "), F.when(n % 3 == 0, "Max").otherwise("Pro"))).when(make == 2, F.lit("Apple M2"))
           .when(make == 3, F.concat(F.lit("Core i7-"), (n * 137 + 10000).cast("string"))).otherwise(F.concat(F.lit("Ryzen 7 "), (n * 100 + 3000).cast("string"))))
    return d.withColumns({"cpu_model": cpu, "ram_gb": F.col("ram_gb") * 4.0})


_VARIED_SQL = ("varied AS (SELECT * REPLACE (CASE cpu_cores % 4 WHEN 1 THEN 'Apple M1 ' || (CASE WHEN cpu_threads % 3 = 0 THEN 'Max' ELSE 'Pro' END) "
               "WHEN 2 THEN 'Apple M2' WHEN 3 THEN 'Core i7-' || CAST(CAST(cpu_threads AS INTEGER) * 137 + 10000 AS VARCHAR) "
               "ELSE 'Ryzen 7 ' || CAST(CAST(cpu_threads AS INTEGER) * 100 + 3000 AS VARCHAR) END AS cpu_model, ram_gb * 4.0::DOUBLE AS ram_gb) FROM device)")
_VARIED_SEL, _VARIED_DBLS = engineer_sql(fe.ALL_ON)


@query("fe_every_rule", sql_round(with_ctes(_VARIED_SEL.replace("FROM device", "FROM varied"), _VARIED_SQL), _VARIED_DBLS))
def q_fe_every(spark, sf_dir):
    """All families on processor names and memory sizes for which every rule gives more than one value."""
    return rounded(fe.engineer(_varied(device_frame(spark, sf_dir)), fe.ALL_ON))


PAIRS = [("brand", "device_type"), ("device_type", "gpu_model"), ("os", "cpu_tier")]


@query("fe14_interactions", with_ctes("SELECT ID, " + ", ".join(
    f"coalesce(CAST({a} AS VARCHAR), 'NA') || '|' || coalesce(CAST({b} AS VARCHAR), 'NA') AS {a}_X_{b}" for a, b in PAIRS)
    + " FROM device"))
def q_fe14(spark, sf_dir):
    d = fe.add_interactions(device_frame(spark, sf_dir), PAIRS + [("brand", "no_such_column")])
    return d.select("ID", *[f"{a}_X_{b}" for a, b in PAIRS])


@query("fe15_log_target_ridge1", sql_round(with_ctes(
    "SELECT role, count(*) AS n, sqrt(avg((y - pred) * (y - pred))) AS rmse, avg(abs(y - pred)) AS mae FROM "
    "(SELECT hs.role, hs.y, exp(bb.b + coalesce(c.w * (c.ly - bb.b), 0.0)) AS pred FROM hs CROSS JOIN bb "
    "LEFT JOIN cells c ON c.gpu_model = hs.gpu_model) GROUP BY role",
    f"hs AS (SELECT ID, price AS y, gpu_model, CASE WHEN {unit_sql(42, 'ID')} < 0.2::DOUBLE THEN 'holdout' ELSE 'dev' END AS role FROM device)",
    "cells AS (SELECT gpu_model, avg(ln(y)) AS ly, count(*) / (count(*) + 10.0::DOUBLE) AS w FROM hs WHERE role = 'dev' GROUP BY gpu_model)",
    "bb AS (SELECT sum(w * ly) / sum(w) AS b FROM cells)"), ["rmse", "mae"]))
def q_fe15(spark, sf_dir):
    d = sp.make_dev_holdout(device_frame(spark, sf_dir)).select(
        "ID", "gpu_model", F.col("price").alias("y"), F.col("split").alias("role"), F.lit(0).alias("m"))
    train = d.filter(F.col("role") == "dev").withColumn("ly", fe.target_forward(F.col("y"), "log"))
    model = fit_one_factor_ridge(train, ["m"], "ly", "gpu_model", 10.0)
    p = model.predict(d, "lp").withColumn("pred", fe.target_inverse(F.col("lp"), "log"))
    return rounded(metrics(p, by=["role"]))


@query("fe16_cents_audit", with_ctes(
    "SELECT CAST(round(((price * 100.0) % 100.0 + 100.0) % 100.0) AS INTEGER) AS cents, count(*) AS n FROM device GROUP BY 1"))
def q_fe16(spark, sf_dir):
    return fe.cents_audit(device_frame(spark, sf_dir))


@query("pr1_percentile_filter", sql_round(with_ctes(
    "SELECT ID, gpu_model, price FROM device WHERE price > (SELECT quantile_cont(price, 0.99) FROM device) "
    "AND gpu_model = 'PROMO'"), ["price"]))
def q_pr1(spark, sf_dir):
    d = device_frame(spark, sf_dir).select("ID", "gpu_model", "price")
    return rounded(fe.percentile_filter(d, F.col("price"), 0.99).filter(F.col("gpu_model") == "PROMO")
                   .select("ID", "gpu_model", "price"))
