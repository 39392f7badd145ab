"""Sources: driver tables, the line-item fact and the reference-shaped device frame.

The reference works on one flat table of device specs with a ``price`` target.
Here that table is *derived* from the TPC-H-ish tables: one row per line item
(lineitem joined to part and orders), each reference column role filled by a
deterministic expression over the joined columns, and a planted target whose
noise comes from the portable hash. The same frame is produced by
``device_frame_sql`` in DuckDB for the oracle checks.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.portable import fold, hash_int_sql, open_unit, open_unit_sql
from ..session import written

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

KEY = "ID"
TARGET = "price"

# Fixed values of the planted target (additive truth + proportional noise).
RETURNFLAG_EFFECT = {"A": 0.0, "N": 90.0, "R": 180.0}
PTYPE_EFFECT = {"ECONOMY": 0.0, "MEDIUM": 150.0, "STANDARD": 250.0, "SMALL": 400.0, "LARGE": 700.0, "PROMO": 1000.0}
NOISE_SCALE = 0.11

# Text (categorical) and numeric columns of the device frame, in output order.
TEXT_COLS = ["device_type", "brand", "os", "form_factor", "gpu_model", "storage_type", "model", "cpu_model", "resolution"]
NUMERIC_COLS = [
    "ram_gb", "cpu_threads", "cpu_cores", "cpu_tier", "gpu_tier", "vram_gb", "storage_gb",
    "storage_drive_count", "refresh_hz", "release_year", "battery_wh", "charger_watts",
    "psu_watts", "cpu_base_ghz", "cpu_boost_ghz", "display_size_in", "weight_kg",
]
DEVICE_COLS = [KEY] + TEXT_COLS + NUMERIC_COLS + [TARGET]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: str, mapping: dict[str, float]):
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == k, F.lit(v)) if expr is None else expr.when(F.col(col) == k, F.lit(v)))
    return expr.otherwise(F.lit(0.0))


def _case_sql(col: str, mapping: dict[str, float]) -> str:
    arms = " ".join(f"WHEN {col} = '{k}' THEN {v!r}::DOUBLE" for k, v in mapping.items())
    return f"(CASE {arms} ELSE 0.0::DOUBLE END)"


def line_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ part ⋈ orders with the unique row key.

    No broadcast hint: part and orders grow with the scale factor, so the join
    strategy is left to Catalyst/AQE (runtime size check before broadcasting).
    """
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    orders = read_table(spark, sf_dir, "orders")
    j = li.join(part, li.l_partkey == part.p_partkey).join(orders, li.l_orderkey == orders.o_orderkey)
    return j.withColumn("row_key", row_key())


def row_key():
    """(orderkey, linenumber, partkey, suppkey) repeats in the smallest table; the price in cents (an integer, printed
    identically by every engine) makes the key unique."""
    cents = F.round(F.col("l_extendedprice") * 100.0).cast("long")
    return F.concat_ws(":", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], cents.cast("string"))


def planted_target(key_col: str = "row_key"):
    mu = (
        F.lit(500.0) + F.lit(12.0) * F.col("l_quantity") + _case("l_returnflag", RETURNFLAG_EFFECT)
        + _case("p_type", PTYPE_EFFECT) + F.lit(3.0) * F.col("p_size")
    )
    u = open_unit("y", F.col(key_col))
    return F.round(mu * (F.lit(1.0) + F.lit(NOISE_SCALE) * (-F.log(u) - F.lit(1.0))), 2)


def device_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference-shaped raw table (ID, 9 text, 17 numeric columns, price)."""
    return line_fact(spark, sf_dir).select(*device_columns())


def device_columns() -> list:
    """The columns of the device frame as expressions over the line-item fact."""
    c = F.col
    return [
        c("row_key").alias("ID"),
        c("l_returnflag").alias("device_type"),
        c("p_brand").alias("brand"),
        c("o_orderpriority").alias("os"),
        c("l_linestatus").alias("form_factor"),
        c("p_type").alias("gpu_model"),
        c("o_orderstatus").alias("storage_type"),
        F.concat_ws(" ", c("p_brand"), c("p_name")).alias("model"),
        F.concat(c("p_brand"), F.lit("-"), c("l_partkey").cast("string")).alias("cpu_model"),
        F.concat((c("l_linenumber") + 1).cast("string"), F.lit("x"), c("p_size").cast("string")).alias("resolution"),
        c("l_quantity").alias("ram_gb"),
        c("p_size").alias("cpu_threads"),
        c("l_linenumber").alias("cpu_cores"),
        c("l_linenumber").alias("cpu_tier"),
        (c("p_size") % 6 + 1).alias("gpu_tier"),
        ((c("p_size") % 8) * 2).alias("vram_gb"),
        (c("p_size") * 64).alias("storage_gb"),
        (c("l_linenumber") % 2 + 1).alias("storage_drive_count"),
        (c("p_size") + 60).alias("refresh_hz"),
        F.year("o_orderdate").alias("release_year"),
        (c("l_discount") * 100.0).alias("battery_wh"),
        (c("l_discount") * 50.0).alias("charger_watts"),
        (c("l_tax") * 100.0).alias("psu_watts"),
        (c("p_retailprice") / 1000.0).alias("cpu_base_ghz"),
        (c("p_retailprice") / 500.0).alias("cpu_boost_ghz"),
        (c("l_quantity") / 4.0).alias("display_size_in"),
        (c("o_totalprice") / 10000.0).alias("weight_kg"),
        planted_target("row_key").alias("price"),
    ]


def device_rows(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    """Columns of the device frame written once, for queries that read them more than once: the joins behind them run once."""
    return written(device_frame(spark, sf_dir).select(*cols), "device-rows", wide=True)


FROM_ORDERS = ("os", "storage_type", "release_year", "weight_kg")     # columns of the device frame that need the order


def fold_rows(spark: SparkSession, sf_dir: str, *cols: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Columns of the device frame plus ``repeat`` (0) and ``fold`` of the row's key, written once.

    Whatever line item and part settle, the fold among it, is worked out before the orders are joined: a row travels
    with the wanted columns and not with those that the key and the target are made of. The orders grow with the rows,
    and few of their columns are read: the hint keeps an estimate of their compressed size from sending them to every task.
    """
    made = dict(zip(DEVICE_COLS, device_columns()))
    late = [c for c in cols if c in FROM_ORDERS]
    li, part, orders = (read_table(spark, sf_dir, t) for t in ("lineitem", "part", "orders"))
    lines = li.join(part, li.l_partkey == part.p_partkey).withColumn("row_key", row_key())
    lines = lines.select("l_orderkey", *[made[c] for c in cols if c not in late], fold(seed, F.col("row_key"), k).alias("fold"))
    rows = lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)
    return written(rows.select(F.lit(0).alias("repeat"), "fold", *[made[c] if c in late else F.col(c) for c in cols]), "fold-rows")


# ----------------------------------------------------------------------------
# DuckDB twins (text), used by oracle_sql()
# ----------------------------------------------------------------------------
ROW_KEY_SQL = (
    "CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) || ':' || "
    "CAST(l_partkey AS VARCHAR) || ':' || CAST(l_suppkey AS VARCHAR) || ':' || "
    "CAST(CAST(round(l_extendedprice * 100.0) AS BIGINT) AS VARCHAR)"
)


def planted_target_sql(key_sql: str = "row_key") -> str:
    mu = (
        f"(500.0::DOUBLE + 12.0::DOUBLE * l_quantity + {_case_sql('l_returnflag', RETURNFLAG_EFFECT)} "
        f"+ {_case_sql('p_type', PTYPE_EFFECT)} + 3.0::DOUBLE * p_size)"
    )
    u = open_unit_sql("'y'", key_sql)
    return f"round({mu} * (1.0::DOUBLE + {NOISE_SCALE!r}::DOUBLE * (-ln({u}) - 1.0::DOUBLE)), 2)"


def device_frame_sql() -> str:
    """SELECT producing the device frame in DuckDB (use as a CTE body)."""
    return f"""
SELECT row_key AS ID,
       l_returnflag AS device_type, p_brand AS brand, o_orderpriority AS os,
       l_linestatus AS form_factor, p_type AS gpu_model, o_orderstatus AS storage_type,
       p_brand || ' ' || p_name AS model,
       p_brand || '-' || CAST(l_partkey AS VARCHAR) AS cpu_model,
       CAST(l_linenumber + 1 AS VARCHAR) || 'x' || CAST(p_size AS VARCHAR) AS resolution,
       l_quantity AS ram_gb, p_size AS cpu_threads, l_linenumber AS cpu_cores, l_linenumber AS cpu_tier,
       (p_size % 6 + 1) AS gpu_tier, ((p_size % 8) * 2) AS vram_gb, (p_size * 64) AS storage_gb,
       (l_linenumber % 2 + 1) AS storage_drive_count, (p_size + 60) AS refresh_hz,
       CAST(year(o_orderdate) AS INTEGER) AS release_year,
       l_discount * 100.0::DOUBLE AS battery_wh, l_discount * 50.0::DOUBLE AS charger_watts,
       l_tax * 100.0::DOUBLE AS psu_watts,
       p_retailprice / 1000.0::DOUBLE AS cpu_base_ghz, p_retailprice / 500.0::DOUBLE AS cpu_boost_ghz,
       l_quantity / 4.0::DOUBLE AS display_size_in, o_totalprice / 10000.0::DOUBLE AS weight_kg,
       {planted_target_sql('row_key')} AS price
FROM (SELECT *, {ROW_KEY_SQL} AS row_key
      FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey) j"""


def with_device(sql_body: str, extra_ctes: str = "") -> str:
    """Prefix a query with the ``device`` CTE (and optional further CTEs)."""
    more = f",\n{extra_ctes}" if extra_ctes else ""
    return f"WITH device AS ({device_frame_sql()}){more}\n{sql_body}"


__all__ = [
    "TABLES", "KEY", "TARGET", "TEXT_COLS", "NUMERIC_COLS", "DEVICE_COLS", "read_table",
    "line_fact", "row_key", "planted_target", "device_frame", "device_columns", "device_rows", "fold_rows", "device_frame_sql", "with_device", "planted_target_sql",
    "hash_int_sql",
]
