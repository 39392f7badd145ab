"""Session helpers: local test sessions and the shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pricelens") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PRICELENS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only when it is unset (local tests) a fresh scratch folder is created;
    on a cluster an unset folder raises, for others couldn't read a machine-local one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="pricelens-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path


COMPILED_BYTES = 8000       # the JVM never compiles a longer method: its rows would be interpreted
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
_lock, _users, _before = threading.Lock(), 0, None


@contextmanager
def compiled(spark: SparkSession):
    """Jobs inside run wide projections as many short methods instead of one that the JVM interprets; the setting is put back after."""
    global _users, _before
    with _lock:
        if not _users:
            _before = spark.conf.get(METHOD_LIMIT, None)
            spark.conf.set(METHOD_LIMIT, str(COMPILED_BYTES))
        _users += 1
    try:
        yield
    finally:
        with _lock:
            _users -= 1
            if not _users:
                spark.conf.unset(METHOD_LIMIT) if _before is None else spark.conf.set(METHOD_LIMIT, _before)


def written(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, its lineage ends there. ``wide``: run as ``compiled``."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with compiled(df.sparkSession) if wide else nullcontext():
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
