"""MD13 as a pipeline stage: ordered target statistics for text, values for numbers (EN2 + EN17).

Fitting writes one table (column, level, sum, count) for all text columns. Training rows
are encoded from the *earlier* rows of their level only, in the order of a hash of the
key, so that no row sees its own target; new rows look the whole statistics up. Both
leave a vector ``features`` (numbers first), and the fitted stage is saved with the pipeline:
the level table as Parquet beside the parameters. Levels never reach the driver.

The order is cut into chunks of about ``CHUNK_ROWS`` rows by the hash. Totals per (column, level,
chunk), combined before they are shuffled, give what lies ahead of each chunk; the rows move once,
to their chunk, whose task adds up the earlier rows of every level in all columns. A level
that holds a third of all rows is spread over its chunks.

Defined cases: a missing text is a level of its own, a missing number lies below the
smallest; a level that the training rows lack has the prior; without text columns only
numbers are left.
"""
from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable,
                             MLWriter)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.portable import hash_int
from ..session import written
from . import encode as en
from .group_models import BROADCAST_ROWS

STAT_SUFFIX = "__ts"


def ordered_rows(rows: DataFrame, levels: list[str], target: str, key: str, a: float, seed: int) -> DataFrame:
    """Columns of ``rows`` plus ``<level>__ts`` of each column of ``levels``: the statistic of the earlier rows of the row's level.

    Rows without a key come first in the order and are left out of the result. Rows that share a key share one list of
    statistics, those of its rows column by column in ascending order, cut at the number of columns.
    """
    n, prior = rows.agg(F.count(F.lit(1)), F.avg(target)).first()
    bits = min(32, max(0, math.ceil(math.log2(max(1, n) / en.CHUNK_ROWS))))
    start = a * (prior or 0.0)
    chunk = F.coalesce(F.shiftright("_h", 32 - bits) if bits else F.lit(0).cast("long"), F.lit(0).cast("long"))
    base = rows.withColumn("_h", hash_int(seed, F.col(key))).withColumn("_c", chunk)
    long = base.select("_c", F.col(target).cast("double").alias("_y"), F.posexplode(F.array(*[F.col(c) for c in levels])).alias("_i", "_l"))
    cells = long.groupBy("_i", "_l", "_c").agg(F.sum("_y").alias("_s"), F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("_i", "_l").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    ahead_of = cells.select("_c", "_i", "_l", F.coalesce(F.sum("_s").over(ahead), F.lit(0.0)).alias("_ps"), F.sum("_n").over(ahead).alias("_pn")).filter("_pn > 0")
    schema = T.StructType([*rows.schema.fields, *[T.StructField(c + STAT_SUFFIX, T.DoubleType()) for c in levels]])
    kept, stats, width = list(rows.columns), [c + STAT_SUFFIX for c in levels], len(levels)

    def run(own: pa.Table, before: pa.Table) -> pa.Table:
        own = own.take(pc.sort_indices(own, sort_keys=[("_h", "ascending"), (key, "ascending")], null_placement="at_start"))
        y, size = pc.fill_null(pc.cast(own[target], pa.float64()), 0.0).to_numpy(), own.num_rows
        ts = np.empty((width, size))
        for i, c in enumerate(levels):
            coded = pa.concat_arrays(own[c].chunks).dictionary_encode()
            codes, found = coded.indices.to_numpy(), coded.dictionary
            here = before.filter(pc.equal(before["_i"], i))
            at = pc.fill_null(pc.index_in(found, value_set=here["_l"].combine_chunks()), -1).to_numpy()
            ps, pn = np.zeros(len(found)), np.zeros(len(found))
            ps[at >= 0], pn[at >= 0] = here["_ps"].to_numpy()[at[at >= 0]], here["_pn"].to_numpy()[at[at >= 0]]
            order, count = np.argsort(codes, kind="stable"), np.bincount(codes, minlength=len(found))
            first = np.cumsum(count) - count
            ys, sums = y[order], np.zeros(size)
            for lo, m in zip(first[count > 1], count[count > 1]):
                sums[lo + 1:lo + m] = np.cumsum(ys[lo:lo + m - 1])
            earlier = np.arange(size) - np.repeat(first, count)
            ts[i, order] = (sums + np.repeat(ps, count) + start) / (earlier + np.repeat(pn, count) + a)
        keyed = pc.is_valid(own[key])
        own, ts = own.filter(keyed), ts[:, keyed.to_numpy()]
        k, size = pa.concat_arrays(own[key].chunks or [pa.array([], own.schema.field(key).type)]), own.num_rows
        edge = np.flatnonzero(pc.not_equal(k.slice(1), k.slice(0, size - 1)).to_numpy(zero_copy_only=False)) + 1
        ends = np.concatenate([[0], edge, [size]])
        for lo, hi in zip(ends[:-1], ends[1:]):
            if hi - lo > 1:
                ts[:, lo:hi] = np.sort(ts[:, lo:hi], axis=1).ravel()[:width, None]
        return pa.table([*[own[c] for c in kept], *[pa.array(v) for v in ts]], names=[*kept, *stats])

    return base.groupBy("_c").cogroup(ahead_of.groupBy("_c")).applyInArrow(run, schema)


def ordered_stats(rows: DataFrame, levels: list[str], target: str, key: str, a: float, seed: int) -> DataFrame:
    """key, ts: for each column of ``levels`` (in order) the statistic of the earlier rows of the row's level."""
    out = ordered_rows(rows.select(*dict.fromkeys([key, target, *levels])), levels, target, key, a, seed)
    return out.select(key, F.array(*[F.col(c + STAT_SUFFIX) for c in levels]).alias("ts"))


class OrderedTargetEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the level table; ``fit_rows`` also gives the encoded training rows."""
    colsJson = Param(Params._dummy(), "colsJson", "feature columns (JSON)", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "row key", TypeConverters.toString)
    smoothing = Param(Params._dummy(), "smoothing", "weight of the prior", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the row order", TypeConverters.toInt)

    @keyword_only
    def __init__(self, colsJson="[]", labelCol="label", keyCol="ID", smoothing=1.0, seed=42):
        super().__init__()
        self._setDefault(colsJson="[]", labelCol="label", keyCol="ID", smoothing=1.0, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "OrderedTargetModel":
        label, a = self.getOrDefault(self.labelCol), self.getOrDefault(self.smoothing)
        kinds = dict(df.dtypes)
        cols = json.loads(self.getOrDefault(self.colsJson))
        text, numbers = [c for c in cols if kinds[c] == "string"], [c for c in cols if kinds[c] != "string"]
        stats = df.agg(F.avg(label).alias("prior"), *[F.min(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(numbers)]).first()
        low = [(stats[f"m{i}"] if stats[f"m{i}"] is not None else 0.0) - 1.0 for i in range(len(numbers))]
        cells = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(en.MISSING)).alias("level")) for c in text]
        if text:
            table = df.select(F.col(label).cast("double").alias("y"), F.explode(F.array(*cells)).alias("c")).groupBy("c.column", "c.level").agg(
                F.sum("y").alias("s"), F.count(F.lit(1)).alias("n"))
        else:
            table = df.sparkSession.createDataFrame([], "column string, level string, s double, n long")
        model = OrderedTargetModel(textJson=json.dumps(text), numbersJson=json.dumps(numbers), lowJson=json.dumps(low),
                                   prior=float(stats["prior"] or 0.0), smoothing=a)
        model.table = written(table, "level-table")
        return model

    def fit_rows(self, df: DataFrame) -> tuple["OrderedTargetModel", DataFrame]:
        """(fitted stage, training rows (label, features) encoded from earlier rows)."""
        label, key = self.getOrDefault(self.labelCol), self.getOrDefault(self.keyCol)
        model = self.fit(df)
        text = json.loads(model.getOrDefault(model.textJson))
        numbers = json.loads(model.getOrDefault(model.numbersJson))
        rows = en.missing_sentinel(df.select(key, label, *text, *numbers), text)
        out = rows.select(key, label, *text, *model.number_columns())
        if text:    # written column by column: vectors of the same rows take several times the place
            out = ordered_rows(out, text, label, key, self.getOrDefault(self.smoothing), self.getOrDefault(self.seed))
            out = written(out.select(label, *numbers, *[c + STAT_SUFFIX for c in text]), "cat-train")
        return model, model.assembled(out).select("features", label)


class OrderedTargetModel(Model, MLReadable, MLWritable):
    textJson = Param(Params._dummy(), "textJson", "text columns (JSON)", TypeConverters.toString)
    numbersJson = Param(Params._dummy(), "numbersJson", "numeric columns (JSON)", TypeConverters.toString)
    lowJson = Param(Params._dummy(), "lowJson", "stand-ins for missing numbers (JSON)", TypeConverters.toString)
    prior = Param(Params._dummy(), "prior", "mean of the training label", TypeConverters.toFloat)
    smoothing = Param(Params._dummy(), "smoothing", "weight of the prior", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, textJson="[]", numbersJson="[]", lowJson="[]", prior=0.0, smoothing=1.0):
        super().__init__()
        self._setDefault(textJson="[]", numbersJson="[]", lowJson="[]", prior=0.0, smoothing=1.0)
        self._set(**self._input_kwargs)
        self.table: DataFrame | None = None
        self.sizes: dict[str, int] | None = None

    def number_columns(self) -> list:
        numbers, low = json.loads(self.getOrDefault(self.numbersJson)), json.loads(self.getOrDefault(self.lowJson))
        return [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(v)), F.lit(v)).alias(c) for c, v in zip(numbers, low)]

    def assembled(self, df: DataFrame) -> DataFrame:
        inputs = [*json.loads(self.getOrDefault(self.numbersJson)), *[c + STAT_SUFFIX for c in json.loads(self.getOrDefault(self.textJson))]]
        return VectorAssembler(inputCols=inputs, outputCol="features").transform(df)

    def _transform(self, df: DataFrame) -> DataFrame:
        text = json.loads(self.getOrDefault(self.textJson))
        a, prior = self.getOrDefault(self.smoothing), self.getOrDefault(self.prior)
        if text and self.sizes is None:
            self.sizes = {r["column"]: r["count"] for r in self.table.groupBy("column").count().collect()}     # one row per text column
        small = {c: self.sizes.get(c, 0) <= BROADCAST_ROWS for c in text}
        out = df
        # one row per level on the right: rows are never multiplied. Small tables are broadcast, and come first, so that
        # rows move for large ones only, without the texts already looked up
        for c in sorted(text, key=lambda c: not small[c]):
            stat = self.table.filter(F.col("column") == c).select(F.col("level").alias("_l"), ((F.col("s") + F.lit(a * prior)) / (F.col("n") + F.lit(a))).alias(c + STAT_SUFFIX))
            stat = F.broadcast(stat) if small[c] else stat
            out = out.join(stat, F.coalesce(F.col(f"`{c}`"), F.lit(en.MISSING)) == F.col("_l"), "left").drop("_l")
            out = out.withColumn(c + STAT_SUFFIX, F.coalesce(F.col(c + STAT_SUFFIX), F.lit(prior)))
        out = out.withColumn("_in", F.struct(*[F.col(f"`{c}`") for c in df.columns])).withColumns({c: e for c, e in zip(
            json.loads(self.getOrDefault(self.numbersJson)), self.number_columns())})
        return self.assembled(out).select("_in.*", "features")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, stage: OrderedTargetModel):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        DefaultParamsWriter.saveMetadata(self.stage, path, spark)
        self.stage.table.write.parquet(f"{path}/levels")


class _Reader(MLReader):
    def load(self, path: str) -> OrderedTargetModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        stage = OrderedTargetModel()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.table = spark.read.parquet(f"{path}/levels")
        return stage
