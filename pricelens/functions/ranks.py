"""Ranks of the distinct values of many columns without a window over a column.

Counts per (column, value) are range-partitioned by (column, value) and sorted; each task adds
up its own stretch in one pass, and the totals of the stretches before it are added. A
task holds a stretch of bounded size whatever a column's number of values, and there
are at most (tasks + columns) stretch totals: that table is small by construction, so it
is broadcast.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written

ROWS = 200_000      # distinct values in a task, about


def distinct_ranks(counts: DataFrame, name: str = "value", group: str = "col_name", weight: str = "c") -> DataFrame:
    """``counts`` (one row per group and value, number of rows in ``weight``) plus ``place`` (distinct values of the group
    below it) and ``below`` (rows below it). Other columns stay. Text sorts by its UTF-8 bytes."""
    counts = written(counts, "rank-counts")
    tasks = max(1, -(-counts.count() // ROWS))
    extra = [T.StructField(c, T.LongType()) for c in ("task", "_p", "_b")]
    schema = T.StructType([*counts.schema.fields, *extra])
    at, own = counts.columns.index(weight), counts.columns.index(group)

    def run(batches):
        task, last, place, below = TaskContext.get().partitionId(), None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            c = b.column(at).to_numpy()
            g = b.column(own)
            change = np.flatnonzero(pc.not_equal(g.slice(1), g.slice(0, len(g) - 1)).to_numpy(zero_copy_only=False)) + 1
            starts = np.concatenate([[0], change, [len(c)]])
            p, s = np.empty(len(c), np.int64), np.empty(len(c), np.int64)
            for lo, hi in zip(starts[:-1], starts[1:]):
                if g[int(lo)].as_py() != last:
                    last, place, below = g[int(lo)].as_py(), 0, 0
                total = np.cumsum(c[lo:hi])
                p[lo:hi], s[lo:hi] = place + np.arange(hi - lo), below + total - c[lo:hi]
                place, below = place + int(hi - lo), below + int(total[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(c), task, np.int64)), pa.array(p), pa.array(s)],
                                             names=[*b.schema.names, "task", "_p", "_b"])

    dealt = counts.repartitionByRange(tasks, group, name).sortWithinPartitions(group, name).mapInArrow(run, schema)
    here = written(dealt, "rank-stretches")
    ahead = Window.partitionBy(group).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    totals = here.groupBy(group, "task").agg(F.count(F.lit(1)).alias("_tp"), F.sum(weight).alias("_tb"))
    totals = totals.select(group, "task", F.coalesce(F.sum("_tp").over(ahead), F.lit(0)).alias("_tp"), F.coalesce(F.sum("_tb").over(ahead), F.lit(0)).alias("_tb"))
    out = here.join(F.broadcast(totals), [group, "task"])
    return out.select(*counts.columns, (F.col("_p") + F.col("_tp")).alias("place"), (F.col("_b") + F.col("_tb")).alias("below"))
