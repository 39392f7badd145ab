"""Exact top-k inner products by pivot-table elimination.

Each component x becomes floor(256 * x); the score of two vectors is their exact
integer inner product. All vectors get one more coordinate so that they have
the same length M: then a larger inner product is a smaller distance. The index
table holds, for every vector, its distances to ``PIVOTS`` rows of the corpus.
By the triangle inequality max_p |d(q, p) - d(x, p)| is a lower bound of
d(q, x), hence an upper bound of the score.

For a block of queries each task walks its part of the table: candidates come
in order of their bound and are evaluated exactly, in short runs, until the
k-th score found so far (the pivots themselves give the first one) beats every
bound that is left. Bounds only skip work; ties go to the smaller id, so a
candidate whose bound equals the k-th score is still evaluated.

Queries go to the tasks in blocks of about ``BLOCK`` (bounded, whatever the number
of queries); every block scans the index once and returns at most k rows per
query and task, which are merged per query.

Defined cases: a vector that is null or holds a null or a non-finite component
takes no part; shorter vectors count as padded with zeros; rows that share the
query's id are its own; a repeated query row is asked once; fewer than k
candidates give fewer rows; sums are exact at any magnitude (beyond 2^52 in
Python integers), a score outside 64 bits stands at the limit, and so does a component
whose multiple is beyond a double. Distances are in units of a power of two near the
largest length, so they can't overflow.
"""
from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import scratch_path
from .common import written

SCALE = 256
PIVOTS = 32
BLOCK = 2048
RUN = 512
CHUNK = 8192
EXACT = float(1 << 52)
LARGEST = float(np.finfo(np.float64).max)


def _rows(col) -> list:
    """Integer-valued float64 vectors; None for those that take no part."""
    out = []
    for v in col.to_pylist():
        x = None if v is None or any(c is None for c in v) else np.array(v, np.float64)
        with np.errstate(over="ignore"):        # a finite component whose multiple is beyond a double stands at its limit
            out.append(np.clip(np.floor(SCALE * x), -LARGEST, LARGEST) if x is not None and np.isfinite(x).all() else None)
    return out


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, v (whole numbers), big (largest absolute component) of the vectors that take part."""
    def run(batches):
        for b in batches:
            rows = [(i, v) for i, v in zip(b.column(0).to_pylist(), _rows(b.column(1))) if i is not None and v is not None]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()),
                                              pa.array([v for _, v in rows], pa.list_(pa.float64())),
                                              pa.array([float(np.abs(v).max(initial=0)) for _, v in rows], pa.float64())], names=["vec_id", "v", "big"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, "vec_id long, v array<double>, big double")


def matrix(col, dim: int) -> np.ndarray:
    rows = col.to_pylist() if hasattr(col, "to_pylist") else list(col)
    x = np.zeros((len(rows), dim))
    for i, v in enumerate(rows):
        x[i, :len(v)] = v
    return x


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products as integers: a row's float64 sums are exact while they stay below 2^52, others are summed as integers."""
    with np.errstate(over="ignore", invalid="ignore"):
        large = ~(np.abs(x).max(axis=1, initial=0) * np.abs(q).sum() < EXACT)
        out = np.where(large, 0, x @ q).astype(np.int64)
    if large.any():
        lim = (1 << 63) - 1
        qi = [int(c) for c in q]
        out[large] = [max(-lim - 1, min(lim, sum(int(a) * b for a, b in zip(r, qi)))) for r in x[large]]
    return out


def lifted_distance(inner: np.ndarray, n2x: np.ndarray, n2p: np.ndarray, top: float) -> np.ndarray:
    """Distances to pivots after lifting both sides to length sqrt(top); all in units in which no length is above 1."""
    lift = np.sqrt(np.maximum(top - n2x, 0))[:, None] * np.sqrt(np.maximum(top - n2p, 0))[None, :]
    return np.sqrt(np.maximum(2 * top - 2 * (inner + lift), 0))


def pivot_table(rows: DataFrame, pivots: np.ndarray, unit: float, top: float) -> DataFrame:
    """``rows`` plus ``pd``: lifted distances to the pivots, in ``unit``s."""
    p = pivots / unit
    dim, n2p = p.shape[1], (p ** 2).sum(axis=1)

    def run(batches):
        for b in batches:
            x = matrix(b.column(1), dim) / unit
            d = lifted_distance(x @ p.T, (x ** 2).sum(axis=1), n2p, top).astype(np.float32)
            flat = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(p), pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), flat], names=["vec_id", "v", "big", "pd"])

    return rows.mapInArrow(run, "vec_id long, v array<double>, big double, pd array<float>")


def best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    keep = np.lexsort((ids, -score))[:k]
    return score[keep], ids[keep]


def search_block(index: DataFrame, qid: np.ndarray, q: np.ndarray, pivots: np.ndarray, pivot_ids: np.ndarray, unit: float, top: float,
                 k: int) -> DataFrame:
    """At most k rows per query and task: q (row number in the block), vec_id, score."""
    n2q = ((q / unit) ** 2).sum(axis=1)
    # a query isn't lifted the way table rows are: its extra coordinate is 0
    dq = np.sqrt(np.maximum(n2q[:, None] + top - 2 * ((q / unit) @ (pivots / unit).T), 0)).astype(np.float32)
    first = []
    for i in range(len(q)):
        s = products(pivots[pivot_ids != qid[i]], q[i])
        first.append(int(np.sort(s)[-k]) if len(s) >= k else None)

    def run(batches):
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in qid]
        for b in batches:
            for lo in range(0, b.num_rows, CHUNK):
                part = b.slice(lo, CHUNK)
                ids, x = part.column(0).to_numpy(), matrix(part.column(1), q.shape[1])
                pd = part.column(3).flatten().to_numpy().reshape(len(ids), -1)
                for i in range(len(qid)):
                    low = np.abs(pd - dq[i]).max(axis=1).astype(np.float64)
                    bound = (n2q[i] + top - low * low) / 2 + 1e-5 * (n2q[i] + top)
                    order = np.argsort(-bound, kind="stable")
                    order = order[ids[order] != qid[i]]
                    s, own = found[i]
                    for at in range(0, len(order), RUN):
                        kth = s[-1] if len(s) == k else None
                        if first[i] is not None:
                            kth = first[i] if kth is None else max(kth, first[i])
                        run_ = order[at:at + RUN]
                        if kth is not None:
                            run_ = run_[bound[run_] >= float(kth) / unit / unit]
                            if not len(run_):
                                break
                        s, own = best(np.concatenate([s, products(x[run_], q[i])]), np.concatenate([own, ids[run_]]), k)
                    found[i] = s, own
        n = [len(s) for s, _ in found]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(qid)), n)), pa.array(np.concatenate([o for _, o in found])),
                                          pa.array(np.concatenate([s for s, _ in found]))], names=["q", "vec_id", "score"])

    return index.mapInArrow(run, "q long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query row against all rows (``is_query`` over vec_id)."""
    rows = written(quantised(vectors), "topk-vectors")
    big, dim = rows.agg(F.max("big"), F.max(F.size("v"))).first()
    dim = max(1, int(dim or 0))
    # a power of two near the largest length, so that squares of lengths can't overflow
    unit = math.ldexp(1.0, min(1023, max(0, math.frexp(big or 1.0)[1] + math.ceil(math.log2(dim) / 2))))
    length2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.lit(unit)) * (x / F.lit(unit)))
    top = float(rows.agg(F.max(length2)).first()[0] or 0.0)
    picked = rows.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id", "v").limit(pivots).collect()
    pivot_ids, p = np.array([r["vec_id"] for r in picked], np.int64), matrix([r["v"] for r in picked], dim)
    index = written(pivot_table(rows, p, unit, top) if picked else rows.withColumn("pd", F.array().cast("array<float>")), "topk-index")
    asked = rows.filter(is_query).select("vec_id", "v").distinct()
    blocks, asked_any = max(1, math.ceil(asked.count() / block)) if picked else 0, False
    found = scratch_path(vectors.sparkSession, f"topk-found-{uuid.uuid4().hex}")
    schema = "query_id long, block int, q long, vec_id long, score long"
    for i in range(blocks):     # the driver holds one block of queries at a time; its answers go to the shared folder
        mine = sorted(asked.filter(F.pmod(F.xxhash64("vec_id", F.lit(4)), F.lit(blocks)) == i).collect(), key=lambda r: (r["vec_id"], r["v"]))
        if not mine:
            continue
        qid, q = np.array([r["vec_id"] for r in mine], np.int64), matrix([r["v"] for r in mine], dim)
        names = F.array(*[F.lit(int(x)).cast("long") for x in qid])
        got = search_block(index, qid, q, p, pivot_ids, unit, top, k).select(
            F.get(names, F.col("q").cast("int")).alias("query_id"), F.lit(i).alias("block"), "q", "vec_id", "score")
        got.write.mode("append").parquet(found)
        asked_any = True
    if not asked_any:
        return rows.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    out = vectors.sparkSession.read.schema(schema).parquet(found)
    rank = F.row_number().over(W.partitionBy("block", "q").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
