"""MD16: boosted stumps in Gram space, thousands of rounds from one scan.

A sum of stumps is one step table per feature: F(x) = base + sum_j g_j(bin of x_j). Squared-loss
boosting needs the rows only through, for every pair of bins, the number of rows in both, and
for every bin the sum of the targets. One scan counts them (as pairs of integer codes,
per fold, merged on the executors); after that a round is

    R <- R - C[:, bins of j] d       with d the step of the best stump on feature j,

where R holds the residual sums per bin. The training set of a fold is total minus fold, so
all folds are boosted, and scored by their own counts, without another scan: the squared
error of a table on a fold is a quadratic form in its cross counts.

Numbers are cut at the midpoints of their distinct values if these are at most ``max_bins``,
else at quantiles; columns with nominal metadata keep a bin per category and are split by
the order of their mean residuals. Work on the driver grows with rounds x bins, its memory
with folds x bins^2 (refused beyond ``MAX_BINS_ALL`` bins), neither with the rows.

Defined cases: NaN lies above every cut; a category that the training rows lack adds
nothing; no rows raise; a constant target gives the constant; boosting ends early when no
stump lowers the error.
"""
from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .linear import TASKS_PER_CORE, merged_blocks
from .profile import chunks, whole

BLOCK = 64
MAX_BINS_ALL = 8192


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows x width of an Arrow array of lists of one length, without a list per row."""
    return lists.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class Bins:
    """Per slot of the vector: ``cuts`` (numbers; None for a nominal slot) and the number of bins; ``ends`` delimit the slots."""
    cuts: list
    sizes: list[int]

    def __post_init__(self):
        self.ends = np.cumsum([0, *self.sizes])

    @property
    def nominal(self) -> list[bool]:
        return [c is None for c in self.cuts]

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Bin of every value, counted over all slots; the row of a value without a bin is -1."""
        out = np.empty(x.shape, np.int64)
        for j, (cut, size) in enumerate(zip(self.cuts, self.sizes)):
            if cut is None:
                whole = np.where(np.isnan(x[:, j]), -1, x[:, j]).astype(np.int64)
                out[:, j] = np.where((whole >= 0) & (whole < size), whole + self.ends[j], -1)
            else:
                out[:, j] = np.searchsorted(cut, x[:, j], "left") + self.ends[j]
        return out


def _nominal_sizes(df: DataFrame, features: str, width: int) -> dict[int, int]:
    attrs = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"]: len(a["vals"]) for a in attrs.get("nominal", []) if "vals" in a and a["idx"] < width}


def find_bins(rows: DataFrame, nominal: dict[int, int], width: int, max_bins: int) -> Bins:
    """Bins of the array column ``x``: distinct values where they are few (counted in one pass), else quantiles."""
    numeric = [j for j in range(width) if j not in nominal]

    def distinct(batches):
        seen: dict[int, np.ndarray | None] = {j: np.zeros(0) for j in numeric}     # None: a task that alone has too many says so with one row
        for table in chunks(batches):
            x = matrix(whole(table, "x"), width)
            for j, known in seen.items():
                if known is not None:
                    v = np.unique(x[:, j])
                    v = np.union1d(known, v[~np.isnan(v)])
                    seen[j] = v if len(v) <= max_bins else None
        for j, v in seen.items():
            v = np.array([np.nan]) if v is None else v
            yield pa.record_batch([pa.array(np.full(len(v), j, np.int32)), pa.array(v)], names=["slot", "v"])

    seen = written(rows.select("x").mapInArrow(distinct, "slot int, v double").distinct(), "bin-values")
    counts = seen.groupBy("slot").agg(F.count("*").alias("n"), F.max(F.col("v").isNull() | F.isnan("v")).alias("many"))
    few = counts.filter((F.col("n") <= max_bins) & ~F.col("many")).select("slot")
    values: dict[int, list] = {}
    for r in seen.join(few, "slot").collect():          # at most max_bins a slot
        values.setdefault(r["slot"], []).append(r["v"])
    wide = [r["slot"] for r in counts.join(few, "slot", "left_anti").collect()]
    probs = [i / max_bins for i in range(1, max_bins)]
    quantiles = dict(zip(wide, rows.select(*[F.when(~F.isnan(F.col("x")[j]), F.col("x")[j]).alias(f"c{j}") for j in wide]).approxQuantile(
        [f"c{j}" for j in wide], probs, 0.1 / max_bins))) if wide else {}
    cuts, sizes = [], []
    for j in range(width):
        if j in nominal:
            cuts.append(None)
            sizes.append(nominal[j])
            continue
        v = np.array(sorted(values.get(j, [])))
        cut = np.unique(quantiles[j]) if j in quantiles else (v[1:] + v[:-1]) / 2
        cuts.append(cut)
        sizes.append(len(cut) + 1)
    return Bins(cuts, sizes)


def cross_counts(rows: DataFrame, bins: Bins) -> dict[int, np.ndarray]:
    """{fold: matrix}: rows in both bins; sums of the target per bin in the last column and row, of its square in the corner.
    ``rows``: fold, x (array), y."""
    p = int(bins.ends[-1])
    if p > MAX_BINS_ALL:
        raise ValueError(f"{p} bins: cross counts of at most {MAX_BINS_ALL} are held per fold")

    def add(a, codes, y):
        """Upper part of the counts: what lies below the diagonal follows by symmetry."""
        for l in range(codes.shape[0]):
            lo, hi = bins.ends[l], bins.ends[l + 1]
            own, known = codes[l], codes[l] >= 0
            every = known.all()
            a[lo:hi, p] += np.bincount(own if every else own[known], y if every else y[known], hi - lo)
            for m in range(l, codes.shape[0]):
                start, width = bins.ends[m], bins.sizes[m]
                pair = own * width + codes[m]
                if not every or codes[m].min(initial=0) < 0:
                    pair = pair[known & (codes[m] >= 0)]
                a[lo:hi, start:start + width] += np.bincount(pair, minlength=(hi - lo) * width).reshape(hi - lo, width)
        a[p, p] += y @ y

    def run(batches):
        acc: dict[int, np.ndarray] = {}
        for table in chunks(batches):
            at, fold = bins.codes(matrix(whole(table, "x"), len(bins.sizes))), whole(table, "fold").to_numpy()
            y = whole(table, "y").fill_null(np.nan).to_numpy()
            codes = np.where(at < 0, -1, at - bins.ends[:-1]).T
            for f in np.unique(fold):
                own = np.flatnonzero(fold == f)
                add(acc.setdefault(int(f), np.zeros((p + 1, p + 1))), np.ascontiguousarray(codes[:, own]), y[own])
        task = TaskContext.get().partitionId()
        for f, a in acc.items():
            for lo in range(0, p + 1, BLOCK):
                yield pa.record_batch([pa.array([f], pa.int32()), pa.array([lo // BLOCK], pa.int32()), pa.array([task], pa.int32()),
                                       pa.array([np.ascontiguousarray(a[lo:lo + BLOCK, lo:]).tobytes()], pa.binary())], names=["fold", "blk", "part", "v"])

    def merge(pdf):
        return pd.DataFrame({"fold": pdf["fold"].iloc[:1], "blk": pdf["blk"].iloc[:1], "part": pdf["part"].iloc[:1],
                             "v": [sum(np.frombuffer(v) for v in pdf["v"]).tobytes()]})

    schema = "fold int, blk int, part int, v binary"
    own = rows.select(F.col("fold").cast("int").alias("fold"), "x", F.col("y").cast("double").alias("y"))
    most = TASKS_PER_CORE * own.sparkSession.sparkContext.defaultParallelism      # a task's result has bins^2 / 2 numbers per fold
    own = own.coalesce(most)
    part = merged_blocks(own.mapInArrow(run, schema), own.rdd.getNumPartitions(), merge, schema)
    out: dict[int, np.ndarray] = {}
    for r in part.collect():
        a = out.setdefault(r["fold"], np.zeros((p + 1, p + 1)))
        lo = r["blk"] * BLOCK
        v = np.frombuffer(bytes(r["v"])).reshape(-1, p + 1 - lo)
        a[lo:lo + len(v), lo:] += v
    for f, a in out.items():
        a = np.triu(a)
        out[f] = a + np.triu(a, 1).T
    return out


def boost(cross: np.ndarray, bins: Bins, rounds: int, rate: float, min_rows: int = 1, first_tree_full: bool = False,
          stages: tuple[int, ...] = ()) -> tuple[float, np.ndarray, list[tuple[int, np.ndarray]]]:
    """(base, step tables, [(round, tables then)] for ``stages``). Starts from the mean; with ``first_tree_full`` from 0 and a
    first stump that isn't shrunk."""
    c, sums = cross[:-1, :-1], cross[:-1, -1]
    n = np.diag(c).copy()
    ends, sizes = bins.ends, bins.sizes
    rows, total = float(n[:sizes[0]].sum()), float(sums[:sizes[0]].sum())
    base = 0.0 if first_tree_full else total / rows
    r, g = sums - base * n, np.zeros(len(n))
    slot = np.repeat(np.arange(len(sizes)), sizes)
    nominal = np.array(bins.nominal)[slot]
    inner = np.ones(len(n), bool)
    inner[ends[1:] - 1] = False             # nothing lies right of a slot's last bin
    start = ends[:-1][slot]
    order, taken = np.arange(len(n)), []
    all_n = np.add.reduceat(n, ends[:-1])[slot]
    for k in range(1, rounds + 1):
        if nominal.any():       # categories by mean residual, empty ones last
            mean = np.where(n > 0, r / np.maximum(n, 1), np.inf)
            order = np.lexsort((np.where(nominal, mean, np.arange(len(n))), slot))
        cn, cr = np.cumsum(n[order]), np.cumsum(r[order])
        cn, cr = cn - np.concatenate([[0], cn])[start], cr - np.concatenate([[0], cr])[start]
        all_r = np.add.reduceat(r, ends[:-1])[slot]
        right_n = all_n - cn
        ok = inner & (cn >= min_rows) & (right_n >= min_rows)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(ok, cr * cr / cn + (all_r - cr) ** 2 / right_n - all_r * all_r / all_n, -1.0)
        best = int(gain.argmax())
        if not gain[best] > 1e-12 * max(1.0, abs(cross[-1, -1])):
            break
        j = slot[best]
        own = order[ends[j]:ends[j + 1]]
        at = best - ends[j] + 1
        step = np.where(np.arange(len(own)) < at, cr[best] / cn[best], (all_r[best] - cr[best]) / right_n[best])
        step *= 1.0 if first_tree_full and k == 1 else rate
        if nominal[best]:
            step = np.where(n[own] > 0, step, 0.0)
        g[own] += step
        r -= c[:, own] @ step
        if k in stages:
            taken.append((k, g.copy()))
    done = {k for k, _ in taken}
    return base, g, taken + [(k, g.copy()) for k in stages if k not in done]


def squared_error(cross: np.ndarray, base: float, g: np.ndarray, first: int) -> tuple[float, float]:
    """(rows, sum of squared errors) of base + tables on the rows that ``cross`` counts; ``first``: bins of the first slot."""
    c, s = cross[:-1, :-1], cross[:-1, -1]
    n = np.diag(c)
    rows, total = float(n[:first].sum()), float(s[:first].sum())
    return rows, float(cross[-1, -1] - 2 * (base * total + g @ s) + rows * base * base + 2 * base * (g @ n) + g @ c @ g)


def stumps_cv(df: DataFrame, rounds: tuple[int, ...], rate: float, k: int = 5, min_rows: int = 20, max_bins: int = 64, features: str = "features",
              fold: str = "fold", target: str = "price") -> DataFrame:
    """(rounds, fold, role, n, rmse) of every fold from one scan. Cuts come from the features of all rows, never the target;
    rows hold a value without missing in the first slot's bins."""
    width = df.select(features).first()[0].size
    rows = written(df.select(F.col(fold).alias("fold"), vector_to_array(features).alias("x"), F.col(target).cast("double").alias("y")), "stump-rows")
    bins = find_bins(rows, _nominal_sizes(df, features, width), width, max_bins)
    cross = cross_counts(rows, bins)
    total, out = sum(cross.values()), []
    for f in sorted(cross):
        train = total - cross[f]
        base, _, stages = boost(train, bins, max(rounds), rate, min_rows, stages=tuple(sorted(rounds)))
        for n_rounds, g in stages:
            for role, part in (("train", train), ("val", cross[f])):
                n, sse = squared_error(part, base, g, bins.sizes[0])
                out.append((n_rounds, f, role, int(n), float(np.sqrt(max(sse, 0.0) / n))))
    return df.sparkSession.createDataFrame(out, "rounds int, fold int, role string, n long, rmse double")


class AdditiveStumps(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """MD16 on a feature vector: ``nEstimators`` boosted stumps from one scan."""
    nEstimators = Param(Params._dummy(), "nEstimators", "rounds", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "shrinkage", TypeConverters.toFloat)
    minRows = Param(Params._dummy(), "minRows", "rows on either side of a split", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a number", TypeConverters.toInt)
    firstTreeFull = Param(Params._dummy(), "firstTreeFull", "start from 0 with a first stump that isn't shrunk", TypeConverters.toBoolean)
    featuresCol = Param(Params._dummy(), "featuresCol", "features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)

    @keyword_only
    def __init__(self, nEstimators=2000, learningRate=0.06, minRows=1, maxBins=64, firstTreeFull=False, featuresCol="features", labelCol="label",
                 predictionCol="prediction"):
        super().__init__()
        self._setDefault(nEstimators=2000, learningRate=0.06, minRows=1, maxBins=64, firstTreeFull=False, featuresCol="features", labelCol="label",
                         predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "AdditiveStumpsModel":
        get = self.getOrDefault
        features = get(self.featuresCol)
        first = df.select(features).first()
        if first is None:
            raise ValueError("no rows to fit on")
        width = first[0].size
        rows = written(df.select(F.lit(0).alias("fold"), vector_to_array(features).alias("x"), F.col(get(self.labelCol)).cast("double").alias("y")), "stump-rows")
        bins = find_bins(rows, _nominal_sizes(df, features, width), width, get(self.maxBins))
        cross = cross_counts(rows, bins)[0]
        base, g, _ = boost(cross, bins, get(self.nEstimators), get(self.learningRate), get(self.minRows), get(self.firstTreeFull))
        n = np.diag(cross)[:-1]
        tables = [{"cuts": None if cut is None else list(map(float, cut)), "values": list(map(float, g[lo:hi])),
                   "mean": float(g[lo:hi] @ n[lo:hi] / n[:bins.sizes[0]].sum())}
                  for cut, lo, hi in zip(bins.cuts, bins.ends[:-1], bins.ends[1:])]
        return AdditiveStumpsModel(tablesJson=json.dumps(tables), base=float(base), featuresCol=features, predictionCol=get(self.predictionCol))


class AdditiveStumpsModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    tablesJson = Param(Params._dummy(), "tablesJson", "step tables per slot (JSON)", TypeConverters.toString)
    base = Param(Params._dummy(), "base", "constant", TypeConverters.toFloat)
    featuresCol = Param(Params._dummy(), "featuresCol", "features", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)

    @keyword_only
    def __init__(self, tablesJson="[]", base=0.0, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._setDefault(tablesJson="[]", base=0.0, featuresCol="features", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _terms(self, centred: bool):
        tables = json.loads(self.getOrDefault(self.tablesJson))
        bins = Bins([t["cuts"] if t["cuts"] is None else np.array(t["cuts"]) for t in tables], [len(t["values"]) for t in tables])
        values = np.array([v for t in tables for v in t["values"]] + [0.0])        # -1: no bin, adds nothing
        means = np.array([t["mean"] for t in tables])

        def terms(x: np.ndarray) -> np.ndarray:
            own = values[bins.codes(x)]
            return own - means if centred else own
        return terms, self.getOrDefault(self.base) + (float(means.sum()) if centred else 0.0)

    def attribution_terms(self):
        """(matrix -> one attribution per slot, base): steps about their training means."""
        return self._terms(True)

    def _transform(self, df: DataFrame) -> DataFrame:
        terms, base = self._terms(False)

        width = len(json.loads(self.getOrDefault(self.tablesJson)))

        def predicted(x: pa.Array) -> pa.Array:
            return pa.array(terms(matrix(x, width)).sum(axis=1) + base, from_pandas=True)      # NaN: null

        return df.withColumn(self.getOrDefault(self.predictionCol), F.arrow_udf(predicted, "double")(vector_to_array(self.getOrDefault(self.featuresCol))))
