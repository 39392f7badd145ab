"""Linear models on a fitted representation without encoded vectors.

A representation's vector consists of columns of three kinds: a level of a text or number, a number with a stand-in for
missing values, and a missing flag. Their order and constants (``Layout``) are read from the stage itself. From that,

* ``moment_rows`` gives a solver on few weighted rows what it needs of all rows: cross products of levels and values are
  counted once (``linear.fold_grams``), turned into those of the vector's columns, and factored into one row per column
  whose weighted count, means and cross products are the same. A solver that reads its rows only through these (normal
  equations, or a quasi-Newton method on them) finds the same model.
* ``LinearScorer`` predicts by looking weights up by level.
"""
from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .linear import CODED, Design, centred_products, coder_of, fold_grams

LAYOUT = "layout:"
NO_LABEL = "__missing__"


@dataclass
class Layout:
    """Columns of the vector, part by part; ``labels`` of the i-th level part in the order of its columns."""
    parts: list[dict]
    labels: list[list[str]]

    @staticmethod
    def of(rep) -> "Layout | None":
        """The layout of a fitted representation; None for any other stage."""
        stages = getattr(rep, "stages", None)
        found = re.search(rf"/\* {LAYOUT}([0-9a-f]+) \*/$", stages[0].getStatement()) if stages and hasattr(stages[0], "getStatement") else None
        if not found:
            return None
        labels = [list(v) for st in stages if hasattr(st, "labelsArray") for v in st.labelsArray]
        return Layout(json.loads(bytes.fromhex(found.group(1)).decode()), labels)


def _bits(label: str) -> float | None:
    """The number that a label of a numeric column stands for; None for the label of missing values."""
    return None if label == NO_LABEL else float(label)


class LinearScorer:
    """Prediction of a linear model from the columns that its representation reads."""

    def __init__(self, layout: Layout, weights: np.ndarray, intercept: float, out: str):
        self.out, self.intercept, self.tables, self.numbers = out, intercept, [], []
        at = 0
        for i, part in enumerate(layout.parts):
            if part["part"] != "level":
                w = float(weights[at]) / part["sd"]
                at += 1
                # (column, weight, stand-in, added): a flag weighs missing rows only
                self.numbers.append((part["col"], part["part"], w, np.nan if part.get("fill") is None else part["fill"], -w * part["mean"]))
                continue
            labels = layout.labels[i]
            if part["as"] == "onehot":
                own, unseen = weights[at:at + len(labels)], 0.0
                at += len(labels)
            else:
                own, unseen = weights[at] * np.arange(len(labels)), float(weights[at]) * (-1.0 if part["as"] == "ordinal" else len(labels))
                at += 1
            fill = {v: float(w) for v, w in zip(labels, own)}.get(part["fill"], unseen)
            number = part.get("number", False)
            known = [(_bits(v) if number else v, float(w)) for v, w in zip(labels, own)]
            known = [(v, w) for v, w in known if v is not None]
            self.tables.append((part["col"], number, [v for v, _ in known], np.array([w for _, w in known] + [unseen]), fill))

    @staticmethod
    def of(rep, model) -> "LinearScorer | None":
        layout = Layout.of(rep) if isinstance(model, LinearRegressionModel) else None
        return None if layout is None else LinearScorer(layout, model.coefficients.toArray(), float(model.intercept), model.getPredictionCol())

    def transform(self, df: DataFrame) -> DataFrame:
        text = list(dict.fromkeys(c for c, number, *_ in self.tables if not number))
        nums = list(dict.fromkeys([c for c, number, *_ in self.tables if number] + [c for c, *_ in self.numbers]))
        if not text and not nums:
            return df.withColumn(self.out, F.lit(self.intercept))
        at = {c: i for i, c in enumerate([*text, *nums])}
        tables, numbers, start = self.tables, self.numbers, self.intercept

        def predicted(*cols: pa.Array) -> pa.Array:
            total = np.full(len(cols[0]), start)
            for c, number, known, own, fill in tables:
                col = cols[at[c]]
                values = pa.array(np.array(known, float).view(np.int64)) if number else pa.array(known, pa.string())
                place = pc.index_in(col.view(pa.int64()) if number else col, value_set=values).fill_null(len(known)).to_numpy()
                w = own[place]
                if col.null_count:
                    w[col.is_null().to_numpy(zero_copy_only=False)] = fill
                total += w
            for c, kind, w, fill, added in numbers:
                col = cols[at[c]]
                x = col.is_null().to_numpy(zero_copy_only=False).astype(float) if kind == "flag" else col.fill_null(fill).to_numpy()
                total += x * w + added
            return pa.array(total)

        udf = F.arrow_udf(predicted, "double")
        return df.withColumn(self.out, udf(*[F.col(f"`{c}`").cast("string") for c in text], *[F.col(f"`{c}`").cast("double") for c in nums]))


def _cells(layout: Layout, design: Design) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each column of the vector as a combination of two raw columns: (indices, coefficients, what is taken off)."""
    out = []
    for i, part in enumerate(layout.parts):
        c = part["col"]
        if part["part"] != "level":
            x, gone = design.at[(c, "__x")], design.at[(c, "__null")]
            sd = part["sd"]
            out.append((gone, gone, 1.0 / sd, 0.0, part["mean"] / sd) if part["part"] == "flag" else
                       (x, gone, 1.0 / sd, (part["fill"] or 0.0) / sd, part["mean"] / sd))
            continue
        for v in layout.labels[i]:
            here, gone = design.at.get((c, v)), design.at.get((c, None)) if v == part["fill"] else None
            if here is None:
                here, gone = gone, None
            out.append((here, here if gone is None else gone, 1.0, 0.0 if gone is None else 1.0, 0.0))
    cells = np.array(out)
    return cells[:, :2].astype(int), cells[:, 2:4], cells[:, 4]


def moment_rows(rows: DataFrame, rep: PipelineModel, label: str) -> tuple[DataFrame, float, float] | None:
    """(features, label, weight) with the weighted moments of ``rep.transform(rows)``, its number of rows, and the label's
    population standard deviation. None where that isn't possible: columns other than levels, values and flags, no rows, or
    a moment that isn't finite."""
    layout, found = Layout.of(rep), getattr(rep, "found", None)
    if layout is None or found is None or not found.n or any(p["part"] == "level" and p["as"] != "onehot" for p in layout.parts):
        return None
    if any(p["part"] == "number" and p["fill"] is None for p in layout.parts):
        return None
    levels = [p["col"] for p in layout.parts if p["part"] == "level"]
    text = [c for c in levels if c in found.text]
    numeric = [c for c in levels if c not in found.text]
    numbers = list(dict.fromkeys(p["col"] for p in layout.parts if p["part"] != "level"))
    nums = list(dict.fromkeys([*numeric, *numbers]))
    spark = rows.sparkSession
    coder = coder_of(found, spark, text, nums, numeric, CODED // 4)
    named = {c: [*([None] if None in found.text[c] else []), *coder.text[c]] for c in text}
    named |= {c: [*([None] if found.numbers[c].missing.any() else []), *coder.labels[c]] for c in numeric}
    design = Design(named, numbers, set(nums))
    cells = _cells(layout, design)
    width = len(cells[2])
    if not width or max(width, design.width, coder.width) > 4094:
        return None
    inputs = [f"_{i}" for i in range(len(coder.columns) + len(coder.dense))]
    cast = [F.col(f"`{c}`").cast("string" if c in coder.text else "double").alias(a) for c, a in zip([*coder.columns, *coder.dense], inputs)]
    raw = fold_grams(rows.select(F.lit(0).alias("fold"), F.col(label).cast("double").alias("y"), *cast), coder, design, 1, inputs)[0]
    if not np.isfinite(raw).all():
        return None
    n = raw[-2, -2]
    (i, j), (u, v) = cells[0].T, cells[1].T
    mean = (u * raw[i, -2] + v * raw[j, -2]) / n - cells[2]
    centred = centred_products(raw)
    half = centred[:, i] * u + centred[:, j] * v
    both = np.empty((width + 1, width + 1))
    both[:-1, :-1] = half[i] * u[:, None] + half[j] * v[:, None]
    both[-1, :-1] = both[:-1, -1] = half[-1]
    both[-1, -1] = centred[-1, -1]
    same = np.append(np.diag(both)[:-1] <= 1e-13 * (u * u * raw[i, i] + 2 * u * v * raw[i, j] + v * v * raw[j, j]), False)
    both[same], both[:, same] = 0.0, 0.0        # columns of one value: the solver must see that they are constant
    few, weight = factored(both, np.append(mean, raw[-1, -2] / n), n)
    few[:, same] = np.append(mean, 0.0)[same]
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField(label, T.DoubleType()), T.StructField("weight", T.DoubleType())])
    made = spark.createDataFrame([(Vectors.dense(r[:-1]), float(r[-1]), weight) for r in few], schema)
    meta = rep.transform(rows.limit(0)).schema["features"].metadata     # the names of the columns
    return made.withColumn("features", F.col("features").alias("features", metadata=meta)), float(n), float(np.sqrt(max(centred[-1, -1], 0.0) / n))


def factored(products: np.ndarray, mean: np.ndarray, n: float) -> tuple[np.ndarray, float]:
    """(rows, weight of each): rows whose weighted number is ``n``, mean ``mean`` and centred cross products ``products``."""
    scale = np.sqrt(np.maximum(np.diag(products), 0.0))
    scale[scale == 0] = 1.0
    size, turn = np.linalg.eigh(products / np.outer(scale, scale))
    z = np.zeros((len(mean) + 1, len(mean) + 1))
    z[0, 0], z[0, 1:] = np.sqrt(n), np.sqrt(n) * mean
    z[1:, 1:] = np.sqrt(np.maximum(size, 0.0))[:, None] * turn.T * scale
    # a reflection keeps all products and spreads the first column, the root of the weights, evenly over the rows
    m = len(z)
    axis = np.full(m, -1.0 / np.sqrt(m))
    axis[0] += 1.0
    if axis @ axis > 0:
        z -= np.outer(axis, axis @ z) * (2.0 / (axis @ axis))
    weight = n / m
    return z[:, 1:] / np.sqrt(weight), float(weight)
