"""Ridge, lasso and elastic net cross-validation from one pass over the rows (MD4-MD6 at scale, MD20, CV1, CV7, CV8).

Every representation is a linear map of a few raw columns per feature: a 0/1
column for each level (and one for "missing"), the value with missing as 0, and
a missing flag. ``fold_grams`` computes, per fold, the count, sums and pairwise
cross products of those raw columns and of the target in one scan (levels meet as
counts of integer code pairs, never as dense 0/1 rows); partial tables are merged on
the executors block by block in a tree whose depth follows the number of tasks, so the driver receives folds x width^2 numbers whatever the number of rows or tasks.

Training statistics of fold f are total minus f. Imputation by the training
median or mode, missing indicators, centring, scaling and level routing become
a sparse matrix A per fold and representation (two entries a column); ridge on
the represented columns is (A'CA + alpha I) w = A'c with the centred training
Gram C; lasso and elastic net run coordinate descent on the same A'CA and A'c. All folds, penalties,
feature sets and interaction pairs are solved from the same scan, and one
second scan scores them all.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.selection import grouped_quantiles
from ..session import written
from . import encode as en
from .profile import Profile, chunks, profile, whole

BLOCK = 64
FAN_IN = 32         # partial blocks that are added in one place
MAX_WIDTH = 8192    # raw columns: 5 folds of them are 2.7 GB on the driver
CHUNK = 1024
ROWS_PER_TASK = 100_000
TASKS_PER_CORE = 3
CODED = 2048        # codes up to which numbers that are no levels are counted by value too


@dataclass
class Design:
    """Raw columns: ``levels[c]`` lists the labels of c (None: missing), ``numbers`` the numeric columns."""

    levels: dict[str, list]
    numbers: list[str]
    numeric: set[str]

    def __post_init__(self):
        self.at: dict[tuple[str, object], int] = {}
        for c, labels in self.levels.items():
            for v in labels:
                self.at[(c, v)] = len(self.at)
        for c in self.numbers:
            self.at[(c, "__x")] = len(self.at)
            self.at[(c, "__null")] = len(self.at)
        self.width = len(self.at)


@dataclass
class Coder:
    """How rows are counted: columns whose values are all known as codes (one more for missing, -1 for a value not known),
    the other numbers as they are. ``labels[c]`` names the values of a numeric column as text."""

    text: dict[str, list[str]]
    values: dict[str, np.ndarray]
    dense: list[str]
    flagged: list[str]          # dense columns with missing values
    labels: dict[str, list[str]]

    def __post_init__(self):
        self.columns = [*self.text, *self.values]
        self.sizes = [len(v) + 1 for v in (*self.text.values(), *self.values.values())]
        self.ends = np.cumsum([0, *self.sizes])
        self.coded = int(self.ends[-1])
        self.width = self.coded + len(self.dense) + len(self.flagged)

    def inputs(self, text_suffix: str = "__l", number_suffix: str = "__n") -> list[str]:
        return [*[c + text_suffix for c in self.text], *[c + number_suffix for c in (*self.values, *self.dense)]]

    def codes(self, arrays: list[pa.Array]) -> list[np.ndarray]:
        """Code of every row in each coded column; ``arrays`` in the order of ``inputs``."""
        out = []
        for col, c in zip(arrays, self.columns):
            known = pa.array(self.text[c], pa.string()) if c in self.text else pa.array(self.values[c].view(np.int64))
            own = pc.index_in(col if c in self.text else col.view(pa.int64()), value_set=known).fill_null(-1).to_numpy().astype(np.int64)
            if col.null_count:
                own[col.is_null().to_numpy(zero_copy_only=False)] = len(known)
            out.append(own)
        return out

    def numbers(self, arrays: list[pa.Array]) -> np.ndarray:
        """Values (missing as 0) of the dense columns, then the missing flags of the flagged ones."""
        arrays = arrays[len(self.columns):]
        out = np.empty((len(arrays[0]) if arrays else 0, len(self.dense) + len(self.flagged)))
        for i, (c, col) in enumerate(zip(self.dense, arrays)):
            out[:, i] = col.fill_null(0.0).to_numpy()
            if c in self.flagged:
                out[:, len(self.dense) + self.flagged.index(c)] = col.is_null().to_numpy(zero_copy_only=False)
        return out

    def raw(self, m: np.ndarray, design: Design) -> np.ndarray:
        """Rows of ``m`` (codes, dense, flags, then any others) added up to rows of raw columns of ``design``, then the others."""
        out = np.zeros((design.width + len(m) - self.width, m.shape[1]))
        out[design.width:] = m[self.width:]
        for c, lo, hi in zip(self.columns, self.ends[:-1], self.ends[1:]):
            if c in design.levels:
                names = [*(self.text[c] if c in self.text else self.labels[c]), None]
                own = [(design.at[(c, v)], lo + i) for i, v in enumerate(names) if (c, v) in design.at]
                to, of = np.array(own).reshape(-1, 2).T
                out[to] = m[of]
            if (c, "__x") in design.at:
                out[design.at[(c, "__x")]] = self.values[c] @ m[lo:hi - 1]
                out[design.at[(c, "__null")]] = m[hi - 1]
        for i, c in enumerate(self.dense):
            out[design.at[(c, "__x")]] = m[self.coded + i]
            if c in self.flagged:
                out[design.at[(c, "__null")]] = m[self.coded + len(self.dense) + self.flagged.index(c)]
        return out

    def weights(self, z: np.ndarray, design: Design) -> np.ndarray:
        """Weights on codes, dense columns and flags of weights ``z`` (raw columns x models); a last row of zeros for code -1."""
        out = np.zeros((self.width + 1, z.shape[1]))
        for c, lo, hi in zip(self.columns, self.ends[:-1], self.ends[1:]):
            if c in design.levels:
                names = [*(self.text[c] if c in self.text else self.labels[c]), None]
                for i, v in enumerate(names):
                    if (c, v) in design.at:
                        out[lo + i] = z[design.at[(c, v)]]
            if (c, "__x") in design.at:
                out[lo:hi - 1] += np.outer(self.values[c], z[design.at[(c, "__x")]])
                out[hi - 1] += z[design.at[(c, "__null")]]
        for i, c in enumerate(self.dense):
            out[self.coded + i] = z[design.at[(c, "__x")]]
            if c in self.flagged:
                out[self.coded + len(self.dense) + self.flagged.index(c)] = z[design.at[(c, "__null")]]
        return out


def number_labels(spark, x: np.ndarray) -> list[str]:
    """The text that a cast to string gives for each number (a bounded list)."""
    of = spark._jvm.java.lang.Double.toString
    return [of(float(v)) for v in x]


def coder_of(found: Profile, spark, text: list[str], nums: list[str], levels: list[str], most: int) -> Coder:
    """Codes for the columns ``text`` and for numbers with at most ``most`` values; numbers in ``levels`` always have them."""
    room = CODED - sum(len(found.text[c]) + 1 for c in text)
    values = {c: found.numbers[c].values for c in nums if c in levels}
    for c in nums:
        x = found.numbers[c].values
        if c not in values and x is not None and len(x) <= most and len(x) < room:
            values[c] = x
            room -= len(x) + 1
    dense = [c for c in nums if c not in values]
    order = lambda v: v.encode("utf-8", "surrogatepass")
    return Coder({c: sorted((v for v in found.text[c] if v is not None), key=order) for c in text}, values, dense,
                 [c for c in dense if found.numbers[c].missing.any()], {c: number_labels(spark, values[c]) for c in levels if c in values})


def prepare(df: DataFrame, cols: list[str], fold: str = "fold", target: str = "price", key_limit: int = 10 * en.MAX_LEVELS, k: int = 5):
    """(design, rows, coder, profile): the labels of every column that may be encoded as levels, and the narrow table both scans read."""
    types = {f.name: f.dataType for f in df.schema.fields}
    text = [c for c in cols if isinstance(types[c], T.StringType)]
    nums = [c for c in cols if c not in text]
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    rows = written(df.select(F.col(fold).cast("int").alias("fold"), F.col(target).cast("double").alias("y"), *[F.col(c).alias(c + "__l") for c in text],
                             *[number(c).alias(c + "__n") for c in nums]), "scan-rows", wide=True)
    found = profile(rows, [c + "__l" for c in text], [c + "__n" for c in nums], F.col("fold"), k)
    found = Profile(found.rows, {c[:-3]: v for c, v in found.text.items()}, {c[:-3]: v for c, v in found.numbers.items()})
    folds = np.flatnonzero(found.rows)
    small = []
    for c in nums:     # a number that has too many levels in the training rows of every fold needs no level columns
        x = found.numbers[c]
        if x.values is None or len(x.values) > key_limit:
            continue
        if not all((x.counts.sum(axis=1) > x.counts[:, f]).sum() > en.MAX_LEVELS for f in folds):
            small.append(c)
    coder = coder_of(found, df.sparkSession, text, nums, small, key_limit)
    levels = {}
    for c in (*text, *small):
        gone = found.text[c].get(None) is not None if c in text else found.numbers[c].missing.any()
        levels[c] = [*([None] if gone else []), *(coder.text[c] if c in text else sorted(coder.labels[c]))]
    return Design(levels, nums, set(nums)), rows, coder, found


def _cross(coder: Coder, inputs: list[str]):
    """Arrow batches (fold, y, inputs) -> partial cross products of (codes, dense, flags, 1, target), upper blocks of rows."""
    p, first, ends = coder.width + 2, coder.coded, coder.ends

    def add(a: np.ndarray, codes: list[np.ndarray], dense: np.ndarray) -> None:
        """Levels meet levels as counts of code pairs, values as sums by code."""
        a[first:, first:] += dense.T @ dense
        pair = np.empty(len(dense), np.int64)
        for l, own in enumerate(codes):
            lo, hi = ends[l], ends[l + 1]
            n = np.bincount(own, minlength=hi - lo)
            a[np.arange(lo, hi), np.arange(lo, hi)] += n
            a[lo:hi, p - 2] += n
            for d in range(dense.shape[1]):
                if first + d != p - 2:
                    a[lo:hi, first + d] += np.bincount(own, dense[:, d], hi - lo)
            for m in range(l + 1, len(codes)):
                width = ends[m + 1] - ends[m]
                np.multiply(own, width, out=pair)
                np.add(pair, codes[m], out=pair)
                a[lo:hi, ends[m]:ends[m + 1]] += np.bincount(pair, minlength=(hi - lo) * width).reshape(hi - lo, width)

    def fn(batches):
        acc: dict[int, np.ndarray] = {}
        for table in chunks(batches):
            arrays = [whole(table, c) for c in inputs]
            codes, fold, y = coder.codes(arrays), whole(table, "fold").to_numpy(), whole(table, "y").fill_null(np.nan).to_numpy()
            dense = np.column_stack([coder.numbers(arrays) if coder.dense else np.empty((len(y), 0)), np.ones(len(y)), y])
            for f in np.unique(fold):
                own = np.flatnonzero(fold == f)
                every = len(own) == len(fold)
                add(acc.setdefault(int(f), np.zeros((p, p))), codes if every else [c[own] for c in codes], np.asfortranarray(dense if every else dense[own]))
        task = TaskContext.get().partitionId()
        for f, a in acc.items():
            for lo in range(0, p, BLOCK):       # what lies left of the diagonal follows by symmetry
                yield pa.record_batch([pa.array([f], pa.int32()), pa.array([lo // BLOCK], pa.int32()), pa.array([task], pa.int32()),
                                       pa.array([np.ascontiguousarray(a[lo:lo + BLOCK, lo:]).tobytes()], pa.binary())], names=["fold", "blk", "part", "v"])
    return fn


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(v) for v in pdf["v"])
    return pd.DataFrame({"fold": pdf["fold"].iloc[:1], "blk": pdf["blk"].iloc[:1], "part": pdf["part"].iloc[:1], "v": [total.tobytes()]})


def merged_blocks(part: DataFrame, tasks: int, merge, schema: str) -> DataFrame:
    """Partial blocks (fold, blk, part, ..) merged by ``merge``, ``FAN_IN`` of a block in one place, until one is left of each."""
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        part = part.withColumn("part", F.pmod("part", F.lit(tasks)).cast("int")).groupBy("fold", "blk", "part").applyInPandas(merge, schema)
    return part


def fold_grams(rows: DataFrame, coder: Coder, design: Design, k: int, inputs: list[str] | None = None) -> dict[int, np.ndarray]:
    """{fold: cross products of (raw columns, 1, target)} from one pass."""
    schema = "fold int, blk int, part int, v binary"
    p = coder.width + 2
    if max(p, design.width + 2) > MAX_WIDTH:
        raise ValueError(f"{max(p, design.width + 2)} raw columns: cross products of at most {MAX_WIDTH} are held per fold")
    # a task's result has width^2 / 2 numbers per fold: give it enough rows to be worth that, and no more tasks than keep the cores busy
    tasks = min(max(1, -(-rows.count() // ROWS_PER_TASK)), TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)
    rows = rows.coalesce(tasks)
    part = merged_blocks(rows.mapInArrow(_cross(coder, inputs or coder.inputs()), schema), rows.rdd.getNumPartitions(), _merge, schema)
    out: dict[int, np.ndarray] = {f: np.zeros((p, p)) for f in range(k)}
    for r in part.collect():
        lo = r["blk"] * BLOCK
        v = np.frombuffer(bytes(r["v"])).reshape(-1, p - lo)
        out[r["fold"]][lo:lo + len(v), lo:] += v
    for f, a in out.items():
        a = np.triu(a)
        a += np.triu(a, 1).T
        out[f] = coder.raw(coder.raw(a, design).T, design)
    return out


def fold_medians(rows: DataFrame, design: Design, found: Profile, k: int) -> dict[tuple[int, str], float]:
    """Training median of every fold for the numeric columns that have missing values (others need none)."""
    holes = [c for c in design.numbers if found.numbers[c].missing.any()]
    wide = [c for c in holes if found.numbers[c].values is None]
    out = {(f, c): found.numbers[c].median(np.arange(k) != f) or 0.0 for f in range(k) for c in holes if c not in wide}
    if wide:
        cols = {f"{f}:{c}": F.when(F.col("fold") != f, F.col(c + "__n")) for f in range(k) for c in wide}
        got = grouped_quantiles(rows.select(*[e.alias(a) for a, e in cols.items()]), list(cols), [0.5])
        out |= {(int(a.split(":")[0]), a.split(":", 1)[1]): v[0] or 0.0 for a, v in got.items()}
    return out


def representation(design: Design, train: np.ndarray, medians: dict[str, float], cols: list[str], kind: str,
                   max_levels: int = en.MAX_LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """Represented columns of ``kind`` on the features ``cols`` (EN13-EN15), from training cross products.

    Each is a combination of at most two raw columns (a level and "missing" imputed by it; a value and its missing
    flag times the median): (indices, coefficients), both columns x 2.
    """
    n, one = train[design.width, design.width], design.width
    out: list[tuple[int, int, float, float]] = []

    def dummies(c: str, missing_is_level: bool) -> None:
        count = {v: train[design.at[(c, v)], one] for v in design.levels[c]}
        seen = [v for v in design.levels[c] if v is not None and count[v] > 0]
        mode = min((v for v in seen), key=lambda v: (-count[v], v), default=None)
        for v in seen:
            i = design.at[(c, v)]
            fills = v == mode and not missing_is_level and (c, None) in design.at
            out.append((i, design.at[(c, None)] if fills else i, 1.0, 1.0 if fills else 0.0))
        if missing_is_level and count.get(None, 0) > 0:
            out.append((design.at[(c, None)], design.at[(c, None)], 1.0, 0.0))

    def scaled(i: int, j: int, u: float, v: float) -> None:
        mean = (u * train[i, one] + v * train[j, one]) / n
        var = (u * u * train[i, i] + 2 * u * v * train[i, j] + v * v * train[j, j]) / n - mean * mean
        sd = np.sqrt(var) if var > 1e-12 * max(1.0, mean * mean) else 1.0
        out.append((i, j, u / sd, v / sd))

    def number(c: str) -> None:
        x, m = design.at[(c, "__x")], design.at[(c, "__null")]
        scaled(x, m, 1.0, medians.get(c, 0.0))
        if train[m, one] > 0:
            flags.append(m)

    flags: list[int] = []
    text = [c for c in cols if c not in design.numeric]
    nums = [c for c in cols if c in design.numeric]
    if kind == "onehot":
        for c in text:
            dummies(c, False)
        for c in nums:
            number(c)
    elif kind in ("levels", "levels_plus"):
        few = [c for c in nums if c in design.levels
               and sum(train[design.at[(c, v)], one] > 0 for v in design.levels[c] if v is not None) <= max_levels]
        for c in text + few:
            dummies(c, True)
        for c in nums:
            if c not in few or kind == "levels_plus":
                number(c)
    else:
        raise ValueError(f"ridge scans run on onehot, levels and levels_plus, not {kind!r}")
    for m in flags:
        scaled(m, m, 1.0, 0.0)
    cells = np.array(out)
    return cells[:, :2].astype(int), cells[:, 2:]


def represented_products(centred: np.ndarray, rep: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Centred cross products of the represented columns, and theirs with the target."""
    (i, j), (u, v) = rep[0].T, rep[1].T
    half = centred[:, i] * u + centred[:, j] * v
    return half[i] * u[:, None] + half[j] * v[:, None], half[-1]


def on_raw_columns(w: np.ndarray, train: np.ndarray, rep: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, float]:
    """(weights on the raw columns, intercept) of weights on the represented ones."""
    one, y = len(train) - 2, len(train) - 1
    (i, j), (u, v) = rep[0].T, rep[1].T
    z = np.zeros(one)
    np.add.at(z, i, w * u)
    np.add.at(z, j, w * v)
    return z, float(train[one, y] / train[one, one] - train[:one, one] / train[one, one] @ z)


def coordinate_descent(x: np.ndarray, c: np.ndarray, n: float, l1: float, l2: float, w: np.ndarray, tolerance: float = 1e-12,
                       most: int = 100_000) -> np.ndarray:
    """min 1/(2n) ||y - Xw||^2 + l1 |w|_1 + l2/2 ||w||^2 from x = X'X and c = X'y, by covariance updates from ``w``.

    Sweeps run over the columns in use until these settle, then over all of them; it ends when a sweep over all moves no
    column by more than ``tolerance`` of the target's largest correlation.
    """
    w, diag = w.copy(), np.diag(x)
    rest = c - x @ w                    # X'(y - Xw)
    limit = tolerance * max(float(np.abs(c).max(initial=0)), np.finfo(float).tiny)
    live = np.flatnonzero(diag > 0)

    def sweep(columns) -> float:
        moved = 0.0
        for j in columns:
            old = w[j]
            r = rest[j] + diag[j] * old
            new = np.sign(r) * max(abs(r) - n * l1, 0.0) / (diag[j] + n * l2)
            if new != old:
                rest[:] -= x[:, j] * (new - old)
                w[j] = new
                moved = max(moved, abs(new - old) * diag[j])
        return moved

    for _ in range(most):
        if sweep(live) <= limit:
            return w
        for _ in range(most):
            if sweep(np.flatnonzero(w)) <= limit:
                break
    raise RuntimeError(f"coordinate descent did not settle in {most} sweeps")


def elastic_net_path(train: np.ndarray, centred: np.ndarray, rep: tuple[np.ndarray, np.ndarray], alphas: list[float],
                     l1_ratio: float) -> list[tuple[np.ndarray, float]]:
    """MD5 / MD6: (weights on the raw columns, intercept) per alpha, each started from the next larger alpha's weights."""
    x, c = represented_products(centred, rep)
    n, w, out = train[-2, -2], np.zeros(len(x)), {}
    for alpha in sorted(set(alphas), reverse=True):
        w = coordinate_descent(x, c, n, alpha * l1_ratio, alpha * (1 - l1_ratio), w)
        out[alpha] = on_raw_columns(w, train, rep)
    return [out[a] for a in alphas]


def ridge_solve(train: np.ndarray, centred: np.ndarray, rep: tuple[np.ndarray, np.ndarray], alphas: list[float]) -> list[tuple[np.ndarray, float]]:
    """(weights on the raw columns, intercept) per alpha: min ||y - b - Xw||^2 + alpha ||w||^2, b free.

    ``centred``: centred training cross products of the raw columns and (last) the target.
    """
    x, c = represented_products(centred, rep)
    out = []
    for alpha in alphas:
        m = x + alpha * np.eye(len(x))
        w = np.linalg.lstsq(m, c, rcond=None)[0] if alpha == 0 else np.linalg.solve(m, c)
        out.append(on_raw_columns(w, train, rep))
    return out


def centred_products(train: np.ndarray) -> np.ndarray:
    """Cross products of (raw columns, target) about their means."""
    n = train[-2, -2]
    keep = np.r_[0:len(train) - 2, len(train) - 1]
    mean = train[keep, -2] / n
    return train[np.ix_(keep, keep)] - n * np.outer(mean, mean)


def linear_scores(coder: Coder, arrays: list[pa.Array], w: np.ndarray) -> np.ndarray:
    """Rows x models: sums of the weights ``w`` (``Coder.weights``) of every row's codes, values and flags."""
    first = coder.coded
    out = coder.numbers(arrays) @ w[first:-1] if coder.dense else np.zeros((len(arrays[0]), w.shape[1]))
    for own, lo in zip(coder.codes(arrays), coder.ends):
        out += w[np.where(own < 0, -1, own + lo)]
    return out


SCORED = pa.schema([("variant", pa.string()), ("alpha", pa.float64()), ("fold", pa.int32()), ("role", pa.string()), ("n", pa.int64()),
                    ("sse", pa.float64()), ("sae", pa.float64())])


def _scores(coder: Coder, inputs: list[str], keys: list[tuple], w: np.ndarray, b: np.ndarray):
    fid = np.array([k[2] for k in keys])

    def fn(batches):
        acc = np.zeros((len(keys), 2, 3))
        for whole_table in chunks(batches, 8 * CHUNK):
            for lo in range(0, whole_table.num_rows, CHUNK):
                table = whole_table.slice(lo, CHUNK)
                y, fold = whole(table, "y").fill_null(np.nan).to_numpy(), whole(table, "fold").to_numpy()
                e = y[:, None] - (linear_scores(coder, [whole(table, c) for c in inputs], w) + b)
                for f in np.unique(fold):
                    own = e[fold == f]
                    sums = np.stack([np.full(len(keys), float(len(own))), np.einsum("ij,ij->j", own, own), np.abs(own).sum(axis=0)], axis=1)
                    val = fid == f
                    acc[val, 1] += sums[val]
                    acc[~val, 0] += sums[~val]
        out = [(*key, role, int(n), sse, sae) for key, own in zip(keys, acc) for role, (n, sse, sae) in zip(("train", "val"), own) if n > 0]
        if out:
            yield pa.record_batch([pa.array(v, f.type, from_pandas=True) for v, f in zip(zip(*out), SCORED)], schema=SCORED)     # NaN: null
    return fn


class CrossProducts:
    """Raw columns of the features ``cols`` and their cross products per fold, from one pass; every scan of variants on some
    of these features is solved from them."""

    def __init__(self, df: DataFrame, cols: list[str], k: int = 5, fold: str = "fold", target: str = "price"):
        self.k = k
        self.design, self.rows, self.coder, found = prepare(df, cols, fold, target, k=k)
        self.grams = fold_grams(self.rows, self.coder, self.design, k)
        self.total = sum(self.grams.values())
        self.medians = fold_medians(self.rows, self.design, found, k)

    def scan(self, variants: dict[str, tuple[list[str], str]], alphas: list[float], l1_ratio: float | None = None, absolute: bool = True) -> DataFrame:
        """(variant, alpha, fold, role, n, rmse, mae) for every variant (features, representation), alpha and fold.

        The rows are read once more, to score; without ``absolute`` there is no ``mae``, and squared errors follow from the
        folds' own cross products.
        """
        keys, w, b = [], [], []
        for f in range(self.k):
            train = self.total - self.grams[f]
            med = {c: v for (g, c), v in self.medians.items() if g == f}
            centred = centred_products(train)
            for name, (feats, kind) in variants.items():
                rep = representation(self.design, train, med, feats, kind)
                fits = ridge_solve(train, centred, rep, alphas) if l1_ratio is None else elastic_net_path(train, centred, rep, alphas, l1_ratio)
                for alpha, (v, b0) in zip(alphas, fits):
                    keys.append((name, float(alpha), f))
                    w.append(v)
                    b.append(b0)
        if not absolute:
            return self._squared(keys, np.stack(w), np.array(b))
        weights = self.coder.weights(np.stack(w, axis=1), self.design)
        part = self.rows.mapInArrow(_scores(self.coder, self.coder.inputs(), keys, weights, np.array(b)),
                                    "variant string, alpha double, fold int, role string, n long, sse double, sae double")
        g = part.groupBy("variant", "alpha", "fold", "role").agg(F.sum("n").alias("n"), F.sum("sse").alias("sse"), F.sum("sae").alias("sae"))
        return g.select("variant", "alpha", "fold", "role", "n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"), (F.col("sae") / F.col("n")).alias("mae"))

    def _squared(self, keys: list[tuple], w: np.ndarray, b: np.ndarray) -> DataFrame:
        """(variant, alpha, fold, role, n, rmse): y - b - xw squared and summed over a fold is a form in its cross products."""
        v = np.column_stack([-w, -b, np.ones(len(b))])
        n = {f: g[-2, -2] for f, g in self.grams.items()}
        sse = {f: np.einsum("ij,ij->i", v @ g, v) for f, g in self.grams.items()}
        out = []
        for i, (name, alpha, f) in enumerate(keys):
            for role, own in (("val", [f]), ("train", [g for g in self.grams if g != f])):
                rows = sum(n[g] for g in own)
                if rows > 0:
                    total = float(sum(sse[g][i] for g in own))
                    out.append((name, alpha, f, role, int(rows), None if np.isnan(total) else float(np.sqrt(max(total, 0.0) / rows))))
        return self.rows.sparkSession.createDataFrame(out, "variant string, alpha double, fold int, role string, n long, rmse double")


def ridge_scan(df: DataFrame, variants: dict[str, tuple[list[str], str]], alphas: list[float], k: int = 5, fold: str = "fold",
               target: str = "price", l1_ratio: float | None = None, absolute: bool = True) -> DataFrame:
    """(variant, alpha, fold, role, n, rmse, mae) of ridge for every variant (features, representation), alpha and fold.

    With ``l1_ratio`` the path of the elastic net instead (1: lasso), alpha on the scale of the mean squared error;
    ``absolute`` as in ``CrossProducts.scan``.
    """
    cols = list(dict.fromkeys(c for feats, _ in variants.values() for c in feats))
    return CrossProducts(df, cols, k, fold, target).scan(variants, alphas, l1_ratio, absolute)


def scan_summary(scan: DataFrame) -> DataFrame:
    """CV1-style summary per variant and alpha: mean train/val RMSE, val sd, gap."""
    v, t = F.col("role") == "val", F.col("role") == "train"
    return scan.groupBy("variant", "alpha").agg(
        F.avg(F.when(t, F.col("rmse"))).alias("train_rmse"), F.avg(F.when(v, F.col("rmse"))).alias("val_rmse"),
        F.avg(F.when(v, F.col("mae"))).alias("val_mae"),
        F.coalesce(F.stddev_samp(F.when(v, F.col("rmse"))), F.lit(0.0)).alias("val_rmse_std"),
    ).withColumn("gap", F.col("val_rmse") - F.col("train_rmse"))
