"""Embedding whitening by Jacobi-Davidson on a matrix that is never formed.

Each entry c of a vector becomes the whole number x = floor(256 c). The fit list
holds every distinct x vector once, packed into binary blocks in the shared
folder. The covariance V of the fit list is only ever applied: a distributed
pass sends a thin block Y to the tasks, each of which returns the sum of
(x - m)(x - m)'Y over its blocks; the driver holds vectors of the embedding's
dimension, never rows.

Jacobi-Davidson for the leading eigenpairs: Rayleigh-Ritz in a small subspace gives
Ritz pairs (e, u) with residual r = Vu - eu; the correction t, orthogonal to all
Ritz vectors asked for and to the locked ones (projector P), solves
P(V - eI)P t = -r by an inner MINRES; t widens the subspace. All pairs still
open are corrected together, so that an inner step is one pass for all of them.
A pair is locked once its residual is at rounding level; the iteration ends when
all are. Lanczos vectors of MINRES, Ritz vectors and corrections are d numbers each.

Sums per dimension, and each row's ``deviation``, are exact integers.

Defined cases: a vector that is null or holds a null or a non-finite entry takes no
part; a shorter vector counts as padded with zeros; repeated rows are fitted once and
each returned; rows without an id are returned; an x beyond 64 bits stands at the
limit, so does a deviation; directions without variance (as many as the vectors lack
in rank) give no component, so a table of equal vectors gives no rows; an empty table
gives an empty result; extra columns take no part.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

SCALE = 256
COMPONENTS = 4
BLOCK_BYTES = 4 << 20
FAN_IN = 256            # partial sums that are added in one place
MAX_BASIS = 40
INNER_STEPS = 8
INNER_TOLERANCE = 0.03
OUTER_STEPS = 200
EPS = float(np.finfo(float).eps)
_TOP = float(1 << 63)
_INTS = ("<i2", "<i4", "<i8")


@dataclass
class Whitening:
    """n vectors with exact sums; unit eigenvectors as columns; their eigenvalues, falling."""
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    residual: float         # largest |Vu - eu| over the largest eigenvalue
    passes: int             # distributed products it took

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def whole(values: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """floor(scale * values) as 64-bit integers, at the limit beyond them."""
    with np.errstate(over="ignore"):
        x = np.floor(scale * values)
    low, high = x <= -_TOP, x >= _TOP
    out = np.where(low | high, 0, x).astype(np.int64)
    out[low], out[high] = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    return out


def quantised(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """vec_id, x (array<long>) of the vectors that take part."""
    def run(batches):
        for b in batches:
            col = b.column(1)
            size = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
            flat = pc.list_flatten(col).cast(pa.float64())
            values = flat.to_numpy(zero_copy_only=False)            # nulls become NaN
            row = pc.list_parent_indices(col).to_numpy()
            keep = size >= 0
            keep[row[~np.isfinite(values)]] = False
            ends = np.concatenate([[0], np.cumsum(size[keep])]).astype(np.int32)
            x = pa.ListArray.from_arrays(pa.array(ends), pa.array(whole(values[keep[row]], scale)))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep)), x], names=["vec_id", "x"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(run, f"vec_id {kind}, x array<long>")


def _padded(dim: int):
    return F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x")))


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of equal length as one matrix."""
    return col.flatten().to_numpy().reshape(len(col), dim)


def blocks(rows: DataFrame, dim: int) -> DataFrame:
    """The distinct vectors of ``rows`` in binary blocks: kind (integer type), body."""
    per = max(1, BLOCK_BYTES // (8 * dim))

    def run(batches):
        held, n = [], 0

        def block():
            x = np.concatenate(held)
            kind = next(k for k in _INTS if k == _INTS[-1] or (np.iinfo(k).min <= x.min() and x.max() <= np.iinfo(k).max))
            return pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([x.astype(kind).tobytes()], pa.binary())], names=["kind", "body"])

        for b in batches:
            for lo in range(0, b.num_rows, per):
                part = matrix(b.column(0).slice(lo, per), dim)
                held.append(part)
                n += len(part)
                if n >= per:
                    yield block()
                    held, n = [], 0
        if n:
            yield block()

    return rows.select(_padded(dim).alias("x")).distinct().mapInArrow(run, "kind string, body binary")


def block_sum(fit: DataFrame, dim: int, part: Callable[[np.ndarray], np.ndarray], zero: np.ndarray) -> np.ndarray:
    """Sum of ``part(x)`` (an array shaped like ``zero``) over all blocks. Each task returns one partial sum; they are
    added in the order of the tasks, ``FAN_IN`` in one place."""
    shape, exact = zero.shape, zero.dtype == object
    kind = pa.string() if exact else pa.float64()

    def add(task: int, total: np.ndarray):
        body = [str(v) for v in total.ravel()] if exact else total.ravel()
        return pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([body], pa.list_(kind))], names=["task", "part"])

    def read(col, i):
        own = col[i].values
        return np.array([int(v) for v in own.to_pylist()], object) if exact else own.to_numpy()

    def run(batches):
        total = zero.copy()
        for b in batches:
            for k, body in zip(b.column(0).to_pylist(), b.column(1)):
                total = total + part(np.frombuffer(body.as_buffer(), k).reshape(-1, dim))
        yield add(TaskContext.get().partitionId(), total)

    def merge(batches):
        own = sorted((t, read(b.column(1), i)) for b in batches for i, t in enumerate(b.column(0).to_pylist()))
        if own:
            yield add(own[0][0], sum((p for _, p in own[1:]), own[0][1]))

    schema = f"task int, part array<{'string' if exact else 'double'}>"
    tasks, sums = fit.rdd.getNumPartitions(), fit.mapInArrow(run, schema)
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        sums = sums.repartition(tasks, "task").mapInArrow(merge, schema)
    got = sorted(sums.collect(), key=lambda r: r["task"])
    return sum((np.array([int(v) for v in r["part"]] if exact else r["part"], zero.dtype) for r in got), zero.ravel()).reshape(shape)


def exact_sums(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers, after the number of rows."""
    if not len(x):
        return np.array([0] * (x.shape[1] + 1), object)
    safe = max(abs(int(x.min())), abs(int(x.max()))) * len(x) < 1 << 62
    s = x.sum(axis=0, dtype=np.int64) if safe else x.astype(object).sum(axis=0)
    return np.array([len(x), *[int(v) for v in s]], object)


def minres(product: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Approximate solutions t of product(t) = rhs, column by column in step (one product for all columns)."""
    beta = np.linalg.norm(rhs, axis=0)
    first = np.where(beta > 0, beta, 1)
    v, v_old = rhs / first, np.zeros_like(rhs)
    w, w_old, t = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    c, s, c_old, s_old = (np.full(rhs.shape[1], x) for x in (1.0, 0.0, 1.0, 0.0))
    eta, b = beta.copy(), np.zeros(rhs.shape[1])
    alive = beta > 0
    for _ in range(steps):
        z = product(v)
        a = (v * z).sum(axis=0)
        z = z - a * v - b * v_old
        b_new = np.linalg.norm(z, axis=0)
        d = c * a - c_old * s * b
        r1 = np.hypot(d, b_new)
        r2, r3 = s * a + c_old * c * b, s_old * b
        alive = alive & (r1 > EPS)
        r1 = np.where(alive, r1, 1)
        c_old, s_old, c, s = c, s, d / r1, b_new / r1
        w_old, w = w, np.where(alive, (v - r3 * w_old - r2 * w) / r1, 0)
        t = t + np.where(alive, c * eta, 0) * w
        eta = -s * eta
        alive = alive & (b_new > EPS * np.abs(a)) & (np.abs(eta) > tolerance * beta)
        v_old, v, b = v, np.where(alive, z / np.where(b_new > 0, b_new, 1), 0), b_new
        if not alive.any():
            break
    return t


def orthonormal(t: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Columns of ``t`` made orthonormal to each other and to ``against`` (orthonormal); dependent ones go."""
    out = []
    for col in t.T:
        length = np.linalg.norm(col)
        for _ in range(3):
            for q in (*against, *([np.array(out).T] if out else [])):
                col = col - q @ (q.T @ col)
            now = np.linalg.norm(col)
            if not now > 1e-10 * length:
                break
            col, length = col / now, 1.0
        else:
            out.append(col)
    return np.array(out).T.reshape(t.shape[0], len(out))


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, seed: int = 12, max_basis: int = MAX_BASIS,
                    inner_steps: int = INNER_STEPS, inner_tolerance: float = INNER_TOLERANCE) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues of a symmetric ``product``, their unit eigenvectors, largest relative residual."""
    wanted = min(wanted, dim)
    rng = np.random.default_rng(seed)
    locked = np.zeros((dim, 0))
    basis = orthonormal(rng.normal(size=(dim, min(dim, 2 * wanted))))
    image = product(basis)
    best, stalled = np.inf, 0
    for _ in range(OUTER_STEPS):
        values, s = np.linalg.eigh((h := basis.T @ image) / 2 + h.T / 2)
        s = s[:, ::-1]
        basis, image, values = basis @ s, image @ s, values[::-1]
        open_ = min(wanted - locked.shape[1], basis.shape[1])
        u, theta = basis[:, :open_], values[:open_]
        r = image[:, :open_] - u * theta
        r = r - locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        scale = max(abs(values[0]), np.finfo(float).tiny) if not locked.shape[1] else scale     # noqa: F821 - set before anything is locked
        goal = 32 * EPS * np.sqrt(dim) * scale
        stalled = 0 if size[0] < best / 2 else stalled + 1
        best = min(best, size[0])
        if stalled >= 4 and best <= 1e-11 * scale:      # rounding of the passes themselves
            goal = max(goal, 2 * best)
        full = locked.shape[1] + basis.shape[1] >= dim
        done = 0
        while done < open_ and (size[done] <= goal or full):
            done += 1
        if done:
            locked = np.column_stack([locked, orthonormal(u[:, :done], locked)])
            basis, image, u, theta, r = basis[:, done:], image[:, done:], u[:, done:], theta[done:], r[:, done:]
            best, stalled = np.inf, 0
            if locked.shape[1] >= wanted:
                break
        if basis.shape[1] + u.shape[1] > max_basis:
            basis, image = basis[:, :2 * wanted], image[:, :2 * wanted]
        q = np.column_stack([locked, u])

        def corrected(y, q=q, theta=theta):
            z = product(y) - theta * y
            return z - q @ (q.T @ z)

        t = minres(corrected, -(r - q @ (q.T @ r)), inner_steps, inner_tolerance) if u.shape[1] else np.zeros((dim, 0))
        t = orthonormal(t, locked, basis)
        if not t.shape[1]:
            t = orthonormal(rng.normal(size=(dim, 1)), locked, basis)
        basis, image = np.column_stack([basis, t]), np.column_stack([image, product(t)])
        image = image - locked @ (locked.T @ image)
    u = orthonormal(np.column_stack([locked, basis[:, :wanted - locked.shape[1]]]))
    image = product(u)
    values, s = np.linalg.eigh((h := u.T @ image) / 2 + h.T / 2)
    values, u, image = values[::-1], u @ s[:, ::-1], image @ s[:, ::-1]
    return values, u, float(np.linalg.norm(image - u * values, axis=0).max(initial=0) / max(abs(values[0]), np.finfo(float).tiny))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Model of quantised rows; None if no row has an entry."""
    dim = rows.agg(F.max(F.size("x"))).first()[0]
    if not dim:
        return None
    held = written(blocks(rows, dim), "whiten-fit")
    n, *sums = (int(v) for v in block_sum(held, dim, exact_sums, np.array([0] * (dim + 1), object)))
    mean = np.array([s / n for s in sums])
    passes = 0

    def product(y: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x):
            c = x - mean
            return c.T @ (c @ y)
        return block_sum(held, dim, part, np.zeros((dim, y.shape[1]))) / n

    trace = float(block_sum(held, dim, lambda x: np.square(x - mean).sum(axis=0), np.zeros(dim)).sum()) / n
    values, vectors, residual = jacobi_davidson(product, dim, components)
    some = values > max(trace, 0) * EPS * dim
    values, vectors = values[some], vectors[:, some]
    turn = vectors / np.sqrt(values)
    k = len(values)
    centre = block_sum(held, dim, lambda x: ((x - mean) @ turn).sum(axis=0), np.zeros(k)) / n

    def covariance(x):
        z = (x - mean) @ turn - centre
        return z.T @ z
    error = np.abs(block_sum(held, dim, covariance, np.zeros((k, k))) / n - np.eye(k)).max(initial=0)
    return Whitening(n, sums, vectors, values, trace, float(error), residual, passes)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """sum over dimensions of (n x - S)^2, exact, at the limit beyond 64 bits."""
    if not len(x):
        return np.zeros(0, np.int64)
    reach = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if x.shape[1] * reach * reach < 1 << 62:
        return np.square(n * x - np.array(sums, np.int64)).sum(axis=1)
    exact = np.square(n * x.astype(object) - np.array(sums, object)).sum(axis=1)
    return np.array([min(int(v), (1 << 63) - 1) for v in exact], np.int64)


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """Each quantised row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    dim, k = model.vectors.shape
    turn, mean, share = model.vectors / np.sqrt(model.values), model.mean, model.values / model.trace if k else np.zeros(0)

    def run(batches):
        for b in batches:
            x = matrix(b.column(1), dim)
            m = len(x) * k
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(m, model.n)), pa.array(np.repeat(deviations(x, model.n, model.sums), k)), pa.array(((x - mean) @ turn).ravel()),
                pa.array(np.tile(share, len(x))), pa.array(np.full(m, model.identity_error))], names=_OUT)

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", _padded(dim).alias("x")).mapInArrow(run, _SCHEMA.format(kind))


_OUT = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
_SCHEMA = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """Fit on the distinct vectors of a table and whiten all its rows."""
    rows = written(quantised(vectors, scale), "whiten-rows")
    model = fit(rows, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], _SCHEMA.format(rows.schema["vec_id"].dataType.simpleString()))
    return whitened(rows, model)
