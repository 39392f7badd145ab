"""Value counts and moments of many columns from one pass over Arrow batches.

Each task counts the values of every column, per part of the rows (a fold, or all rows as one part), and sends on one row
per value instead of one per cell. Text is counted in full. A number with more than ``LIMIT`` distinct values is *wide*:
only its count, sum and sum of squares are kept. Numbers are told apart by their bits, so -0.0 and 0.0 are two values
here, as they are two labels once cast to text.
"""
from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = 4096
HELD = 100_000          # values of a column that a task holds before it sends them on
CHUNK_ROWS = 131_072    # rows worked on together


def chunks(batches: Iterable[pa.RecordBatch], rows: int = CHUNK_ROWS) -> Iterator[pa.Table]:
    """The batches' rows in tables of about ``rows`` rows."""
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def whole(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(table[name].chunks)


@dataclass
class Numbers:
    """One numeric column: its values in ascending order and their counts (values x parts), None if it is wide."""
    values: np.ndarray | None
    counts: np.ndarray | None
    missing: np.ndarray         # by part
    total: float                # over all parts
    square: float

    def distinct(self) -> int | None:
        """Distinct values as SQL counts them (0.0 and -0.0 are one); None if there are more than LIMIT."""
        if self.values is None:
            return None
        return len(np.unique(self.values[~np.isnan(self.values)])) + int(np.isnan(self.values).any())

    def median(self, parts: np.ndarray | None = None) -> float | None:
        """Exact median of the values that are numbers, over the parts of a mask; None without any."""
        n = self.counts[:, parts].sum(axis=1) if parts is not None else self.counts.sum(axis=1)
        keep = (n > 0) & ~np.isnan(self.values)
        ends = np.cumsum(n[keep])
        if not len(ends):
            return None
        pos = 0.5 * (int(ends[-1]) - 1)
        lo, hi = (float(self.values[keep][np.searchsorted(ends, rank + 1, "left")]) for rank in (math.floor(pos), math.ceil(pos)))
        return lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos))


@dataclass
class Profile:
    rows: np.ndarray                                        # by part
    text: dict[str, dict[str | None, np.ndarray]]           # label (None: missing) -> rows by part
    numbers: dict[str, Numbers]

    @property
    def n(self) -> int:
        return int(self.rows.sum())

    def mode(self, c: str) -> str | None:
        """Most frequent label, the smallest of several."""
        seen = {v: int(k.sum()) for v, k in self.text[c].items() if v is not None}
        return min(seen, key=lambda v: (-seen[v], v.encode("utf-8", "surrogatepass"))) if seen else None


def _counting(text: int, names: list[str], parts: int, limit: int):
    schema = pa.schema([("c", pa.int32()), ("w", pa.bool_()), ("l", pa.string()), ("v", pa.int64()), ("part", pa.int32()), ("n", pa.int64()),
                        ("s", pa.float64()), ("q", pa.float64())])

    def sent(c: int, held: dict) -> pa.RecordBatch:
        values = list(held)
        counts = np.array([held[v] for v in values]).reshape(len(values), parts)
        at, part = np.nonzero(counts)
        size = len(at)
        own = pa.array(values, pa.string() if c < text else pa.int64()).take(pa.array(at))
        labels, bits = (own, pa.nulls(size, pa.int64())) if c < text else (pa.nulls(size, pa.string()), own)
        zero = pa.array(np.zeros(size))
        return pa.record_batch([pa.array(np.full(size, c, np.int32)), pa.array(np.zeros(size, bool)), labels, bits, pa.array(part.astype(np.int32)),
                                pa.array(counts[at, part].astype(np.int64)), zero, zero], schema=schema)

    def run(batches):
        held: list[dict] = [{} for _ in names]
        wide: dict[int, list] = {}
        rows = np.zeros(parts, np.int64)
        for table in chunks(batches):
            part = whole(table, "part").to_numpy().astype(np.int64)
            rows += np.bincount(part, minlength=parts)
            for c, name in enumerate(names):
                col = whole(table, name)
                own = held[c]
                if c in wide:
                    gone = col.is_null().to_numpy(zero_copy_only=False)
                    if gone.any():
                        own[None] = own.get(None, 0) + np.bincount(part[gone], minlength=parts)
                    col, encoded = col.drop_null(), None
                else:
                    encoded = (col if c < text else col.view(pa.int64())).dictionary_encode()
                    found = encoded.dictionary.to_pylist()
                    codes = encoded.indices.fill_null(len(found)).to_numpy().astype(np.int64)
                    counts = np.bincount(codes * parts + part, minlength=(len(found) + 1) * parts).reshape(-1, parts)
                    for v, k in zip([*found, None], counts):
                        if v in own:
                            own[v] = own[v] + k
                        elif v is not None or k.any():
                            own[v] = k
                    if c < text:
                        if len(own) > HELD:
                            yield sent(c, own)
                            own.clear()
                        continue
                    if len(own) <= limit + 1:
                        continue
                    # too many: what has been counted turns into moments
                    wide[c] = [0, 0.0, 0.0]
                    gone = own.get(None)
                    x = np.array([v for v in own if v is not None], np.int64).view(np.float64)
                    k = np.array([k.sum() for v, k in own.items() if v is not None], float)
                    wide[c] = [int(k.sum()), float((x * k).sum()), float((x * x * k).sum())]
                    own.clear()
                    if gone is not None:
                        own[None] = gone
                    continue
                x = col.to_numpy(zero_copy_only=False)
                wide[c][0] += len(x)
                wide[c][1] += float(x.sum())
                wide[c][2] += float((x * x).sum())
        for c, own in enumerate(held):
            if own:
                yield sent(c, own)
        out = [(c, True, None, None, 0, n, s, q) for c, (n, s, q) in wide.items()]
        out += [(-1, False, None, None, p, int(n), 0.0, 0.0) for p, n in enumerate(rows) if n]
        if out:
            yield pa.record_batch([pa.array(list(v), f.type) for v, f in zip(zip(*out), schema)], schema=schema)

    return run


def profile(df: DataFrame, text: list[str], nums: list[str], part: Column | None = None, parts: int = 1, limit: int = LIMIT) -> Profile:
    """Counts of the columns ``text`` and ``nums`` by ``part`` (0 .. parts - 1; without it all rows are part 0)."""
    names = [f"_{i}" for i in range(len(text) + len(nums))]
    cells = [F.col(f"`{c}`").cast("string") for c in text] + [F.col(f"`{c}`").cast("double") for c in nums]
    rows = df.select((F.lit(0) if part is None else part.cast("int")).alias("part"), *[e.alias(a) for e, a in zip(cells, names)])
    found = rows.mapInArrow(_counting(len(text), names, parts, limit), "c int, w boolean, l string, v long, part int, n long, s double, q double")
    got = found.groupBy("c", "w", "l", "v", "part").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).toArrow()
    c, w, p, n = (got[k].to_numpy() for k in ("c", "w", "part", "n"))
    rows_by = np.zeros(parts, np.int64)
    rows_by[p[c == -1]] = n[c == -1]
    texts: dict[str, dict] = {}
    numbers: dict[str, Numbers] = {}
    for i, name in enumerate(text):
        here = np.flatnonzero(c == i)
        own = texts[name] = {}
        for v, q, k in zip(got["l"].take(here).to_pylist(), p[here], n[here]):
            own.setdefault(v, np.zeros(parts, np.int64))[q] += k
    for i, name in enumerate(nums, len(text)):
        here = np.flatnonzero((c == i) & ~w)
        bits = got["v"].take(here)
        gone = bits.is_null().to_numpy()
        missing = np.bincount(p[here][gone], n[here][gone], parts).astype(np.int64)
        known = here[~gone]
        x = pc.drop_null(bits).to_numpy().astype(np.int64)
        total = square = 0.0
        over = np.flatnonzero((c == i) & w)
        for j in over:
            total += float(got["s"][int(j)].as_py())
            square += float(got["q"][int(j)].as_py())
        value = x.view(np.float64)
        total += float((value * n[known]).sum())
        square += float((value * value * n[known]).sum())
        different, at = np.unique(x, return_inverse=True)
        if len(over) or len(different) > limit:
            numbers[name] = Numbers(None, None, missing, total, square)
            continue
        counts = np.zeros((len(different), parts), np.int64)
        np.add.at(counts, (at, p[known]), n[known])
        order = np.argsort(different.view(np.float64), kind="stable")
        numbers[name] = Numbers(different.view(np.float64)[order], counts[order], missing, total, square)
    return Profile(rows_by, texts, numbers)
