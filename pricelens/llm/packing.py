"""Packing documents into training sequences: first-fit decreasing in randomised groups.

A document is the ids of its whole text plus an end id. Every full run of
``CAPACITY`` ids is a sequence of its own as soon as it is read; what is left of
a document (fewer than ``CAPACITY`` ids) is an item. Items are packed in
independent groups of ``GROUP`` documents: longest first, each into the first
bin with room for it. The first such bin is found in a tournament tree of bin
capacities (each inner node holds the larger of its two children), so an item
costs log2(GROUP) steps.

Documents may be cut anywhere. After first-fit the emptiest bins of a group are
taken apart and their items cut to fill gaps of at least ``MIN_PIECE`` ids in
the fuller ones, so that one bin of a group can be left with a large gap; that
one is dealt into lengths that are powers of two, which need no padding.

Groups are random: a rebalancing shuffle (round robin in the order of row hashes)
deals the rows, whatever their ids and texts, so copies and repeated rows spread
evenly; inside a task rows come in order of a seeded hash and every ``GROUP`` of
them are a group. Nothing is collected: a task holds the left-over ids of one
group (below 4 * CAPACITY * GROUP bytes) and one batch of texts.

Byte-level BPE always cuts a text before a space that follows a non-space, and
between a letter and a punctuation mark; so the ids of such runs are looked up in a
bounded table and only new runs are encoded. Any other tokenizer gets whole texts.

Defined cases: a null text counts as empty and gives the end id alone; repeated
rows are packed once each; a very long text is cut into full sequences; an empty
table gives an empty result; extra columns take no part. Strings of special
tokens in a text are ordinary text.
"""
from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 1024
GROUP = 4096
MIN_PIECE = 16
END_ID = 0
TEXT_BYTES = 2 << 20    # texts encoded together (at least one)
TABLE = 1 << 20         # runs kept with their ids in a worker; beyond it the table starts anew
_U32 = np.dtype("<u4")
#: White space by any Unicode version, for RE2 and for Python.
_WHITE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_SAFE = re.compile("(?<=[^\\s\u180e])(?=[ \\n])|(?<=[A-Za-z0-9])(?=[.,;:!?])")


class Encoder:
    """Ids of texts, from the JSON of a tokenizer. Runs met before are looked up by number in one flat table."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        self.by_run = cuts_at_spaces(json.loads(spec))
        self.forget()

    def forget(self):
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, _U32)
        self.ends = np.zeros(1, np.int64)       # run i has ids[ends[i]:ends[i + 1]]

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, _U32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, runs: list[str]):
        """Add new runs to the table; each is encoded as a text of its own."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)]
        self.number.update(zip(runs, range(len(self.number), len(self.number) + len(runs))))
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(got), _U32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.fromiter(map(len, got), np.int64, len(got)))])

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        if not self.by_run:
            return self.whole(texts.to_pylist())
        parts = runs(texts)
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.number) + len(words) > TABLE:
            self.forget()
        number = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        if (new := np.flatnonzero(number < 0)).size:
            number[new] = np.arange(len(self.number), len(self.number) + len(new))
            self.learn([words[i] for i in new])
        run = number[coded.indices.to_numpy()]
        size = self.ends[run + 1] - self.ends[run]
        to = np.concatenate([[0], np.cumsum(size)])
        flat = self.ids[np.repeat(self.ends[run] - to[:-1], size) + np.arange(to[-1])]
        cut = to[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
        return [flat[i:j] for i, j in zip(cut[:-1], cut[1:])]


def cuts_at_spaces(spec: dict) -> bool:
    """Whether the tokenizer always cuts before a space that follows a non-space: byte-level BPE by its usual
    pattern, without normaliser, prefix space or added tokens that touch spaces."""
    pre = spec.get("pre_tokenizer") or {}
    plain = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word")) and " " not in t["content"] for t in spec.get("added_tokens") or [])
    return (plain and spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and spec["model"].get("type", "BPE") == "BPE" and not spec["model"].get("dropout"))


def runs(texts: pa.Array) -> pa.ListArray:
    """Each text in pieces whose ids don't depend on each other: cut before a space or line end that follows no white
    space, and between an ASCII letter or digit and a punctuation mark."""
    odd = pc.match_substring_regex(texts, f"[{_WHITE}][ \\n]|\x00")
    if pc.any(odd).as_py():
        marked = pc.if_else(odd, "", texts)
        slow = iter([_SAFE.split(t) for t in texts.filter(odd).to_pylist()])
        fast = pc.split_pattern(_marked(marked), "\x00").to_pylist()
        return pa.array([next(slow) if o else f for o, f in zip(odd.to_pylist(), fast)], pa.list_(pa.string()))
    return pc.split_pattern(_marked(texts), "\x00")


def _marked(texts: pa.Array) -> pa.Array:
    for sign in (" ", "\n"):
        texts = pc.replace_substring(texts, sign, "\x00" + sign)
    return pc.replace_substring_regex(texts, "([A-Za-z0-9])([.,;:!?])", "\\1\x00\\2")


_encoders: dict[str, Encoder] = {}


def encoder(spec: str) -> Encoder:
    """The worker's encoder of this tokenizer."""
    if spec not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[spec] = Encoder(spec)
    return _encoders[spec]


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of item numbers: items longest first, each into the first bin with room."""
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    room = [capacity] * (2 * leaves)        # room[1] is the root; an unused bin has all its capacity
    bins: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need, at = lengths[i], 1
        while at < leaves:
            at *= 2
            if room[at] < need:
                at += 1
        if at - leaves == len(bins):
            bins.append([])
        bins[at - leaves].append(i)
        room[at] -= need
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return bins


def packed(lengths: list[int], capacity: int = CAPACITY, min_piece: int = MIN_PIECE) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (item, first id, number of ids)."""
    bins = [[(i, 0, lengths[i]) for i in b] for b in first_fit_decreasing(lengths, capacity)]
    used = [sum(n for _, _, n in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: (-used[b], b))
    to, donor = 0, len(order) - 1
    while True:
        while to < donor and capacity - used[order[to]] < min_piece:
            to += 1
        if to >= donor:
            break
        a, d = order[to], order[donor]
        i, start, n = bins[d].pop()
        take = min(n, capacity - used[a])
        bins[a].append((i, start, take))
        if take < n:
            bins[d].append((i, start + take, n - take))
        used[a] += take
        used[d] -= take
        if not bins[d]:
            donor -= 1
    out = [bins[b] for b in order if bins[b]]
    if out and capacity - sum(n for _, _, n in out[donor]) >= min_piece:
        out[donor:donor + 1] = powers_of_two(out[donor])
    return out


def powers_of_two(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces of one sequence dealt into sequences whose lengths are powers of two."""
    left, total, out = list(pieces), sum(n for _, _, n in pieces), []
    for bit in reversed(range(total.bit_length())):
        want = total & (1 << bit)
        seq = []
        while want:
            i, start, n = left.pop(0)
            take = min(n, want)
            seq.append((i, start, take))
            if take < n:
                left.insert(0, (i, start + take, n - take))
            want -= take
        if seq:
            out.append(seq)
    return out


def slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``limit`` bytes of text, or of one row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        before = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, before + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


class _Rows:
    """Pieces on their way out, in batches of bounded bytes."""
    LIMIT = 4 << 20

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, *row):
        self.rows.append(row)
        self.size += 64 + len(row[3])

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows)) or [()] * len(self.schema)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, self.schema)], schema=self.schema)


def pack(docs: DataFrame, spec: str, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP,
         min_piece: int = MIN_PIECE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``spec``: the tokenizer's JSON (``tokenizer_json`` reads a file on the driver; executors need no file).
    """
    end = np.array([end_id], _U32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, base, sequences = encoder(spec), TaskContext.get().partitionId() << 40, 0
        rows, items, n_docs = None, [], 0         # items: (doc_id, first id, ids, ids of the document)

        def close():
            nonlocal sequences, n_docs
            for seq in packed([len(x[2]) // 4 for x in items], capacity, min_piece):
                offset = 0
                for i, start, n in seq:
                    doc_id, first, ids, total = items[i]
                    rows.add(doc_id, first + start, n, ids[4 * start:4 * (start + n)], total, base + sequences, offset)
                    offset += n
                sequences += 1
            items.clear()
            n_docs = 0

        for b in batches:
            rows = rows or _Rows(pa.schema([("doc_id", b.schema.field(0).type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                                            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]))
            for part in slices(b, TEXT_BYTES):
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(pc.fill_null(part.column(1), ""))):
                    ids = ids.tobytes() + end
                    total = len(ids) // 4
                    full = total - total % capacity
                    for at in range(0, full, capacity):
                        rows.add(doc_id, at, capacity, ids[4 * at:4 * (at + capacity)], total, base + sequences, 0)
                        sequences += 1
                        if rows.size > rows.LIMIT:
                            yield rows.batch()
                    if full < total:
                        items.append((doc_id, full, ids[4 * full:], total))
                    n_docs += 1
                    if n_docs == group:
                        close()
                    if rows.size > rows.LIMIT:
                        yield rows.batch()
        if rows is not None:
            close()
            yield rows.batch()

    dealt = docs.select("doc_id", "text").hint("rebalance")
    dealt = dealt.sortWithinPartitions(F.xxhash64(F.lit(13), "doc_id", "text"), "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def tokenizer_json(path: str) -> str:
    """The tokenizer file, read on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence: sequence_id, n_pieces, n_ids, ids (little-endian unsigned 32-bit, unpadded). A sequence has
    at most its capacity of ids, so its group is bounded."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    out = pieces.groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), F.sum("length").alias("n_ids"), own.alias("p"))
    return out.select("sequence_id", "n_pieces", "n_ids", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))
