"""Removal of byte strings that occur earlier, across all documents.

Suffixes are not sorted from every byte. Every stretch of ``size`` bytes has one
anchor, the least hash among the half-length strings in it, so equal stretches
have equal anchors; only suffixes at anchors (one in about 26 bytes) go
through Spark's external sort, where equal ones meet. Stretches around one
anchor form a context. Of equal contexts, all but the first repeat as a whole.
Where one anchor has several contexts, the first of each is split into its
stretches, and these are sorted the same way.

Null texts are empty. Texts under ``size`` bytes have no stretch and lose nothing.
Texts over two million bytes go through in overlapping windows.
Ids are unique; rows that share an id share their marks. Extra columns are
left aside. Hashes of 128 bits stand for the strings.
"""

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinflow.llm.common import Scratch, mixed, text_of

SIZE = 100
CHUNK = 1 << 21
ROWS = "kind byte, k1 long, k2 long, k3 long, doc_id long, start int, n short"
# rows that wait for their like, decided marks, and contexts to be split
OPEN, MARK, SPLIT = 0, 1, 2

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64)
_BASE = (_rng.integers(1, 1 << 62, size=2, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


class Hashes:
    """Hashes of any byte range of a text, two of 64 bits each."""

    def __init__(self, data: np.ndarray):
        self.sums, self.back = [], []
        for table, base in zip(_BYTE, _BASE, strict=True):
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            powers = self._powers(base, len(data) + 1)
            total = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(table[data] * powers[:-1], out=total[1:])
            self.sums.append(total)
            self.back.append(self._powers(inverse, len(data) + 1))

    @staticmethod
    def _powers(base: np.uint64, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        total = self.sums[which]
        h = (total[end] - total[start]) * self.back[which][start]
        return mixed(h, (end - start).astype(np.uint64))


def anchors(h: Hashes, offsets: np.ndarray, size: int):
    """Runs of stretches with one anchor: (text, anchor, first start, last start)."""
    half = size // 2
    span = size - half + 1  # strings of half length in a stretch
    n = int(offsets[-1])
    if n < size:
        return [np.zeros(0, dtype=np.int64)] * 4
    at = np.arange(n - half + 1)
    v = h.of(at, at + half, 0)
    best, width = at, 1
    while width < span:
        d = min(width, span - width)
        left, right = best[:-d], best[d:]
        best = np.where(v[right] < v[left], right, left)
        width += d
    starts = np.arange(n - size + 1)
    text = np.searchsorted(offsets, starts, side="right") - 1
    inside = starts + size <= offsets[text + 1]
    starts, text, best = starts[inside], text[inside], best[: n - size + 1][inside]
    if not len(starts):
        return [np.zeros(0, dtype=np.int64)] * 4
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (best[1:] != best[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return text[first], best[first], starts[first], starts[last]


def chunks(texts, size: int, chunk: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts (an Arrow column), some two million bytes at a time: ``row, data, offsets, shift, begin, end``.

    A longer text comes in windows. A window's own part is from byte ``begin`` to ``end`` of its text; it starts at byte
    ``shift``, so early that a run of stretches which begins in the own part is known from its first one, and reaches
    behind the own part as far as the last run can.
    """
    import pyarrow as pa

    before = size - size // 2 + 1  # stretches that one run can have
    places, parts, held = [], [], 0

    def out():
        row, *rest = np.array(places).T
        return row, np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum([0, *map(len, parts)]), *rest

    for row, text in enumerate(texts.cast(pa.binary())):
        raw = text.as_py()
        for start in range(0, max(1, len(raw)), chunk):
            shift, last = max(0, start - before), start + chunk >= len(raw)
            places.append((row, shift, start, len(raw) if last else start + chunk))
            parts.append(raw[shift : start + chunk + before + size])
            held += len(parts[-1])
            if held >= chunk:
                yield out()
                places, parts, held = [], [], 0
    if parts:
        yield out()


def _frame(kind, k1, k2, k3, doc, start, n):
    import pyarrow as pa

    size = len(doc)
    kind = np.broadcast_to(np.asarray(kind, dtype=np.int8), size)
    cols = [kind, k1.astype(np.int64), k2.astype(np.int64), k3.astype(np.int64), doc.astype(np.int64), start.astype(np.int32), n.astype(np.int16)]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=["kind", "k1", "k2", "k3", "doc_id", "start", "n"])


def _first_of(keys: list[np.ndarray], doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each row is the first of its key, by document and start."""
    order = np.lexsort((start, doc, *reversed(keys)))
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    out = np.zeros(len(order), dtype=bool)
    out[order[new]] = True
    return out


def _settled(keys, doc, start, n):
    """Rows with all but the first of each key decided here already."""
    first = _first_of(keys, doc, start)
    kind = np.where(first, OPEN, MARK).astype(np.int8)
    spread = mixed(doc.astype(np.uint64), start.astype(np.uint64))  # marks go to any task
    k1 = np.where(first, keys[0], spread)
    return _frame(kind, k1, keys[1], keys[2], doc, start, n)


def contexts(size: int, chunk: int = CHUNK):
    """Per batch of ``doc_id, text``: one row per context."""

    def run(batches) -> Iterator:
        for batch in batches:
            ids = np.asarray(batch.column("doc_id"))
            for rows, data, offsets, shift, begin, end in chunks(batch.column("text"), size, chunk):
                h = Hashes(data)
                text, a, lo, hi = anchors(h, offsets, size)
                start = lo - offsets[text] + shift[text]
                own = (start >= begin[text]) & (start < end[text])
                text, a, lo, hi, start = (x[own] for x in (text, a, lo, hi, start))
                if not len(text):
                    continue
                half = size // 2
                place = (a - lo).astype(np.uint64) * np.uint64(4096) + (hi - lo).astype(np.uint64)
                k1 = mixed(h.of(a, a + half, 0), h.of(a, a + half, 1))
                k2 = mixed(h.of(lo, hi + size, 0), place)
                k3 = mixed(h.of(lo, hi + size, 1), place)
                yield _settled([k1, k2, k3], ids[rows[text]], start, hi - lo)

    return run


def stretches(size: int, chunk: int = CHUNK):
    """Per batch of ``doc_id, text, runs``: one row per stretch of the runs."""

    def run(batches) -> Iterator:
        for batch in batches:
            ids, column = np.asarray(batch.column("doc_id")), batch.column("runs")
            pairs = column.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(column.offsets)))
            starts, ns = np.asarray(pairs.field("start")), np.asarray(pairs.field("n"))
            order = np.lexsort((starts, row))
            row, starts, ns = row[order].astype(np.int64), starts[order].astype(np.int64), ns[order].astype(np.int64)
            for rows, data, offsets, shift, begin, end in chunks(batch.column("text"), size, chunk):
                h = Hashes(data)
                mine = [np.zeros((2, 0), np.int64)]  # the runs of the windows' own parts, with the window
                for k, r in enumerate(rows):
                    low, high = np.searchsorted(row, [r, r + 1])
                    low, high = low + np.searchsorted(starts[low:high], [begin[k], end[k]])
                    mine.append(np.stack([np.arange(low, high), np.full(high - low, k)]))
                run, k = np.concatenate(mine, axis=1)
                if not len(run):
                    continue
                count = ns[run] + 1
                start = np.repeat(starts[run], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                k = np.repeat(k, count)
                at = start - shift[k] + offsets[k]
                k1, k2 = h.of(at, at + size, 0), h.of(at, at + size, 1)
                yield _settled([k1, k2, np.zeros(len(k1), dtype=np.uint64)], ids[rows[k]], start, np.zeros(len(start)))

    return run


def decided(split: bool):
    """Over rows sorted by key, document and start: marks, and contexts to split.

    A batch at a time, with the last row and the anchor's first context kept.
    """

    def run(batches) -> Iterator:
        last = None  # key of the row before
        held = None  # the only context so far of the anchor before, as a row
        many = False
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, k1, k2, k3, doc, start, n = (np.asarray(batch.column(c)) for c in ("kind", "k1", "k2", "k3", "doc_id", "start", "n"))
            done = kind == MARK
            if done.any():
                yield _frame(MARK, k1[done], k2[done], k3[done], doc[done], start[done], n[done])
            k1, k2, k3, doc, start, n = (x[~done] for x in (k1, k2, k3, doc, start, n))
            if not len(k1):
                continue
            new = np.ones(len(k1), dtype=bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (k3[1:] != k3[:-1])
            if last is not None:
                new[0] = last != (k1[0], k2[0], k3[0])
            last = (k1[-1], k2[-1], k3[-1])
            if not new.all():
                r = ~new
                yield _frame(MARK, k1[r], k2[r], k3[r], doc[r], start[r], n[r])
            if not split:
                continue
            f = np.flatnonzero(new)
            a1, rows = k1[f], [x[f] for x in (k1, k2, k3, doc, start, n)]
            if not len(f):
                continue
            if held is not None:  # put the open context in front
                rows = [np.concatenate([[h], x]) for h, x in zip(held, rows, strict=True)]
                a1 = rows[0]
            beside = np.zeros(len(a1), dtype=bool)
            beside[1:] |= a1[1:] == a1[:-1]
            beside[:-1] |= a1[1:] == a1[:-1]
            sent = np.zeros(len(a1), dtype=bool)
            if held is not None:
                sent[0] = many  # has been given out before
            out = beside & ~sent
            if out.any():
                yield _frame(SPLIT, *[x[out] for x in rows])
            held, many = [x[-1] for x in rows], bool(beside[-1])

    return run


def marks(docs: DataFrame, scratch: Scratch, size: int = SIZE, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, start, n``: stretches from ``start`` to ``start + n`` occur earlier. Written; each step gives up what it shuffled."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).where("doc_id is not null")
    keys = ["k1", "k2", "k3"]
    found = rows.mapInArrow(contexts(size, chunk), ROWS).repartition("k1").sortWithinPartitions(*keys, "doc_id", "start")
    found = scratch.keep(found.mapInArrow(decided(True), ROWS).select("kind", "doc_id", "start", "n"), "repeats")
    scratch.settle()
    again = found.where(F.col("kind") == SPLIT).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    again = rows.join(again, "doc_id").mapInArrow(stretches(size, chunk), ROWS).repartition("k1").sortWithinPartitions(*keys, "doc_id", "start")
    again = scratch.keep(again.mapInArrow(decided(False), ROWS).select("doc_id", "start", "n"), "split-repeats")
    scratch.settle()
    return found.where(F.col("kind") == MARK).select("doc_id", "start", "n").union(again)


def _kept(raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs of them, and what stays of a text with these marks."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(np.minimum(end[order], len(raw)))
    new = np.append(True, start[1:] > end[:-1])
    start, end = start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
    edges = zip([0, *end.tolist()], [*start.tolist(), len(raw)])
    return int((end - start).sum()), len(start), b"".join(raw[a:b] for a, b in edges)


def without_repeats(docs: DataFrame, size: int = SIZE, chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: the bytes that stay, per row."""
    import pyarrow as pa

    per_doc = marks(docs, Scratch(docs.sparkSession), size, chunk).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(per_doc, "doc_id", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("text").cast(pa.binary()), batch.column("runs")):
                raw = text.as_py()
                if not runs.is_valid:
                    out.append((len(raw), 0, 0, raw))
                    continue
                start = np.asarray(runs.values.field("start"), dtype=np.int64)
                out.append((len(raw), *_kept(raw, start, start + np.asarray(runs.values.field("n")) + size)))
            cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(list(c), type=k) for c, k in zip(cols, kinds, strict=True)]], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
