"""Benchmark decontamination by spaced seeds.

A mask picks some of the positions of a window of tokens; tokens in the other
positions may differ. Windows of benchmark items and of documents are hashed
under each mask and joined. Every hit names an item and a diagonal (the shift
between both texts); around the hit, tokens are compared along the diagonal,
and the passage counts when at least ``least`` tokens (or the whole item, when
shorter) lie in a stretch with a share ``similar`` of equal ones.

Items shorter than a window are looked up whole. Their tokens are cut into two
groups more than may differ, and every choice of two groups is a mask, so
that a copy with the share ``similar`` agrees under one of them at least. Items
with fewer than ``least_item`` tokens are not looked up: one or two words
stand in any text. For longer items the windows are a seed, so passages with
many changes in few tokens can be missed.

Benchmark items go round in blocks of bounded size, each broadcast and held
against all documents, so that any number of items works in bounded memory.
Null and empty texts and items have no tokens and are never hit. Repeated
documents are hit one by one. Equal items are both reported, items without an
id under a null id.
"""

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinflow.llm.common import flat, free_name, mixed, text_of

# 1 takes part, 0 may differ; windows of 12 tokens with 7 or 8 positions each
MASKS = ("111011010011", "110100110111", "101110011101", "111111110000")
SPAN = 12
HITS = "item_id long, doc_start int, n_tokens int, n_equal int"


def tokens_of(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), lambda w: F.xxhash64(w))


def whole_masks(size: int, similar: float) -> list[str]:
    """Masks over whole items of ``size`` tokens; copies that are equal enough agree under one."""
    share = Fraction(str(similar))
    differ = size - -(-size * share.numerator // share.denominator)
    groups = np.arange(size) * min(size, differ + 2) // size
    kept = combinations(range(groups[-1] + 1), min(2, size - differ)) if differ else [range(size)]
    return ["".join("01"[g in some] for g in groups) for some in kept]


def hashed(values: np.ndarray, mask: str) -> np.ndarray:
    """Hash under the mask of the window at each token, as far as windows fit."""
    n = max(0, len(values) - len(mask) + 1)
    out = np.full(n, len(mask), dtype=np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            out = mixed(out, values[k : k + n])
    return out


class Index:
    """Windows of one block of items, sorted by hash for each mask."""

    def __init__(self, ids: list[int | None], items: list[np.ndarray], similar: float):
        self.ids, self.items = ids, items
        self.size = np.array([len(x) for x in items], dtype=np.int64)
        short = sorted({n for n in self.size.tolist() if n < SPAN})
        looks = [(mask, np.flatnonzero(self.size >= SPAN)) for mask in MASKS]
        looks += [(mask, np.flatnonzero(self.size == n)) for n in short for mask in whole_masks(n, similar)]
        self.parts = []
        for mask, mine in looks:
            h = [hashed(items[i], mask) for i in mine]
            key = np.concatenate(h) if h else np.zeros(0, dtype=np.uint64)
            item = np.repeat(mine, [len(x) for x in h])
            place = np.concatenate([np.arange(len(x)) for x in h]) if h else np.zeros(0, dtype=np.int64)
            order = np.argsort(key, kind="stable")
            sieve = np.zeros(1 << 20, dtype=bool)
            sieve[(key >> np.uint64(44)).astype(np.int64)] = True
            self.parts.append((mask, key[order], item[order], place[order], sieve))

    def hits(self, values: np.ndarray, offsets: np.ndarray):
        """Distinct (row, item, shift) of windows that agree under a mask."""
        found = []
        rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        for mask, key, item, place, sieve in self.parts:
            h = hashed(values, mask)
            at = np.flatnonzero(sieve[(h >> np.uint64(44)).astype(np.int64)])
            at = at[rows[at] == rows[at + len(mask) - 1]] if len(at) else at
            low, high = np.searchsorted(key, h[at], "left"), np.searchsorted(key, h[at], "right")
            n = high - low
            at = np.repeat(at, n)
            k = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append(np.stack([rows[at], item[k], at - offsets[rows[at]] - place[k]], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def verified(self, doc: np.ndarray, item: int, shift: int, least: int, similar: float):
        """Longest stretch along the diagonal that is equal enough, or None."""
        own = self.items[item]
        a, b = max(0, -shift), min(len(own), len(doc) - shift)
        same = own[a:b] == doc[a + shift : b + shift]
        need = min(least, len(own))
        if b - a < need:
            return None
        # in whole numbers: a stretch i .. j is equal enough when run[j] >= run[i]
        share = Fraction(str(similar))
        run = np.concatenate([[0], np.cumsum(same * share.denominator - share.numerator)])
        ahead = np.maximum.accumulate(run[::-1])[::-1]  # falls, so the farthest end is found by halving
        far = np.searchsorted(-ahead, -run, "right") - 1
        start = int(np.argmax(far - np.arange(len(run))))
        end = int(far[start])
        if end - start < need:
            return None
        return a + shift + start, end - start, int(same[start:end].sum())


def find(docs: DataFrame, benchmark: DataFrame, least: int = 20, similar: float = 0.8, items_a_block: int = 20_000, into: str = "hits", least_item: int = 3) -> DataFrame:
    """The input with an array of its hits ``item_id, doc_start, n_tokens, n_equal``.

    An input column of the name is replaced.
    """
    import pyarrow as pa
    from pyspark.sql.types import StructType

    docs = docs.drop(into)
    columns = docs.columns
    toks = free_name(docs, "toks")
    out = docs.withColumn(toks, tokens_of(text_of())).withColumn(into, F.expr(f"cast(array() as array<struct<{HITS}>>)").cast(f"array<struct<{HITS.replace(' ', ':').replace(',:', ',')}>>"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), tokens_of(text_of()).alias("toks"))
    items = items.where(F.size("toks") >= max(1, least_item))
    n_blocks = max(1, -(-items.count() // items_a_block))
    shape = StructType(out.schema.fields)
    for number in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "toks"), F.lit(n_blocks)) == number) if n_blocks > 1 else items
        # one bounded block; ids as text, as pandas has whole numbers with nulls as doubles
        mine = mine.orderBy("item_id", "toks").withColumn("item_id", F.col("item_id").cast("string")).toPandas()
        own = docs.sparkSession.sparkContext.broadcast(([None if i is None else int(i) for i in mine["item_id"]], [np.asarray(x, dtype=np.int64) for x in mine["toks"]]))

        def looked_up(batches: Iterator[pa.RecordBatch], own=own) -> Iterator[pa.RecordBatch]:
            index = Index(*own.value, similar)
            for batch in batches:
                values, offsets = flat(batch.column(toks))
                hits = batch.column(into).to_pylist()
                for row, item, shift in index.hits(values, offsets):
                    got = index.verified(values[offsets[row] : offsets[row + 1]], item, shift, least, similar)
                    if got:
                        hits[row].append({"item_id": index.ids[item], "doc_start": int(got[0]), "n_tokens": int(got[1]), "n_equal": int(got[2])})
                rest = [batch.column(c) for c in [*columns, toks]]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(hits, type=batch.schema.field(into).type)], names=[*columns, toks, into])

        out = out.mapInArrow(looked_up, shape)
    return out.drop(toks)


def contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """``doc_id, item_id, doc_start, n_tokens, n_equal``: one row per passage found."""
    found = find(docs.select("doc_id", "text"), benchmark, **how)
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")
