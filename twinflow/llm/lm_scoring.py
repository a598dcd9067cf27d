"""Language-model scores from a log-frequency Bloom filter.

Counts of word pairs are quantised to powers of two, and a pair of level q is put into
a blocked Bloom filter q times, once per level. A lookup probes level after
level until one is missing. The filter has a fixed number of bits and is
broadcast. It holds pairs of the ``head`` most frequent words, seen twice or more, from the
most frequent down as far as they fit. All other pairs (rarer words, seen once, no room left) are looked up in
a table of exact counts; so every pair counts.

A task cuts its texts into pieces. Of each piece it sends every distinct pair once, as sorted lists of keys for the
buckets of the hashes, never a row for each occurrence. A bucket sums the lists up, and later answers the lists that are asked
with lists of counts in the same order, one part of the buckets after the other. A piece keeps for each text which of
its keys it has, so the answers need no keys.

Single words are counted exactly. The head words are broadcast
(a bounded table); the rest is asked like pairs. With (c + 0.1) / (N + 0.1 (V + 1)) as
the probability p of a word, the model is
(1 - mix) p(w) + mix min(1, c(v, w) / c(v)) for w after a v that training has,
and p(w) after any other.

Words and pairs have keys of 64 bits. Null and empty texts have one token, the end. Rows with equal id and text have
equal scores and all stay. An empty training part gives c = N = V = 0; then
scores are null, as no probability is defined. Ids may be null.
"""

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from twinflow.llm.common import Scratch, flat, mixed, pieces, text_of
from twinflow.session import fresh_dir, staged

MIX = 0.3
BLOCK_BITS = 1 << 16
PARTS = 4  # buckets are asked part by part, so that the disk holds the shuffles of one part
PIECE = 1 << 18  # tokens, of 8 bytes, worked on at once by a task, with about 20 numbers for each
BUCKET = 1 << 21  # training tokens for which there is one more bucket
LEAST_BUCKETS = 128
LONG = 256  # bytes from which a word is hashed alone

SEPARATES = np.zeros(256, dtype=bool)  # the separators of the contract
SEPARATES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keys of the words at these places: their lengths, then eight bytes after eight mixed in. ``data`` has eight bytes more."""
    size = ends - starts
    chunks = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    keys, live = size.astype(np.uint64), np.flatnonzero(size < LONG)
    for at in range(0, LONG, 8):
        if not len(live):
            break
        left = size[live] - at
        cut = np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64)
        keys[live] = mixed(keys[live], chunks[starts[live] + at] << cut)
        live = live[left > 8]
    for k in np.flatnonzero(size >= LONG):
        keys[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return keys.view(np.int64)


END = int(word_keys(np.frombuffer(b"\n".ljust(9, b"\0"), dtype=np.uint8), np.array([0]), np.array([1]))[0])  # no word holds it


def tokens_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of each text of an Arrow column without nulls, the end after them; and the texts' offsets."""
    bounds = text_offsets(column)
    raw = column.buffers()[2]
    raw = np.frombuffer(raw if raw is not None else b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    data = np.zeros(len(raw) + 8, dtype=np.uint8)
    data[:-8] = LOWER[raw]
    # a word also starts and ends where a text does
    gap = SEPARATES[raw]
    first = ~gap
    first[1:] &= gap[:-1]
    last = ~gap
    last[:-1] &= gap[1:]
    inside = bounds[(bounds > 0) & (bounds < len(raw))]
    first[inside] = ~gap[inside]
    last[inside - 1] = ~gap[inside - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    offsets = np.searchsorted(starts, bounds) + np.arange(len(bounds))
    values, word = np.full(offsets[-1], END, dtype=np.int64), np.ones(offsets[-1], dtype=bool)
    word[offsets[1:] - 1] = False
    values[word] = word_keys(data, starts, ends)
    return values, offsets


def probes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits inside of the key's block, for one level."""
    h = mixed(keys, np.full(len(keys), level, dtype=np.uint64))
    return (h & np.uint64(BLOCK_BITS - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(BLOCK_BITS - 1)).astype(np.int64)


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return (mixed(keys, np.full(len(keys), 977, dtype=np.uint64)) % np.uint64(blocks)).astype(np.int64)


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1


def levels_in(bits: np.ndarray, keys: np.ndarray, blocks: int) -> np.ndarray:
    """Highest level of each key whose lower ones are all in the filter."""
    out = np.zeros(len(keys), dtype=np.int64)
    base = block_of(keys, blocks) * BLOCK_BITS
    live = np.arange(len(keys))
    for level in range(1, 64):
        a, b = (base[live] + p for p in probes(keys[live], level))
        there = (bits[a >> 3] >> (a & 7) & 1).astype(bool) & (bits[b >> 3] >> (b & 7) & 1).astype(bool)
        live = live[there]
        if not len(live):
            break
        out[live] = level
    return out


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, and how often each is there, or the sums of their weights."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    if weights is None:
        return keys[starts], np.diff(np.append(starts, len(keys)))
    return keys[starts], np.add.reduceat(weights, starts) if len(starts) else weights


def bucketed(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that sorted keys are in, and where each begins; a bucket has a range of the keys."""
    of = ((keys >> np.int64(32)) + np.int64(1 << 31)) * np.int64(buckets) >> np.int64(32)
    starts = np.flatnonzero(np.append(True, of[1:] != of[:-1])[: len(of)])
    return of[starts].astype(np.int32), np.append(starts, len(of)).astype(np.int32)


def lists(offsets: np.ndarray, values: np.ndarray):
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def sums_by(rows: np.ndarray, size: int, values: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=size)


def lists_written(df: DataFrame) -> DataFrameWriter:
    """A writer for rows with long lists: few of them are gathered, or read, at once."""
    small = {"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
    return df.write.options(**small, compression="zstd")


def train(docs: DataFrame, learn: Column, head: int = 1 << 16, bits: int = 1 << 27) -> dict:
    """The model; ``counts`` and ``rest`` are the exact tables of words and pairs, all else is bounded."""
    import pyarrow as pa

    spark = docs.sparkSession
    texts = docs.where(learn).select(text_of().alias("text"))
    most = 4 * PIECE

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches, most):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in counted(tokens_of(batch.column("text"))[0])], names=["h", "c"])

    counts = staged(texts.mapInArrow(words, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "word-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.orderBy(F.desc("c"), "h").limit(head).toPandas().sort_values("h")
    known, known_c = top["h"].to_numpy(dtype=np.int64), top["c"].to_numpy(dtype=np.int64)
    buckets = max(LEAST_BUCKETS, n // BUCKET)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches, most):
            values, offsets = tokens_of(batch.column("text"))
            before, here, _, former = neighbours(values, offsets, known)
            both, keys = (before >= 0) & (here >= 0), mixed(former, values).view(np.int64)
            for inner in (False, True):
                key, c = counted(keys[both == inner])
                bucket, starts = bucketed(key, buckets)
                columns = [pa.array(bucket), pa.array([inner] * len(bucket), pa.bool_()), lists(starts, key), lists(starts, c.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "inner", "key", "c"])

    def tallied(sent: pa.Table) -> pa.Table:
        key, c = counted(*(flat(sent.column(x).combine_chunks())[0] for x in ("key", "c")))
        ladder = np.bincount(level_of(c[c > 1]), minlength=64)
        made = {"key": lists([0, len(key)], key), "c": lists([0, len(c)], c), "ladder": lists([0, len(ladder)], ladder)}
        return pa.table({x: sent.column(x).slice(0, 1) for x in ("bucket", "inner")} | made)

    seen = texts.mapInArrow(pairs, "bucket int, inner boolean, key array<long>, c array<int>")
    seen = seen.groupBy("bucket", "inner").applyInArrow(tallied, "bucket int, inner boolean, key array<long>, c array<long>, ladder array<long>")
    folder = fresh_dir(spark, "pair-counts")
    lists_written(seen).parquet(folder)
    seen = spark.read.schema(seen.schema).parquet(folder)
    Scratch(spark).settle()
    inner = seen.where("inner")
    ladder = inner.select(F.posexplode("ladder").alias("q", "n")).groupBy("q").agg(F.sum("n").alias("n")).where("n > 0")
    ladder = {r["q"]: r["n"] for r in ladder.collect()}
    # two bits an entry; the filter stays under a third full
    cutoff, room = 64, bits // 6
    for q in sorted(ladder, reverse=True):
        room -= ladder[q] * q
        if room < 0:
            break
        cutoff = q
    blocks = bits // BLOCK_BITS

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, c = flat(batch.column("key"))[0], flat(batch.column("c"))[0]
            q = level_of(c)
            held = (c > 1) & (q >= cutoff)
            keys, q = keys[held], q[held]
            block = block_of(keys, blocks)
            order = np.argsort(block, kind="stable")
            block, starts = np.unique(block[order], return_index=True)
            starts = np.append(starts, len(order))
            yield pa.RecordBatch.from_arrays([pa.array(block), lists(starts, keys[order]), lists(starts, q[order])], names=["block", "key", "q"])

    def built(sent: pa.Table) -> pa.Table:
        keys, q = (flat(sent.column(x).combine_chunks())[0] for x in ("key", "q"))
        part = np.zeros(BLOCK_BITS, dtype=np.uint8)
        for lv in range(1, int(q.max()) + 1):
            for at in probes(keys[q >= lv], lv):
                part[at] = 1
        return pa.table({"block": sent.column("block").slice(0, 1), "bytes": [np.packbits(part, bitorder="little").tobytes()]})

    entries = inner.select("key", "c").mapInArrow(dealt, "block long, key array<long>, q array<long>")
    filled = entries.groupBy("block").applyInArrow(built, "block long, bytes binary")
    store = np.zeros(bits // 8, dtype=np.uint8)
    for row in filled.toLocalIterator():
        at = row["block"] * BLOCK_BITS // 8
        store[at : at + BLOCK_BITS // 8] = np.frombuffer(row["bytes"], dtype=np.uint8)
    shared = spark.sparkContext.broadcast((known, known_c, store))
    # with the whole filter, a pair of head words in a training text is either found or was seen once
    return {
        "counts": counts, "n": int(n), "v": int(v), "blocks": blocks, "cutoff": cutoff, "whole": room >= 0, "shared": shared,
        "rest": seen.select("bucket", "key", "c"), "buckets": buckets,
    }


def text_offsets(column) -> np.ndarray:
    """Offsets of the bytes of an Arrow text column."""
    import pyarrow as pa

    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def text_pieces(batches: Iterator, most: int) -> Iterator:
    """Arrow batches cut between texts, for about so many tokens in one."""
    return pieces(batches, "text", 8 * most, text_offsets)


def former_of(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The token before each; a text starts as if after an end."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[offsets[:-1]] = values[offsets[1:] - 1]
    return out


def neighbours(values: np.ndarray, offsets: np.ndarray, known: np.ndarray):
    """Places of the former and of this token among the known ones, -1 where rare; the text of each token; the former token."""
    if len(known):
        at = np.minimum(np.searchsorted(known, values), len(known) - 1)
        here = np.where(known[at] == values, at, -1)
    else:
        here = np.full(len(values), -1)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return former_of(here, offsets), here, rows, former_of(values, offsets)


def answered(batches: Iterator) -> Iterator:
    """Counts of the keys asked of a bucket, in the order asked. Rows come by bucket, those of its table (without a piece) first."""
    import pyarrow as pa

    at, table, ready, names = None, [], False, ["piece", "bucket", "word", "n_met", "c"]
    for batch in batches:
        bucket, word = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("bucket", "word"))
        bounds = np.flatnonzero((bucket[1:] != bucket[:-1]) | (word[1:] != word[:-1])) + 1
        for start, end in zip([0, *bounds], [*bounds, batch.num_rows], strict=True):
            if end == start:
                continue
            if at != (at := (bucket[start], word[start])):
                table, ready = [], False
            rows = batch.slice(start, end - start)
            own = rows.column("piece").null_count
            if own:
                table.append(tuple(flat(rows.column(x).slice(0, own))[0] for x in ("key", "c")))
            rows = rows.slice(own)
            if not rows.num_rows:
                continue
            if not ready:  # a key is in one of the lists only
                keys, counts = counted(*(np.concatenate([x[i] for x in table] or [np.zeros(0, dtype=np.int64)]) for i in (0, 1)))
                table, ready = [], True
            asked, offsets = flat(rows.column("key"))
            if len(keys):
                place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
                c = np.where(keys[place] == asked, counts[place], 0)
            else:
                c = np.zeros(len(asked), dtype=np.int64)
            met = np.diff(np.append(0, np.cumsum(c > 0))[offsets]) if at[1] else np.zeros(rows.num_rows, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*(rows.column(x) for x in names[:3]), pa.array(met), lists(offsets, c)], names=names)


def score(docs: DataFrame, model: dict, learned: Column | None = None) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score``: one row per input row.

    ``learned`` tells which rows the model was trained on; it spares them lookups and changes no score.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    n, v, blocks, cutoff, whole, shared = (model[k] for k in ("n", "v", "blocks", "cutoff", "whole", "shared"))
    buckets, total, parts = model["buckets"], n + 0.1 * (v + 1), PARTS
    kind = docs.schema["doc_id"].dataType.simpleString()
    known_text = F.coalesce(learned, F.lit(False)) if learned is not None else F.lit(False)
    rows = docs.select("doc_id", known_text.alias("learned"), text_of().alias("text"))
    # of a piece: a row with its texts, in part -1, and rows with the keys that it asks of each bucket
    schema = (
        f"part int, piece long, doc_id array<{kind}>, n_tokens array<int>, n_head array<int>, head_base array<double>, "
        "head_gain array<double>, n_rare array<int>, rare array<int>, n_open array<int>, open array<int>, v array<int>, w array<int>, "
        "bucket int, word boolean, key array<long>"
    )

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, known_c, store = shared.value
        piece = TaskContext.get().partitionId() << 33
        types = {"part": pa.int32(), "piece": pa.int64(), "bucket": pa.int32(), "word": pa.bool_(), "key": pa.list_(pa.int64())}
        types |= dict.fromkeys(("n_tokens", "n_head", "n_rare", "rare", "n_open", "open", "v", "w"), pa.list_(pa.int32()))
        types |= dict.fromkeys(("head_base", "head_gain"), pa.list_(pa.float64()))

        def made(size: int, columns: dict) -> pa.RecordBatch:
            filled = [columns[x] if x in columns else pa.nulls(size, types[x]) for x in names]
            return pa.RecordBatch.from_arrays(filled, names=names)

        for batch in text_pieces(batches, PIECE):
            values, offsets = tokens_of(batch.column("text"))
            before, here, at, former = neighbours(values, offsets, known)
            keys, size, piece = mixed(former, values), batch.num_rows, piece + 1
            is_head = here >= 0
            p = (known_c[here] + 0.1) / total if len(known_c) else np.ones(len(here))
            base, gain = np.where(is_head, np.log10(p), 0.0), np.zeros(len(here))
            open_ = np.ones(len(here), dtype=bool)
            both = np.flatnonzero(is_head & (before >= 0))
            if len(both):
                some, back = np.unique(keys[both], return_inverse=True)
                level = levels_in(store, some, blocks)[back]
                c = np.where(level >= cutoff, 1.5 * 2.0 ** (level - 1), 0.0)
                if whole:
                    own = batch.column("learned").to_numpy(zero_copy_only=False)[at[both]]
                    c = np.where((c == 0) & own, 1.0, c)
                gain[both] = np.log10(1 + MIX * np.minimum(1.0, c / known_c[before[both]]) / ((1 - MIX) * p[both]))
                open_[both] = c == 0
            rare, loose = np.flatnonzero(~is_head), np.flatnonzero(open_)
            rare_key, rare_at = np.unique(values[rare], return_inverse=True)
            pair_key, first, pair_at = np.unique(keys.view(np.int64)[loose], return_index=True, return_inverse=True)
            one = loose[first]
            # places of head words, or of this piece's rare words counted from the end
            v_at, w_at = (
                np.where(x[one] >= 0, x[one], -1 - np.searchsorted(rare_key, key[one])) for x, key in ((before, former), (here, values))
            )
            types["doc_id"] = pa.list_(batch.column("doc_id").type)
            whole_row = {
                "n_tokens": np.diff(offsets), "n_head": sums_by(at, size, is_head), "n_rare": sums_by(at[rare], size), "rare": rare_at,
                "n_open": sums_by(at[loose], size), "open": pair_at, "v": v_at, "w": w_at,
            }
            whole_row = {x: y.astype(np.int32) for x, y in whole_row.items()}
            whole_row |= {"head_base": sums_by(at, size, base), "head_gain": sums_by(at, size, gain)}
            own = {x: lists([0, len(y)], y) for x, y in (whole_row | {"doc_id": batch.column("doc_id")}).items()}
            yield made(1, own | {"part": pa.array([-1], pa.int32()), "piece": pa.array([piece])})
            for word, key in ((True, rare_key), (False, pair_key)):
                bucket, starts = bucketed(key, buckets)
                asked = {"part": bucket % np.int32(parts), "piece": np.full(len(bucket), piece), "bucket": bucket, "word": np.full(len(bucket), word)}
                yield made(len(bucket), {x: pa.array(y) for x, y in asked.items()} | {"key": lists(starts, key)})

    def finished(text: pa.Table, answers: pa.Table) -> pa.Table:
        known_c = shared.value[1]
        of = {x: text.column(x).combine_chunks().flatten().to_numpy() for x in text.column_names if x not in ("piece", "doc_id")}
        size = len(of["n_tokens"])
        # lists in the order of their buckets are in the order of the keys
        answers = answers.take(pa.array(np.argsort(answers.column("bucket").to_numpy(), kind="stable")))
        word = answers.column("word").combine_chunks()
        c_word, c_pair = (flat(answers.filter(x).column("c").combine_chunks())[0] for x in (word, pc.invert(word)))
        at = np.repeat(np.arange(size), of["n_rare"])
        base = of["head_base"] + sums_by(at, size, np.log10((c_word + 0.1) / total)[of["rare"]])
        n_known = of["n_head"] + sums_by(at, size, (c_word > 0)[of["rare"]]).astype(np.int64)
        c = np.append(known_c, c_word[::-1])
        c_v, c_w = c[of["v"]], c[of["w"]]
        gain = np.log10(1 + MIX * np.minimum(1.0, c_pair / np.maximum(c_v, 1)) / ((1 - MIX) * ((c_w + 0.1) / total)))
        gain = sums_by(np.repeat(np.arange(size), of["n_open"]), size, gain[of["open"]])
        # each known token, the end too, has one token after it
        full = base + n_known * math.log10(1 - MIX) + of["head_gain"] + gain
        columns = [text.column("doc_id").combine_chunks().flatten(), of["n_tokens"].astype(np.int64), n_known, base, full]
        return pa.table(columns, names=["doc_id", "n_tokens", "n_known", "base", "full"])

    names = [x.split(" ")[0] for x in schema.split(", ")]
    folder, scratch, found = fresh_dir(docs.sparkSession, "texts"), Scratch(docs.sparkSession), []
    lists_written(rows.mapInArrow(heads, schema)).partitionBy("part").parquet(folder)
    kept = docs.sparkSession.read.schema(schema).parquet(folder)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, c = counted(*(batch.column(x).to_numpy() for x in ("h", "c")))
            bucket, starts = bucketed(key, buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), lists(starts, key), lists(starts, c)], names=["bucket", "key", "c"])

    tables = {True: model["counts"].mapInArrow(listed, "bucket int, key array<long>, c array<long>"), False: model["rest"]}
    for part in range(parts):
        sent = kept.where(F.col("part") == part).select("bucket", "word", "piece", "key", F.lit(None).cast("array<long>").alias("c"))
        for word, table in tables.items():
            table = table.where(F.col("bucket") % parts == part)
            sent = sent.unionByName(table.withColumn("word", F.lit(word)).withColumn("piece", F.lit(None).cast("long")))
        sent = sent.repartition("bucket", "word").sortWithinPartitions("bucket", "word", F.col("piece").asc_nulls_first())
        found.append(scratch.keep(sent.mapInArrow(answered, "piece long, bucket int, word boolean, n_met long, c array<long>"), "looked-up"))
        del sent, table
        scratch.drop(f"{folder}/part={part}")
        scratch.settle()
    answers = reduce(DataFrame.unionByName, found)
    texts = docs.sparkSession.read.schema(schema).parquet(folder).where("part = -1").drop("part", "bucket", "word", "key")
    out = texts.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(
        finished, f"doc_id {kind}, n_tokens long, n_known long, base double, full double",
    )
    defined = F.lit(n > 0)
    return out.select(
        "doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        F.when(defined, F.col("base")).alias("base_score"), F.when(defined, F.col("full")).alias("score"),
    )
