"""Spelling variants by a dictionary of pairs of trie nodes.

All words, and all words read backwards, are kept in two tries whose nodes have numbers.
A word cut in two is then a pair of integers, the node of its front and the node of its
back. A word that skips one letter has such a pair for each letter; a word as it is has one
for each gap. Two words with one skipping pair in common differ by that letter, and
a skipping pair that is another word's gap is a letter more in the first. Both meet in one
grouping by pairs; a group holds a word for each letter of the alphabet at most, and one more.

Numbering sorts the words and deals them out by range. In sorted order a word makes
nodes for the letters it does not share with the word before. Nodes that ranges share begin the
first word of a range; these first words get a small trie of their own, so every range knows
the numbers it shares with its neighbours.

Null and empty texts have no words. Rows without an id count like rows with an empty id. Repeated
rows count again. Long runs are words like others: memory is in proportion to their length.
An empty table gives an empty result. Other columns are left aside.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinflow.llm.common import UPPER, text_of
from twinflow.session import staged

LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST = 7  # code points of a word
A_RANGE = 1 << 21  # code points of the words of one range, on average


def lowered(run: Column) -> Column:
    """A to Z in lower case; other letters stay."""
    return F.when(F.length(run) == F.octet_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, UPPER.lower()))


def words(docs: DataFrame, least: int = LEAST, twice: int = 2, every: int = 31) -> DataFrame:
    """``word, n``: the runs of letters, one code point deleted where the checksum of id and run says so.

    Shorter runs make no words, so only runs of at least ``least`` letters are taken out.
    """
    runs = F.regexp_extract_all(text_of(), F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", lowered(F.col("run")).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    counted = rows.groupBy(word.alias("word")).agg(F.count("*").alias("n"))
    return counted.where((F.col("n") >= twice) & (F.length("word") >= least))


def _paths(words: list[str], first: int, known: dict[str, list[int]]) -> list:
    """The nodes of each of the sorted words, root left out; new ones are numbered from ``first`` on."""
    import numpy as np

    out, before, path = [], "", np.zeros(0, np.int64)
    fixed = [(w, np.asarray(p, np.int64)) for w, p in known.items()]
    for word in words:
        same = _common(before, word)
        new = np.empty(len(word), np.int64)
        new[:same] = path[:same]
        new[same:] = np.arange(first, first + len(word) - same)
        first += len(word) - same
        for other, nodes in fixed:
            k = _common(other, word)
            new[:k] = nodes[:k]
        out.append(new)
        before, path = word, new
    return out


def _common(a: str, b: str) -> int:
    """Length of the longest common front."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # fronts of ``low`` are equal, of ``high`` not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _numbered_range(key, rows, edge):
    import pyarrow as pa

    part = key[0].as_py()
    rows = rows.sort_by("key")  # by bytes, as Spark sorts
    edge = edge.to_pylist()[0]
    known = {w: p for w, p in ((edge["key"], edge["path"]), (edge["next_key"], edge["next_path"])) if w is not None}
    paths = _paths(rows["key"].to_pylist(), (part + 1) << 40, known)
    return pa.table([rows["key"], rows["id"], pa.array(paths, pa.list_(pa.int64()))], names=["key", "id", "path"])


def trie_nodes(words: DataFrame, a_range: int = A_RANGE) -> DataFrame:
    """``key, id`` (different texts, long or null) to ``key, id, path``: the numbers of the trie nodes of its letters in order.

    Without an id, words are numbered in sorted order.
    """
    size = words.agg(F.sum(F.length("key") + 1)).first()[0] or 0
    part = F.spark_partition_id().cast("long")
    dealt = words.repartitionByRange(max(1, math.ceil(size / a_range)), "key").sortWithinPartitions("key")
    dealt = dealt.select("key", F.coalesce("id", F.monotonically_increasing_id()).alias("id"), part.alias("part"))
    # written, as another run of the dealing could cut elsewhere
    dealt = staged(dealt, "word-ranges")

    def first_words(batches):
        import pyarrow as pa

        rows = sorted((r["part"], r["key"]) for b in batches for r in b.to_pylist())
        paths = [p.tolist() for p in _paths([k for _, k in rows], 1, {})]
        after = [*zip([k for _, k in rows], paths), (None, None)][1:]
        kind = pa.list_(pa.int64())
        schema = pa.schema([("part", pa.int64()), ("key", pa.string()), ("path", kind), ("next_key", pa.string()), ("next_path", kind)])
        out = [{"part": r[0], "key": r[1], "path": p, "next_key": a[0], "next_path": a[1]} for r, p, a in zip(rows, paths, after)]
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    # a row per range
    edges = dealt.groupBy("part").agg(F.min("key").alias("key")).repartition(1)
    edges = edges.mapInArrow(first_words, "part long, key string, path array<long>, next_key string, next_path array<long>")
    return dealt.groupBy("part").cogroup(edges.groupBy("part")).applyInArrow(_numbered_range, "key string, id long, path array<long>")


def _pairs(batches):
    """Rows (front, back, id, n, kind) of each word: kind 0 for a gap, 1 for a letter skipped, 2 for
    a letter skipped that equals the one before, which spells the same as skipping that one."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        rows = [batch[c] for c in ("word", "id", "n", "front", "back")]
        for at in range(0, len(batch), 512):  # bounds what a batch of long words makes
            out = []
            for word, i, n, front, back in zip(*(c.slice(at, 512).to_pylist() for c in rows)):
                letters = np.frombuffer(word.encode("utf-32-le"), np.uint32)
                size = len(letters)
                f = np.concatenate([[0], front])  # f[k]: the first k letters
                b = np.concatenate([[0], back])[::-1]  # b[k]: all but the first k letters
                same = np.concatenate([[False], letters[1:] == letters[:-1]])
                kind = np.concatenate([np.zeros(size + 1, np.int8), np.where(same, 2, 1).astype(np.int8)])
                out.append((np.concatenate([f, f[:-1]]), np.concatenate([b, b[1:]]), np.full(2 * size + 1, i), np.full(2 * size + 1, n), kind))
            if out:
                columns = [np.concatenate(c) for c in zip(*out)]
                kinds = [pa.int64()] * 4 + [pa.int8()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["front", "back", "id", "n", "kind"])


def near_words(dictionary: DataFrame) -> DataFrame:
    """``word, n, id, path`` to ``id, n_near, best``: how many words differ by one letter, and the most frequent
    of them as struct(n, -id), the first in order among equals. Words without any are left out."""
    back = trie_nodes(dictionary.select(F.reverse("word").alias("key"), "id"))
    both = dictionary.select("word", "n", "id", F.col("path").alias("front")).join(back.select("id", F.col("path").alias("back")), "id")
    pairs = both.select("word", "id", "n", "front", "back").mapInArrow(_pairs, "front long, back long, id long, n long, kind byte")
    member = F.struct("n", (-F.col("id")).alias("id"), "kind")
    groups = pairs.groupBy("front", "back").agg(F.collect_list(member).alias("all")).where("size(all) > 1")
    each = groups.select("all", F.explode("all").alias("me"))

    def is_near(x: Column, me: Column) -> Column:
        # a pair with one gap: words that skip a letter here have one letter more, counted where it is skipped first
        gap = (x["kind"] == 0) | (me["kind"] == 0)
        return (x["id"] != me["id"]) & (~gap | ((x["kind"] != 2) & (me["kind"] != 2)))

    each = each.select((-F.col("me.id")).alias("id"), "me", "all")
    near = F.filter("all", lambda x: is_near(x, F.col("me")))
    each = each.select("id", near.alias("near")).where("size(near) > 0")
    best = F.array_max(F.transform("near", lambda x: F.struct(x["n"].alias("n"), x["id"].alias("id"))))
    return each.select("id", F.size("near").cast("long").alias("k"), best.alias("best")).groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``id, form`` to ``id, root``: forms followed to the last, two steps, four, eight and so on at a time.

    A form is at least ten times as frequent as its word, so no chain has 20 steps.
    """
    links = forms.withColumnRenamed("form", "root")
    while True:
        up = links.select(F.col("id").alias("root"), F.col("root").alias("next"))
        step = links.join(up, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = staged(step, "roots")
        links = step.select("id", "root")
        if step.where("moved").isEmpty():
            return links


def variants(docs: DataFrame, ratio: int = 10, **kw) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: one row per word."""
    counted = staged(words(docs, **kw), "words")
    nodes = trie_nodes(counted.select(F.col("word").alias("key"), F.lit(None).cast("long").alias("id")))
    dictionary = staged(nodes.withColumnRenamed("key", "word").join(counted, "word"), "dictionary")
    near = dictionary.select("id", "word", "n").join(near_words(dictionary), "id", "left")
    takes = F.col("best.n") >= ratio * F.col("n")
    form = F.when(takes, -F.col("best.id"))
    near = staged(near.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), form.alias("form"), F.when(takes, F.col("best.n")).alias("form_n")), "near-words")
    last = roots(near.where("form is not null").select("id", "form"))
    named = near.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    changed = near.where("form is not null").join(last, "id").join(named, "form")
    ends = near.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    changed = changed.join(ends, "root").select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n")
    none = F.lit(None).cast("string").alias("form")
    alone = near.where("form is null").select("word", none, F.col("word").alias("root"), "n", "n_near", "form_n")
    return alone.union(changed)
