"""Rendezvous hashing of record keys over weighted shards.

Every shard bids for every key: with x in (0, 1) from a hash of key and shard,
the bid is -weight / ln(x), and the highest one wins, the lower number when two are
equal. A shard's bids do not depend on the others, so a further shard takes
records only into itself, and one that goes gives up only its own. Shards get
records in proportion to their weights; a weight of 0 bids never.

``assign`` is narrow. ``numbered`` gives each shard's rows a gapless number in the
order of a second hash of the key; ``write_shards`` writes whole rows in that order.

The key is the id as text. Rows without an id are keyed by their text, a null text
counts as empty; so equal keys, and with them repeated rows, share a shard. An empty
table gives an empty result. Input columns named like the added ones are replaced,
others pass through untouched.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinflow.llm.common import text_of
from twinflow.session import staged

SHARDS = 16
ROWS = 1 << 14  # rows that one task numbers together, on average
BITS = 52  # of a hash, so that a double holds it


def _hash(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def record_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.md5(text_of(text)))


def _bid(key: Column, shard: int, weight: float) -> Column:
    x = (_hash(F.concat(key, F.lit(f":{shard}"))) + 0.5) / float(1 << BITS)
    return F.struct((-weight / F.log(x)).alias("bid"), F.lit(-shard).alias("shard"))


def winner(key: Column, weights: Sequence[float]) -> Column:
    """The number of the shard that gets ``key``."""
    if any(not 0 <= w < math.inf for w in weights) or not any(weights):
        raise ValueError("weights are at least 0, and one is above")
    bids = [_bid(key, i, float(w)) for i, w in enumerate(weights) if w > 0]
    return (-F.array_max(F.array(*bids))["shard"]).cast("int")


def assign(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown: float | None = None, key: Column | None = None) -> DataFrame:
    """Adds ``shard``, and ``grown_shard``: the same with one more shard of weight ``grown``, null without it."""
    key = record_key() if key is None else key
    more = F.lit(None).cast("int") if grown is None else winner(key, [*weights, grown])
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "grown_shard")]
    return docs.select(*kept, winner(key, weights).alias("shard"), more.alias("grown_shard"))


def numbered(rows: DataFrame, key: Column | None = None, ties: Sequence[str] = (), label: str = "sharded", rows_a_task: int = ROWS) -> DataFrame:
    """Adds ``slot``: 0, 1, 2 and so on in each ``shard``, ordered by the key's hash, then by ``ties``.

    Rows are written once with a number of their own. Ranges of hashes are counted, numbered
    each for itself and moved up by what is ahead of them. A range that equal keys make
    large is numbered in several parts, one after another.
    """
    key = record_key() if key is None else key
    columns = [c for c in rows.columns if c != "slot"]
    own = {c: _free(rows, c) for c in ("place", "uid", "range", "part", "start", "many", "s", "r")}
    place, uid, range_, part, start, many, s, r = own.values()
    rows = rows.select(*[F.col(f"`{c}`") for c in columns], _hash(key).alias(place), F.monotonically_increasing_id().alias(uid))
    rows = staged(rows, label)
    n = rows.count()
    bits = max(0, math.ceil(math.log2(max(1, n) / rows_a_task)))  # as if one shard had all rows
    rows = rows.withColumn(range_, F.expr(f"shiftright(`{place}`, {BITS - min(bits, BITS)})"))
    counts = rows.groupBy("shard", range_).agg(F.count("*").alias(many))
    hot = counts.where(F.col(many) > 4 * rows_a_task).withColumn(many, F.ceil(F.col(many) / rows_a_task))
    hot = staged(hot.select(F.col("shard").alias(s), F.col(range_).alias(r), many), f"{label}-hot")
    rows = rows.join(hot, (F.col("shard") == F.col(s)) & (F.col(range_) == F.col(r)), "left").drop(s, r)
    rows = rows.withColumn(part, F.coalesce(F.pmod(F.xxhash64(uid), many), F.lit(0))).drop(many)
    keys = ["shard", range_, part]
    ahead = Window.partitionBy("shard").orderBy(range_, part).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*keys).agg(F.count("*").alias(many))
    starts = starts.select(*keys, F.coalesce(F.sum(many).over(ahead), F.lit(0)).alias(start))
    order = Window.partitionBy(*keys).orderBy(place, *[F.col(f"`{c}`").asc_nulls_first() for c in ties], uid)
    out = rows.join(starts, keys).withColumn("slot", (F.col(start) + F.row_number().over(order) - 1).cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in columns], "slot")


def _free(rows: DataFrame, name: str) -> str:
    """A name for a working column that no input column has."""
    taken = {c.lower() for c in rows.columns}
    while f"_{name}" in taken:
        name = f"_{name}"
    return f"_{name}"


def write_shards(docs: DataFrame, path: str, weights: Sequence[float] = (1.0,) * SHARDS, file_rows: int = ROWS) -> None:
    """All columns, in a folder per shard, in the order of ``slot``, at most ``file_rows`` rows a file."""
    out = numbered(assign(docs, weights).drop("grown_shard"), label="shards-in")
    file = F.floor(F.col("slot") / file_rows)
    out = out.repartition(F.col("shard"), file).sortWithinPartitions("shard", "slot")
    out.write.option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path)
