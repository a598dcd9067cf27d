"""Mixing sources to target weights by Sainte-Laguë apportionment.

Equal blocks of words are the seats, sources the parties, their targets the
votes. Seats go to the highest quotients target / (2k + 1); a source's seats
are dealt to its shards the same way. In a shard, documents lie in a seeded
order on a ring; its blocks are taken from the start, a second time round if
need be, so no row is taken more than twice.

``mixture`` returns the texts, cut to the words taken; ``mix`` only the counts.

Null texts have size 0 and take nothing; a null source is a source, last in
order. Repeated rows are rows of their own. An empty table gives an empty
result. Shards hold a bounded number of words and, in the mean, of rows; rows
without words are in none. So no task orders a whole source. Rows without an id
are placed by their text; only equal rows always share a shard.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinflow.llm.common import size_in_words, text_of
from twinflow.session import staged

CYCLE = (5, 2, 1)
TOTAL = 1.5
MOST = 2
PIECE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"  # a word and the separators before it
ANY = r"[^\x20\x09-\x0D]"  # costs less than the number of words where that is not needed
ADDED = ("size", "source_size", "target", "taken")


def targets(sizes: DataFrame, cycle=CYCLE, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from one row per source (``source, source_size``).

    Targets are min(most * size, level * weight) for the one level that makes
    them add up: sources are passed from the lowest cap per weight upwards,
    and the level is where the rest of the words fits the rest of the weights.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), ((F.row_number().over(order) - 1) % len(cycle) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size").cast("double"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.withColumn("level", (total * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    # the first source whose cap is above its level sets the level for all that follow
    rows = rows.withColumn("found", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"])
    return rows.withColumn("target", F.coalesce(F.least("cap", F.col("found") * F.col("weight")), F.col("cap"))).select("source", "source_size", "target")


def apportion(votes: DataFrame, vote: str, seats: Column, group: list[str], name: str) -> DataFrame:
    """``votes`` with its seats in column ``name``, highest quotients first.

    Rounding vote * seats / total is off by under half the parties in sum, so only
    seats that near the rounded number are compared.
    """
    key = F.struct(*[c for c in votes.columns])
    w = Window.partitionBy(*group)
    rows = votes.select("*", key.alias("_key"), seats.alias("_seats"))
    rows = rows.withColumns({"_all": F.sum(vote).over(w), "_n": F.count("*").over(w)})
    share = F.when(F.col("_all") > 0, F.col(vote) / F.col("_all")).otherwise(F.lit(0.0))
    rows = rows.withColumn("_mid", F.floor(share * F.col("_seats") + 0.5))
    wide = F.ceil(share * F.col("_n") / 2) + 1
    rows = rows.withColumns({"_low": F.greatest(F.lit(0), F.col("_mid") - wide).cast("long"), "_high": (F.col("_mid") + wide).cast("long")})
    rows = rows.withColumn("_left", F.col("_seats") - F.sum("_low").over(w))
    each = rows.withColumn("_k", F.explode(F.sequence("_low", "_high")))
    best = Window.partitionBy(*group).orderBy((F.col(vote) / (2 * F.col("_k") + 1)).desc(), "_key", "_k")
    each = each.withColumn("_won", (F.row_number().over(best) <= F.col("_left")).cast("long"))
    return each.groupBy(*votes.columns).agg((F.first("_low") + F.sum("_won")).alias(name))


def first_words(text: Column, size: Column, n: Column) -> Column:
    """The text up to its ``n``-th word, null for none; a text taken whole stays as it is."""
    pieces = F.slice(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), 1, n.cast("int"))
    return F.when(n >= size, text).when(n > 0, F.array_join(pieces, ""))


def _dealt(docs: DataFrame, keep: list[str], block: int, shard_words: int, shard_rows: int, seed: int, **shares) -> DataFrame:
    """Every row, as ``_row`` with the columns ``keep``, and how many words each round takes."""
    text = F.xxhash64(text_of())
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), "doc_id", "source", size_in_words(text_of()).alias("size"), text.alias("hash"), text_of().rlike(ANY).alias("worded"),
        F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), text)).otherwise(F.xxhash64(F.lit(seed), F.col("doc_id"))).alias("place"),
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("worded"), 1)).alias("n_rows"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("n_rows") / shard_rows)).cast("long")
    parts = sizes.select(F.col("source").alias("s_source"), parts.alias("n_shards"))
    sources = targets(sizes.select("source", "source_size"), **shares)
    total = F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")
    quotas = apportion(sources, "target", total, [], "quota").join(parts, F.col("source").eqNullSafe(F.col("s_source")))
    # few, small rows: written, their size is known, and Spark broadcasts them below its own threshold
    quotas = staged(quotas.select(F.col("source").alias("q_source"), "source_size", "target", "quota", "n_shards"), "quotas")
    rows = rows.join(quotas, F.col("source").eqNullSafe(F.col("q_source"))).drop("q_source")
    rows = rows.withColumn("shard", F.pmod(F.shiftright("place", 20), "n_shards"))
    shards = rows.where("worded").groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.first("quota").alias("quota"))
    shards = apportion(shards, "shard_size", F.col("quota"), ["source"], "blocks")
    shards = staged(shards.select(F.col("source").alias("s_source"), F.col("shard").alias("s_shard"), "shard_size", "blocks"), "shards")
    ring = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "size", "hash").rowsBetween(Window.unboundedPreceding, -1)
    sized = rows.where("worded").join(shards, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("shard") == F.col("s_shard")))
    sized = sized.withColumn("start", F.coalesce(F.sum("size").over(ring), F.lit(0)))
    wanted = F.col("blocks") * block

    def part(round_start: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), wanted - round_start)).cast("long")

    out = ["_row", "source", "source_size", "target", "shard"]
    none = F.lit(0).cast("long")
    sized = sized.select(*out, "size", part(F.col("start")).alias("once"), part(F.col("start") + F.col("shard_size")).alias("twice"))
    return sized.unionByName(rows.where("not worded").select(*out, *[none.alias(c) for c in ("size", "once", "twice")]))


def mix(docs: DataFrame, block: int = 16, shard_words: int = 1 << 20, seed: int = 42, shard_rows: int = 1 << 14, **shares) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source, shard``: the counts, one row per input row."""
    rows = _dealt(docs, ["doc_id"], block, shard_words, shard_rows, seed, **shares)
    return rows.select("_row.doc_id", "size", "source_size", "target", (F.col("once") + F.col("twice")).alias("taken"), "source", "shard")


def mixture(docs: DataFrame, block: int = 16, shard_words: int = 1 << 20, seed: int = 42, shard_rows: int = 1 << 14, empty: bool = False, **shares) -> DataFrame:
    """The input's columns with the texts taken, and the counts ``size, source_size, target, taken``.

    ``text`` is what the first round takes, ``text_again`` what the second one
    takes, null for nothing. Rows that give nothing go, unless ``empty``. Other columns
    pass through untouched; input columns named like the added ones are replaced.
    """
    keep = [c for c in docs.columns if c not in (*ADDED, "text_again")]
    rows = _dealt(docs, keep, block, shard_words, shard_rows, seed, **shares).withColumn("taken", F.col("once") + F.col("twice"))
    cut = {c: first_words(F.col("_row.text"), F.col("size"), F.col(n)) for c, n in (("text", "once"), ("text_again", "twice"))}
    cut = {c: F.when(F.col("size") > 0, v) for c, v in cut.items()}
    kept = [cut["text"].alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in keep]
    return (rows if empty else rows.where("taken > 0")).select(*kept, cut["text_again"].alias("text_again"), *ADDED)
