"""Exact n-gram Jaccard join.

Documents and shingles form a sparse incidence matrix; its product with its
transpose, block by block of shingles, holds the overlaps. Sizes bound what
has to be multiplied: documents of a and b shingles link only if both share
0.8 max(a, b) of them, so a document takes part with its rarest shingles
only, and with none at all unless enough of its shingles occur elsewhere.

Texts with equal sets are one class and enter once. A large group of near copies
is not expanded into pairs: rows of a block are first multiplied with a few members
of it, and every document is compared with the few that it meets most often; then rows of blocks between components are
multiplied with members drawn anew for each block. After that only pairs from different components are left to multiply, and all of
them are. So no link between components is lost. A pair's overlap is added up over the
blocks; pairs whose overlap and what can come behind their last common shingle are below the
bound are discarded, as are pairs whose sets differ too much: shingles of one document alone are counted,
the others are compared as bits. What is left is decided by the whole sets.

Null, empty and wordless texts have an empty set and link with nothing. Ids are
unique; repeated rows of one id and text give repeated results. Rows without
an id stand alone. Extra columns are left aside.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinflow.llm.common import Scratch, ascii_lower, text_of, words_of
from twinflow.llm.graph import components, joined

WORDS = 5
MARKS = 4096  # bits that stand for a set where pairs of it are many
DRAWN = 32  # members of a block, about, that all of its rows are compared with before pairs are
BROADCAST = 1 << 20  # ids that are sent to every executor, 8 MB; more are joined by a shuffle


def shingles(text: Column, n: int = WORDS) -> Column:
    """Sorted distinct hashes of the ``n``-word shingles; a short text is one."""
    w = words_of(ascii_lower(text))

    def all_of(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[w[i + k] for k in range(n)]))
        one = F.array(F.xxhash64(F.array_join(w, " ")))
        none = F.expr("cast(array() as array<bigint>)")
        return F.when(F.size(w) >= n, F.sort_array(F.array_distinct(many))).when(F.size(w) > 0, one).otherwise(none)

    # bind the words once
    return F.transform(F.array(w), all_of)[0]


def _extra(n: Column, percent: int) -> Column:
    """How many shared shingles a lengthened prefix must show; at least one."""
    return F.greatest(F.lit(1), F.floor(n * (100 - percent) / 400)).cast("int")


def _least(n: Column, percent: int) -> Column:
    return F.floor((n * percent + 99) / 100).cast("int")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that link, by their whole sets. Few pairs are broadcast to the sets, which then stay where they are."""
    a = sets.select(F.col("rep").alias("a"), F.col("toks").alias("a_toks"))
    b = sets.select(F.col("rep").alias("b"), F.col("toks").alias("b_toks"))
    both = pairs.join(b, "b").join(a, "a").withColumn("o", F.size(F.array_intersect("a_toks", "b_toks")))
    return both.where(100 * F.col("o") >= percent * (F.size("a_toks") + F.size("b_toks") - F.col("o"))).select("a", "b")


def _marks() -> list[Column]:
    """A bit per shingle ``tok``, at one of ``MARKS`` places by its hash, as columns of 64 bits."""
    bit = "if((shiftright(tok, 6) & {last}) = {w}, shiftleft(1L, cast(tok & 63 as int)), 0L)"
    return [F.expr(f"bit_or({bit})".format(last=MARKS // 64 - 1, w=w)).alias(f"m{w}") for w in range(MARKS // 64)]


def _others(a: str, b: str) -> Column:
    """At least so many shingles of ``a`` are not in ``b``: those whose places no shingle of ``b`` has."""
    return F.expr(" + ".join(f"bit_count({a}_m{w} & ~{b}_m{w})" for w in range(MARKS // 64)))


def _met(a: DataFrame, b: DataFrame, on: list[str], percent: int, which: Column | None = None) -> DataFrame:
    """``a, b, need, overlap, rest``: pairs that meet in blocks where sizes and what is left of both let them link, how many
    blocks these are, and how many shingles both have at most from the last of them on."""
    need = F.ceil(percent * (F.col("a_n") + F.col("b_n")) / (100 + percent))
    fits = (F.col("a_rest") >= need) & (F.col("b_rest") >= need) & (F.col("a_g") != F.col("b_g"))
    met = a.join(b, on).where(fits if which is None else fits & which)
    met = met.select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b"), need.alias("need"), F.least("a_rest", "b_rest").alias("rest"))
    return met.groupBy("a", "b", "need").agg(F.count("*").alias("overlap"), F.min("rest").alias("rest"))


def jaccard_components(docs: DataFrame, percent: int = 80, n: int = WORDS, pivots: int = 3) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id``: one row per input row."""
    scratch = Scratch(docs.sparkSession)
    texts = docs.select("doc_id", shingles(text_of(), n).alias("toks"))
    size = F.size("toks")
    # the lowest hashes: every linked pair shares enough of these
    prefix = F.slice("toks", 1, F.greatest(F.lit(0), size - _least(size, percent) + _extra(size, percent)))
    own = texts.select(
        "doc_id", size.alias("n"), F.xxhash64("toks").alias("k1"), F.xxhash64(F.lit("second"), F.col("toks")).alias("k2"), prefix.alias("prefix")
    )
    prefixes = scratch.keep(own, "shingle-prefixes")
    own = scratch.keep(prefixes.drop("prefix"), "documents")
    classes = own.where("n > 0 and doc_id is not null").groupBy("k1", "k2", "n").agg(F.min("doc_id").alias("rep"))
    classes = scratch.keep(classes, "classes")
    copies = scratch.keep(own.join(classes, ["k1", "k2", "n"]).where("doc_id <> rep").select("doc_id"), "copies")
    heads = prefixes.where("n > 0 and doc_id is not null").join(copies, "doc_id", "left_anti")
    # 44 bits are enough to tell that a shingle may occur elsewhere, and move less
    rows = heads.select(F.col("doc_id").alias("rep"), "n", F.explode("prefix").alias("tok")).withColumn("tok", F.col("tok").bitwiseAND(F.lit((1 << 44) - 1)))
    common = rows.groupBy("tok").agg(F.count("*").alias("df")).where("df > 1").select("tok")
    alive = rows.join(common, "tok", "left_semi").groupBy("rep", "n").agg(F.count("*").alias("m"))
    alive = alive.where(F.col("m") >= _extra(_least(F.col("n"), percent), percent)).select("rep")
    alive = scratch.keep(alive, "alive")
    scratch.free(prefixes, copies)
    # only these documents' texts are cut into shingles again; texts move for less than their shingles would
    few = alive.count() <= BROADCAST
    left = docs.select("doc_id", "text").join(F.broadcast(alive) if few else alive, F.col("doc_id") == F.col("rep"), "left_semi")
    sets = left.select(F.col("doc_id").alias("rep"), shingles(text_of(), n).alias("toks")).dropDuplicates(["rep"])
    sets = scratch.keep(sets, "sets")
    scratch.free(alive)

    # rarest first: shingles of one document alone cannot meet, but fill the prefix
    each = sets.select("rep", F.size("toks").alias("n"), F.explode("toks").alias("tok"))
    often = each.groupBy("tok").agg(F.count("*").alias("df")).where("df > 1")
    met = each.join(often, "tok").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("by"))
    met = met.select("rep", "n", F.size("by").alias("s"), F.col("by")["tok"].alias("toks"))
    left = F.col("s") - _least(F.col("n"), percent) + 1  # those of the document alone come first in the order
    shared = scratch.keep(met.where(left > 0), "shared")
    scratch.free()
    blocks = shared.select("rep", "n", "s", F.posexplode(F.slice("toks", 1, left)).alias("i", "tok"))
    # the row's shingle and those behind it: what a pair can share from here on
    blocks = scratch.keep(blocks.select("tok", "rep", "n", (F.col("s") - F.col("i")).alias("rest")), "blocks")

    def side(rows: DataFrame, name: str, on: tuple[str, ...] = (), more: tuple[str, ...] = ()) -> DataFrame:
        return rows.select("tok", *on, *[F.col(c).alias(f"{name}_{c}") for c in ("rep", "n", "rest", "g", *more)])

    # some members of each block with the others: linear
    rows = blocks.withColumn("g", F.col("rep"))
    member = F.struct("rep", "n", "rest", "g")
    chosen = [F.min_by(member, F.struct(F.xxhash64(F.lit(turn), "rep"), F.col("rep"))) for turn in range(pivots)]
    a = rows.groupBy("tok").agg(F.array_distinct(F.array(*chosen)).alias("p")).select("tok", F.explode("p").alias("p")).select("tok", "p.*")
    met = _met(side(a, "a"), side(rows, "b"), ["tok"], percent)
    # each with the few it meets most often
    most = F.sort_array(F.collect_list(F.struct((-F.col("overlap")).alias("o"), F.xxhash64("a").alias("h"), "a")))
    met = met.groupBy("b").agg(F.slice(most, 1, pivots).alias("most")).select("b", F.explode("most.a").alias("a"))
    pairs = scratch.keep(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    edges = scratch.keep(_linked(pairs, sets, percent), "links")
    scratch.free(pairs)
    known = components(edges, scratch)
    scratch.free(edges)

    def between(rows: DataFrame, known: DataFrame) -> DataFrame:
        """The rows of blocks that lie in several components, with the number of these rows as ``size``."""
        rows = rows.join(known, F.col("rep") == F.col("v"), "left").select("tok", "rep", "n", "rest", F.coalesce("component", "rep").alias("g"))
        open_ = rows.groupBy("tok").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.count("*").alias("size")).where("lo < hi")
        return rows.join(open_.select("tok", "size"), "tok")

    rows = scratch.keep(between(blocks, known), "open-blocks")
    scratch.free(blocks)
    reps = scratch.keep(rows.select("rep").distinct(), "open-documents")
    marks = shared.join(reps, "rep", "left_semi").select("rep", "s", F.explode("toks").alias("tok"))
    marks = scratch.keep(marks.groupBy("rep", "s").agg(*_marks()), "marks")
    scratch.free(reps, shared)
    words = ("s", *(f"m{w}" for w in range(MARKS // 64)))
    # asked for every pair of a block; ``need`` is what both must share
    need = F.ceil(percent * (F.col("a_n") + F.col("b_n")) / (100 + percent))
    can = (F.col("a_s") - _others("a", "b") >= need) & (F.col("b_s") - _others("b", "a") >= need)

    # others in each block, so that a document is compared with many; linear
    drawn = rows.where(F.pmod(F.xxhash64("tok", "rep"), F.col("size")) < DRAWN)
    met = _met(side(drawn.join(marks, "rep"), "a", (), words), side(rows.join(marks, "rep"), "b", (), words), ["tok"], percent, can)
    pairs = scratch.keep(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    edges = scratch.keep(_linked(pairs, sets, percent), "links")
    scratch.free(pairs)
    before, known = known, joined(known, edges, scratch)
    scratch.free(before, edges)

    # what is left between components, in full; lengths that can link are in one or in neighbouring bands
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    last = between(rows.drop("g", "size"), known).withColumn("band", band).join(marks, "rep")
    marked = scratch.keep(last, "marked-blocks")
    scratch.free(rows, marks)
    # the shorter one of a pair looks for the longer one
    shorter = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a_rep") < F.col("b_rep")))
    a = side(marked.withColumn("band", F.explode(F.array("band", F.col("band") + 1))), "a", ("band",), words)
    met = _met(a, side(marked, "b", ("band",), words), ["tok", "band"], percent, shorter & can)
    # what can come behind the last common shingle must make up for what the overlap lacks
    pairs = scratch.keep(met.where(F.col("overlap") + F.col("rest") - 1 >= F.col("need")).select("a", "b"), "pairs")
    found = scratch.keep(_linked(pairs, sets, percent), "links")
    scratch.free(pairs, marked, sets)
    final = joined(known, found, scratch)
    scratch.free(known, found)

    named = classes.join(final, F.col("rep") == F.col("v"), "left").select("k1", "k2", "n", "rep", F.coalesce("component", "rep").alias("component"))
    out = own.join(named, ["k1", "k2", "n"], "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("rep")).alias("class_id"),
    )
