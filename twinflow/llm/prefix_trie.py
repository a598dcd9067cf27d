"""Prefix trie of conversations.

Turns are encoded by a dictionary, so a conversation is a sequence of integers. Equal
conversations count as one with a weight. The different ones are dealt out by range,
and every range builds a ternary search tree of its own: sorted sequences go in median
first, which keeps the trees within a trie node balanced. One loop over the nodes from
the last made to the first then hands members, leaves and savings up to the parents.

A node that several ranges share begins the first sequence of each of them but the
first. Neighbouring ranges share as many turns as the last sequence of one and the
first of the next, so the shared nodes are known by range and depth. Their parts are
added up and handed up the shared nodes, at most the length of a sequence per range.

Turns are ordered by number, null first; turns of one number by their turn ids, so
the order does not depend on the input's. A null role or text is empty. Repeated rows are
turns of their own. Rows without a conversation id belong to no conversation. An empty
table gives an empty result, not even a root. Other columns are left aside. A conversation
is one row of 16 bytes a turn, without texts; copies of one meet as lists of up to 4,096 ids.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinflow.session import staged

A_RANGE = 200_000  # turns that one range holds, on average
IDS = 12  # bits of an id: 4,096 ids are put in order and joined at a time
SEQ = "array<struct<id:bigint,bytes:bigint>>"


def turn_ids(turns: DataFrame) -> DataFrame:
    """Adds ``id``: one integer per different (role, text).

    It is the turn's 64-bit hash. Where different turns (by another hash) share one, the dictionary
    gives all but the smallest a number that no hash has.
    """
    turns = turns.withColumn("hash", F.xxhash64("role", "text"))
    turn = F.struct("role", "text")
    same = turns.groupBy("hash").agg(F.min(F.xxhash64(F.lit(1), "text", "role")).alias("lo"), F.max(F.xxhash64(F.lit(1), "text", "role")).alias("hi"))
    clash = staged(same.where("lo <> hi").select(F.col("hash").alias("c")), "clashes")
    if clash.isEmpty():
        return turns.withColumnRenamed("hash", "id")
    rivals = turns.join(clash, F.col("hash") == F.col("c"), "left_semi").select("hash", turn.alias("turn")).distinct()
    rivals = rivals.withColumn("k", F.row_number().over(Window.partitionBy("hash").orderBy("turn")))
    moved = rivals.where("k > 1").withColumn("id", F.xxhash64("hash", "k"))
    taken = turns.select("hash").union(rivals.select("hash")).distinct()
    moved = staged(moved.select(F.col("hash").alias("c"), F.col("turn").alias("t"), "id"), "dictionary")
    if not moved.join(taken, F.col("id") == F.col("hash"), "left_semi").isEmpty() or moved.select("id").distinct().count() < moved.count():
        raise ValueError("the numbers of turns with one hash meet another hash")
    found = turns.join(moved, (F.col("hash") == F.col("c")) & turn.eqNullSafe(F.col("t")), "left")
    return found.withColumn("id", F.coalesce("id", "hash")).drop("hash", "c", "t")


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, seq``: a row per conversation, its turns as (id, bytes of the text) in order."""
    none = F.lit("")
    turns = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text")
    )
    turns = turn_ids(turns).select("conv_id", F.struct("turn", "id", F.octet_length("text").cast("long").alias("bytes")).alias("t"))
    inside = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return inside.select("conv_id", F.transform("ts", lambda t: F.struct(t["id"].alias("id"), t["bytes"].alias("bytes"))).alias("seq"))


def rebuilt(seqs: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Every conversation c with its first h turns taken from the conversation c - c % group, h = crc32(c) % most."""
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(group))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    firsts = seqs.where(F.pmod("conv_id", F.lit(group)) == 0).select(F.col("conv_id").alias("base"), F.slice("seq", 1, most).alias("head"))
    rows = seqs.select("conv_id", "seq", base.alias("base"), h.alias("h")).join(firsts, "base", "left")
    head = F.when(F.col("head").isNull(), F.expr(f"cast(array() as {SEQ})")).otherwise(F.slice("head", 1, F.col("h")))
    rest = F.slice("seq", F.col("h") + 1, F.greatest(F.lit(0), F.size("seq") - F.col("h")))
    return rows.select("conv_id", F.concat(head, rest).alias("seq"))


def distinct_sequences(seqs: DataFrame) -> DataFrame:
    """``seq, n, conv_id, sha``: each different sequence, how many have it, the smallest, and the digest of their ids.

    The digest is over all ids in order, which no two tasks can share. Ids are put in order and
    joined in lists of a bounded length before they meet; the lists go through one
    digest one by one.
    """
    ids = seqs.select("seq", F.shiftright("conv_id", IDS).alias("chunk"), "conv_id")
    lists = ids.groupBy("seq", "chunk").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    joined = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    lists = lists.select("seq", "chunk", F.size("ids").cast("long").alias("n"), F.element_at("ids", 1).alias("conv_id"), joined.alias("ids"))

    def digests(batches):
        import hashlib

        import pyarrow as pa

        now, n, least, digest = None, 0, None, None

        def row():
            return {"seq": now, "n": n, "conv_id": least, "sha": digest.hexdigest()}

        schema = pa.schema([("seq", pa.list_(pa.struct([("id", pa.int64()), ("bytes", pa.int64())]))), ("n", pa.int64()), ("conv_id", pa.int64()), ("sha", pa.string())])
        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if digest is None or r["seq"] != now:
                    if digest is not None:
                        done.append(row())
                    now, n, least, digest = r["seq"], 0, r["conv_id"], hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(r["ids"].encode())
                n += r["n"]
            yield pa.RecordBatch.from_pylist(done, schema=schema)
        if digest is not None:
            yield pa.RecordBatch.from_pylist([row()], schema=schema)

    key = F.xxhash64("seq")
    lists = lists.repartition(key).sortWithinPartitions("seq", "chunk")
    return lists.mapInArrow(digests, f"seq {SEQ}, n long, conv_id long, sha string")


def _shared(bounds: DataFrame) -> DataFrame:
    """``part, owners, after``: for each range, the first range that has its first sequence's node of
    depth 0, 1 and so on, as far as an earlier one has it; and up to which depth (-1: none) its
    last sequence's nodes go on in the next range. One row per range, so one task holds them.
    """

    def run(batches):
        import pyarrow as pa

        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["part"])
        if not rows:
            return

        def common(a, b):
            return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

        out = [{"part": rows[0]["part"], "owners": [], "after": -1}]
        for before, r in zip(rows, rows[1:]):
            out[-1]["after"] = depth = common(before["last"], r["first"])
            # nodes of the range before that are not those of its first sequence begin in it
            through = out[-1]["owners"][: min(depth, common(before["first"], before["last"])) + 1]
            out.append({"part": r["part"], "owners": through + [before["part"]] * (depth + 1 - len(through)), "after": -1})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("part", pa.int64()), ("owners", pa.list_(pa.int64())), ("after", pa.int64())]))

    return bounds.repartition(1).mapInArrow(run, "part long, owners array<long>, after long")


class Tree:
    """A ternary search tree of integer sequences; node 0 is the root of the trie."""

    def __init__(self):
        self.key, self.low, self.high, self.down, self.up = [None], [0], [0], [0], [0]
        self.size, self.ends = [0], [None]

    def _child(self, node: int, key: int, size: int) -> int:
        """The child of ``node`` with ``key``, made if there is none."""
        at, link = self.down[node], self.down
        where = node
        while at:
            if key == self.key[at]:
                return at
            link = self.low if key < self.key[at] else self.high
            where, at = at, link[at]
        link[where] = made = len(self.key)
        for values, value in ((self.key, key), (self.low, 0), (self.high, 0), (self.down, 0), (self.up, node), (self.size, size), (self.ends, None)):
            values.append(value)
        return made

    def insert(self, seq, what) -> None:
        node = 0
        for turn in seq:
            node = self._child(node, turn["id"], turn["bytes"])
        self.ends[node] = what

    @classmethod
    def of(cls, rows: list) -> "Tree":
        """Rows sorted by ``seq``, the middle one first, then the middles of both halves."""
        tree, halves = cls(), [(0, len(rows))]
        for low, high in halves:  # grows while it is read
            if low < high:
                middle = (low + high) // 2
                tree.insert(rows[middle]["seq"], rows[middle])
                halves += [(low, middle), (middle + 1, high)]
        return tree

    def path(self, seq) -> list[int]:
        nodes = [0]
        for turn in seq:
            nodes.append(self._child(nodes[-1], turn["id"], turn["bytes"]))
        return nodes


PART = (
    "part long, depth long, shared boolean, conv_id long, parent_conv_id long, up_part long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, bytes long, ends_sha256 string"
)


def _range_nodes(key, rows, shared):
    """The nodes of one range. Nodes that other ranges have too come with what this one adds to them."""
    import pyarrow as pa

    part = key[0].as_py()
    rows = rows.to_pylist()
    rows.sort(key=lambda r: [t["id"] for t in r["seq"]])
    shared = shared.to_pylist()[0]
    tree = Tree.of(rows)
    many = len(tree.key)
    # the range a shared node belongs to; with the depth that names it
    owner = dict(zip(tree.path(rows[0]["seq"]), shared["owners"]))
    for node in tree.path(rows[-1]["seq"])[: shared["after"] + 1]:
        owner.setdefault(node, part)

    depth = [0] * many
    for node in range(1, many):
        depth[node] = depth[tree.up[node]] + 1
    convs, least, children, leaves, saved = [0] * many, [None] * many, [0] * many, [0] * many, [0] * many
    for node in range(many - 1, -1, -1):  # children were made after their parents
        if end := tree.ends[node]:
            convs[node] += end["n"]
            least[node] = end["conv_id"] if least[node] is None else min(least[node], end["conv_id"])
        if node not in owner:
            leaves[node] += children[node] == 0
            saved[node] += (convs[node] - 1) * tree.size[node]
        if not node:
            continue
        up = tree.up[node]
        convs[up] += convs[node]
        least[up] = least[node] if least[up] is None else min(least[up], least[node])
        if node not in owner:  # shared children are counted once, where the ranges meet
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    out = {name: [] for name in ("part", "depth", "shared", "conv_id", "parent_conv_id", "up_part", "n_convs", "n_children", "n_leaves", "saved_tokens", "bytes", "ends_sha256")}
    for node in range(many):
        up = tree.up[node] if node else None
        row = (
            owner.get(node, part), depth[node], node in owner, least[node], None if up is None or up in owner else least[up], owner.get(up),
            convs[node], children[node], leaves[node], saved[node], tree.size[node], tree.ends[node] and tree.ends[node]["sha"],
        )
        for values, value in zip(out.values(), row):
            values.append(value)
    kinds = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 8, pa.string()]
    return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


def _handed_up(shared: DataFrame) -> DataFrame:
    """Shared nodes with the children, leaves and savings of the shared nodes below them."""

    def run(batches):
        import pyarrow as pa

        rows = [r for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: -r["depth"])
        at = {(r["part"], r["depth"]): r for r in rows}
        for r in rows:
            r["n_leaves"] += r["n_children"] == 0
            r["saved_tokens"] += (r["n_convs"] - 1) * r["bytes"]
            if r["depth"]:
                up = at[(r["up_part"], r["depth"] - 1)]
                up["n_children"] += 1
                up["n_leaves"] += r["n_leaves"]
                up["saved_tokens"] += r["saved_tokens"]
                r["parent_conv_id"] = up["conv_id"]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=batch_schema)

    import pyarrow as pa

    names = shared.columns
    batch_schema = pa.schema([(n, pa.string() if n == "ends_sha256" else pa.int64()) for n in names])
    return shared.repartition(1).mapInArrow(run, ", ".join(f"{n} {'string' if n == 'ends_sha256' else 'long'}" for n in names))


def trie(seqs: DataFrame, a_range: int = A_RANGE) -> DataFrame:
    """``conv_id, seq`` to a row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``."""
    each = staged(distinct_sequences(seqs), "sequences")
    turns = each.agg(F.sum(F.size("seq") + 1)).first()[0] or 0
    # a range is written before its bounds are read: another run of the dealing could cut elsewhere
    dealt = each.repartitionByRange(max(1, math.ceil(turns / a_range)), "seq").withColumn("part", F.spark_partition_id().cast("long"))
    dealt = staged(dealt, "ranges")
    ids = F.transform("seq", lambda t: t["id"])
    bounds = dealt.groupBy("part").agg(F.min(ids).alias("first"), F.max(ids).alias("last"))
    shared = _shared(bounds)
    nodes = staged(dealt.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(_range_nodes, PART), "nodes")

    parts = nodes.where("shared").groupBy("part", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_conv_id").alias("parent_conv_id"), F.max("up_part").alias("up_part"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("bytes").alias("bytes"), F.max("ends_sha256").alias("ends_sha256"),
    )
    joints = staged(_handed_up(parts), "shared-nodes")
    inner = nodes.where("not shared")
    below = inner.where("up_part is not null").drop("parent_conv_id").join(
        joints.select(F.col("part").alias("up_part"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id")), ["up_part", "depth"]
    )
    none = F.sha2(F.lit("").cast("binary"), 256)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    columns: list[Column] = [*map(F.col, columns), F.coalesce("ends_sha256", none).alias("ends_sha256")]
    return inner.where("up_part is null").select(*columns).union(below.select(*columns)).union(joints.select(*columns))


def conversation_trie(conversations: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(staged(sequences(conversations), "conversations"), group, most))
