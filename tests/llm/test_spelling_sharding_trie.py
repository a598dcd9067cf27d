"""Spelling variants, sharding and the conversation trie against one-by-one versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from compare import connection, difference

from twinflow.llm import oracles, prefix_trie, queries, sharding, spelling

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_sharding", "op13_prefix_trie"])
def test_query_equals_its_sql(spark, name):
    assert difference(queries.queries()[name](spark, SF), connection(SF), oracles.ORACLES[name]) is None


# spelling


def brute_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    around = {w: [v for v in words if near(w, v)] for w in words}
    forms = {}
    for w, vs in around.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, words[w], len(around[w]), words[forms[w]] if forms[w] else None))
    return sorted(out, key=str)


def variants_of(df, **kw):
    return sorted((tuple(r) for r in spelling.variants(df, **kw).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


@pytest.fixture(scope="module")
def misspelt(spark):
    """Chains of forms, repeated letters, letters beyond ASCII, long runs, nulls, clashing columns."""
    rng = random.Random(3)
    text = ["lettering " * 300, "lettring " * 25, "lettrng lettrng ", "ÀÉaaaaabb " * 40, "àéaaaaabb ÀÉaaaabb ÀÉaaaaabbb ÀÉaaaabb ÀÉaaaaabbb "]
    for _ in range(60):
        w = "".join(rng.choice("abç") for _ in range(rng.randint(6, 9)))
        text.append(f"{w} " * rng.randint(1, 12))
    text += ["x" * 3000 + " " + "x" * 3000, "x" * 2999 + "y " + "x" * 2999 + "y", None, "", " 1 2 ", "short"]
    rows = [(i if i % 7 else None, t, 1, "w", "r", 2) for i, t in enumerate(text)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, n long, word string, run string, h long")


def test_variants(misspelt):
    rows = [(r["doc_id"], r["text"]) for r in misspelt.collect()]
    want = brute_variants(rows)
    assert variants_of(misspelt) == want
    assert any(w[1] and w[2] != w[1] for w in want)  # a chain
    assert variants_of(misspelt.limit(0)) == []


def test_trie_nodes_are_the_same_fronts_in_many_ranges(spark, misspelt):
    words = [r["word"] for r in spelling.words(misspelt).collect()]
    df = spark.createDataFrame([(w, None) for w in words], "key string, id long")
    one, many = (spelling.trie_nodes(df, a_range=n).collect() for n in (1 << 20, 40))
    assert len({r["id"] for r in many}) == len(words)
    assert [r["key"] for r in sorted(many, key=lambda r: r["id"])] == sorted(words)
    for rows in (one, many):
        node_of, front_of = {}, {}
        for r in rows:
            assert len(r["path"]) == len(r["key"])
            for d, node in enumerate(r["path"], 1):
                assert node_of.setdefault(r["key"][:d], node) == node
                assert front_of.setdefault(node, r["key"][:d]) == r["key"][:d]


# sharding


def brute_shard(key, weights):
    bids = []
    for i, w in enumerate(weights):
        x = (int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        bids.append((-w / math.log(x), -i))
    return -max(bids)[1]


def test_shards_follow_weights_and_move_into_the_new_one_only(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'t' as text", "1 as shard", "2 as slot", "3 as _s", "4 as _range", "5 as place")
    weights = [1.0, 3.0, 0.0, 4.0]
    rows = sharding.assign(docs, weights, grown=2.0)
    assert rows.columns == ["doc_id", "text", "slot", "_s", "_range", "place", "shard", "grown_shard"]
    got = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in rows.collect()}
    for i in range(0, 4000, 37):
        assert got[i] == (brute_shard(str(i), weights), brute_shard(str(i), [*weights, 2.0]))
    assert all(b in (a, 4) for a, b in got.values())
    share = Counter(a for a, _ in got.values())
    assert share[2] == 0 and abs(share[1] / 4000 - 3 / 8) < 0.03 and abs(share[3] / 4000 - 1 / 2) < 0.03
    with pytest.raises(ValueError, match="weights"):
        sharding.assign(docs, [0.0])


def slots(df):
    found = defaultdict(list)
    for r in df.collect():
        found[r["shard"]].append(r["slot"])
    return {s: sorted(v) for s, v in found.items()}


def test_slots_are_gapless_with_hot_keys_nulls_and_many_ranges(spark):
    rows = [(None, "same")] * 300 + [(7, "same")] * 300 + [(i, f"t{i}") for i in range(400)] + [(None, None), (None, "")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, slot long, _uid long")
    out = sharding.numbered(sharding.assign(docs, [1.0] * 4), ties=("doc_id",), rows_a_task=16)
    got = slots(out)
    assert sum(map(len, got.values())) == len(rows)
    assert all(v == list(range(len(v))) for v in got.values())
    assert set(out.columns) == {"doc_id", "text", "_uid", "shard", "grown_shard", "slot"}
    assert sharding.numbered(sharding.assign(docs.limit(0))).count() == 0


def test_written_shards_hold_all_columns_in_order(spark, documents, tmp_path):
    path = str(tmp_path / "shards")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sharding.write_shards(docs, path, [1.0, 1.0, 2.0], file_rows=50)
    back = spark.read.parquet(path)
    assert {r["doc_id"]: r["text"] for r in back.collect()} == {r["doc_id"]: r["text"] for r in documents}
    assert all(v == list(range(len(v))) for v in slots(back).values())


# conversations


def brute_trie(rows, group=5, most=9):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple(own.get(c - c % group, [])[:h]) + tuple(turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in built.items():
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) > len(p) for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        text = ",".join(map(str, sorted(ends.get(path, []))))
        up = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), up, len(convs), len(children), len(leaves), saved, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def talks(spark):
    """Shared first turns, copies, chains in chains, one long talk, nulls, extra columns."""
    rng = random.Random(8)
    rows = []
    for c in range(120):
        n = 60 if c == 17 else rng.randint(1, 7)
        rows += [(c, t if t else None, rng.choice(["user", None]), rng.choice(["é", "b", "cc", None]) if t else "hello", 1, 2) for t in range(n)]
    for c in range(9001, 9300, 3):
        rows += [(c, t, "user", f"t{t}", 1, 2) for t in range(4)]
    rows += [(None, 0, "user", "nobody", 1, 2), (3_000_000_000_000, 5, "", "", 1, 2)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq int, part int")


def test_trie(talks):
    rows = [tuple(r)[:4] for r in talks.collect()]
    assert nodes(prefix_trie.conversation_trie(talks)) == brute_trie(rows)
    assert prefix_trie.conversation_trie(talks.limit(0)).count() == 0


@pytest.mark.parametrize("a_range", [3, 25, 200])
def test_trie_of_many_ranges(talks, a_range):
    seqs = prefix_trie.rebuilt(prefix_trie.sequences(talks))
    assert nodes(prefix_trie.trie(seqs, a_range)) == nodes(prefix_trie.trie(seqs))


def test_turns_with_one_hash_get_different_numbers(spark, monkeypatch):
    real = prefix_trie.F.xxhash64
    short = lambda *c: real(*c) % 8 if isinstance(c[0], str) and c[0] == "role" else real(*c)
    monkeypatch.setattr(prefix_trie.F, "xxhash64", short)
    turns = spark.createDataFrame([("user", f"t{i % 40}") for i in range(200)], "role string, text string")
    got = prefix_trie.turn_ids(turns).distinct().collect()
    assert len(got) == 40 and len({r["id"] for r in got}) == 40


def test_a_tree_keeps_what_went_in():
    rng = random.Random(2)
    seqs = sorted({tuple(rng.randint(-4, 4) for _ in range(rng.randint(0, 6))) for _ in range(300)})
    tree = prefix_trie.Tree.of([{"seq": [{"id": k, "bytes": 1} for k in s]} for s in seqs])
    fronts = {s[:d] for s in seqs for d in range(len(s) + 1)}
    assert len(tree.key) == len(fronts) and sum(e is not None for e in tree.ends) == len(seqs)
    assert all(up < node for node, up in enumerate(tree.up) if node)
