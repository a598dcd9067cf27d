"""Whole small tables against one-by-one versions."""

import brute
import pytest

from twinflow.llm import queries
from twinflow.llm.common import table

SF = "/root/testdata/sf0.001"


def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents]


def by_id(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


def test_base_counts(spark, documents):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = by_id(queries.op1_quality_rules(spark, SF), *columns)
    assert got == {i: brute.base(t) for i, t in texts(documents)}


def test_components(spark, documents):
    got = by_id(queries.op2_jaccard_join(spark, SF), "n_shingles", "component_id")
    assert got == brute.jaccard_components(texts(documents))


def test_word_model(spark, documents):
    got = by_id(queries.op4_lm_scoring(spark, SF), "n_tokens", "n_known", "train_tokens", "base_score", "score", "held_out")
    for i, (n, known, total, score) in brute.base_scores(texts(documents)).items():
        assert got[i][:3] == (n, known, total)
        assert got[i][3] == pytest.approx(score, rel=1e-9)
        assert got[i][4] < 0 and got[i][5] == (brute.rem(i, 10) == 0)


def test_repeats(spark, documents):
    got = by_id(queries.op6_suffix_dedup(spark, SF), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.without_repeats(texts(documents))


def test_mix(spark, documents):
    source = {r["doc_id"]: r["source"] for r in documents}
    sizes = {}
    for i, t in texts(documents):
        sizes[source[i]] = sizes.get(source[i], 0) + len(brute.words(t))
    want, taken = brute.targets(sizes), {}
    rows = by_id(queries.op9_mixing(spark, SF), "size", "source_size", "target", "taken")
    for i, t in texts(documents):
        size, whole, target, took = rows[i]
        assert size == len(brute.words(t)) and whole == sizes[source[i]]
        assert target == pytest.approx(want[source[i]]) and 0 <= took <= 2 * size
        taken[source[i]] = taken.get(source[i], 0) + took
    assert all(abs(taken[s] - want[s]) <= 48 for s in want)
    assert rows == by_id(queries.op9_mixing(spark, SF), "size", "source_size", "target", "taken")


def test_language_on_held_out_rows(spark):
    rows = queries.op8_language_id(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out and lang is not null").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held) > 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op7_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.9 * len(rows) > 0


def test_benchmark_passages(spark, documents):
    """Every run of 25 equal tokens is found."""
    import re

    tokens = {i: re.findall(r"[^\W_]+", (t or "").lower()) for i, t in texts(documents)}
    want = set()
    for item in table(spark, SF, "benchmark").collect():
        own = re.findall(r"[^\W_]+", item["text"].lower())
        runs = {tuple(own[k : k + 25]) for k in range(len(own) - 24)}
        want |= {(i, item["item_id"]) for i, ts in tokens.items() if any(tuple(ts[k : k + 25]) in runs for k in range(len(ts) - 24))}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op5_decontamination(spark, SF).collect()}
    assert want <= got


def test_listed_url_rules(spark):
    listed = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    urls = {r["page_id"]: r["url"] for r in table(spark, SF, "pages").collect()}
    for r in queries.op3_url_filters(spark, SF).collect():
        rest = urls[r["page_id"]].split("://", 1)[1]
        end = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
        host, path = rest[:end].lower(), rest[end:].split("?")[0].split("#")[0]
        fit = [x for x in listed for h, _, p in [x.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        rule = max(fit, key=len, default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (listed[rule] if rule else "block" if r["mined"] else "allow")


def test_pipeline(spark, documents):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    ids = [r["doc_id"] for r in rows]
    assert len(set(ids)) == len(ids) and 0 < len(ids) < len(documents)
    hit = {r["doc_id"] for r in queries.op5_decontamination(spark, SF).collect()}
    assert not hit & set(ids)
    left = brute.jaccard_components([(i, t) for i, t in texts(documents) if i in set(ids)])
    assert all(i == c for i, (_, c) in left.items())


def test_stages_keep_the_columns_of_documents(spark):
    import corpus_pipeline

    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
