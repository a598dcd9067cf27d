"""Toxicity by the nearest labelled examples.

Examples are labelled rows as TF-IDF vectors over the terms that go along with the
label. The exact top-k by cosine come from a block-max inverted index: blocks of
examples hold the largest weight of every term, which bounds the cosine with all
examples of a block; blocks are passed from the highest bound down, and a
block whose bound is under a document's k-th best is skipped for it.

At most about ``sample`` labelled rows are learnt from, chosen by a hash of
their id (a documented bound); every document is scored against all of them.
The score is the vote of the neighbours, weighted by their cosine and drawn
towards the share of toxic rows among examples without any term, which is also
the score of null and empty texts. Ties go to the smaller example number.
Without labelled rows the score is 0. Rows are judged one by one.
"""

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinflow.llm.common import flat, free_name, text_of

BLOCK = 128


def terms_of(text: Column) -> Column:
    """Hashes of the lower-cased letter runs."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0)), lambda w: F.xxhash64(w))


def _only(terms: np.ndarray):
    """Rows with those of their terms that are among the sorted ``terms``."""
    import pyarrow as pa

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = flat(batch.column("terms"))
            hit = terms[np.minimum(np.searchsorted(terms, values), len(terms) - 1)] == values
            before = np.concatenate([[0], np.cumsum(hit)])
            lists = pa.ListArray.from_arrays(pa.array(before[offsets], type=pa.int32()), pa.array(values[hit]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("toxic"), lists], names=["doc_id", "toxic", "terms"])

    return kept


def train(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = 20_000, n_terms: int = 512, chi: float = 25.0) -> dict:
    """The index over labelled rows. ``learn`` selects them by ``doc_id``."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(learn)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    many = known.count()
    if not many:
        return {"terms": np.zeros(0, dtype=np.int64), "prior": 0.0}
    part = int(1_000_000 * min(1.0, sample / many))
    known = known.where(F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) < part)
    # at most about ``sample`` rows, so the texts need not move
    rows = docs.select("doc_id", terms_of(text_of()).alias("terms")).join(F.broadcast(known), "doc_id").select("doc_id", F.col("toxic").cast("int").alias("toxic"), "terms")
    totals = rows.groupBy("toxic").count().collect()
    bad = sum(r["count"] for r in totals if r["toxic"] == 1)
    n = sum(r["count"] for r in totals)
    if not bad or bad == n:
        return {"terms": np.zeros(0, dtype=np.int64), "prior": bad / n if n else 0.0}
    each = rows.select("toxic", F.explode(F.array_distinct("terms")).alias("term"))
    seen = each.groupBy("term").agg(F.count("*").alias("df"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("a"))
    expected = F.col("df") * bad / n
    spread = expected * (1 - bad / n) * (1 - F.col("df") / (n + 1))
    seen = seen.withColumn("chi", F.pow(F.col("a") - expected, 2) / spread).where((F.col("chi") > chi) & (F.col("df") >= 3))
    chosen = seen.orderBy(F.desc("chi"), "term").limit(n_terms).toPandas().sort_values("term")
    terms = chosen["term"].to_numpy(dtype=np.int64)
    idf = np.log((n + 1) / (chosen["df"].to_numpy(dtype=float) + 1)) + 1
    if not len(terms):
        return {"terms": terms, "prior": bad / n}
    found = rows.mapInArrow(_only(terms), "doc_id long, toxic int, terms array<long>").where("size(terms) > 0").toPandas()  # bounded by the sample
    found["terms"] = found["terms"].map(tuple)
    found = found.sort_values(["doc_id", "terms"], ignore_index=True)
    places, y = found["terms"], found["toxic"].to_numpy(dtype=float)
    x = np.zeros((len(found), len(terms)), dtype=np.float32)
    for i, p in enumerate(places):
        at, k = np.unique(np.searchsorted(terms, np.asarray(p, dtype=np.int64)), return_counts=True)
        x[i, at] = (1 + np.log(k)) * idf[at]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    # like examples share a block, which makes its bounds low elsewhere
    order = np.lexsort((np.arange(len(x)), x.argmax(axis=1)))
    ids = found["doc_id"].to_numpy(dtype=np.int64)
    rest_bad, rest = bad - y.sum(), n - len(y)
    top = np.stack([x[order[i : i + BLOCK]].max(axis=0) for i in range(0, len(x), BLOCK)])
    return {"terms": terms, "idf": idf, "x": x[order], "y": y[order], "ids": ids[order], "top": top, "prior": float((rest_bad + 0.5) / (rest + 10))}


def nearest(q: np.ndarray, model: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact top-k cosines and example places for each row of unit vectors."""
    bound = q @ model["top"].T
    best = np.zeros((len(q), k), dtype=np.float32)
    place = np.full((len(q), k), len(model["x"]), dtype=np.int64)
    for step in np.argsort(-bound, axis=1, kind="stable").T:
        ub = bound[np.arange(len(q)), step]
        open_rows = ub + 1e-6 >= best[:, -1]
        open_rows &= ub > 0
        if not open_rows.any():
            break
        for b in np.unique(step[open_rows]):
            r = np.flatnonzero(open_rows & (step == b))
            at = np.arange(b * BLOCK, min((b + 1) * BLOCK, len(model["x"])))
            s = np.round(q[r] @ model["x"][at].T, 6)
            both = np.concatenate([best[r], s], axis=1)
            where = np.concatenate([place[r], np.broadcast_to(at, s.shape)], axis=1)
            sel = np.lexsort((where, -both), axis=1)[:, :k]
            best[r], place[r] = np.take_along_axis(both, sel, 1), np.take_along_axis(where, sel, 1)
    return best, place


def score(docs: DataFrame, model: dict, k: int = 15, pull: float = 0.5, into: tuple[str, str] = ("score", "evidence")) -> DataFrame:
    """The input with its score (0 to 1) and the ids of its nearest examples.

    ``into`` names the two columns; input columns of these names are replaced.
    """
    import pyarrow as pa

    docs = docs.drop(*into)
    columns = docs.columns
    own = free_name(docs, "terms")
    terms, prior = model["terms"], model["prior"]

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = flat(batch.column(own))
            rows = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            result = np.full(batch.num_rows, prior)
            evidence: list[list[int]] = [[] for _ in range(batch.num_rows)]
            if len(terms):
                at = np.minimum(np.searchsorted(terms, values), len(terms) - 1)
                hit = terms[at] == values
                key, n = np.unique(rows[hit] * len(terms) + at[hit], return_counts=True)
                r, t = key // len(terms), key % len(terms)
                some, r = np.unique(r, return_inverse=True)
                if len(some):
                    q = np.zeros((len(some), len(terms)), dtype=np.float32)
                    q[r, t] = (1 + np.log(n)) * model["idf"][t]
                    q /= np.linalg.norm(q, axis=1, keepdims=True)
                    cos, place = nearest(q, model, k)
                    y = np.append(model["y"], 0.0)[place]
                    result[some] = ((cos * y).sum(axis=1) + pull * prior) / (cos.sum(axis=1) + pull)
                    for i, c, p in zip(some, cos, place, strict=True):
                        evidence[i] = [int(model["ids"][j]) for j, w in zip(p[:3], c[:3], strict=True) if w > 0]
            kept = [batch.column(c) for c in columns]
            extra = [pa.array(np.clip(result, 0, 1)), pa.array(evidence, type=pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*kept, *extra], names=[*columns, *into])

    from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

    shape = StructType([*docs.schema.fields]).add(into[0], DoubleType()).add(into[1], ArrayType(LongType()))
    return docs.withColumn(own, terms_of(text_of())).mapInArrow(judged, shape)
