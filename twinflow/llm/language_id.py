"""Language by error-correcting output codes.

Every language has a codeword of bits. For each bit, a binary classifier over
hashed letter n-grams tells languages with a 1 from those with a 0; the
codeword with the least weighted logistic loss is the answer.

The classifiers are fitted on at most ``per_lang`` rows of each language, chosen
by a hash of the id (a documented bound; texts are read whole). Null texts and
texts without letters are ``und`` with score 0. Without any training rows all
are ``und``. Rows are judged one by one, so repeated rows repeat the answer.
"""

import itertools
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
OTHER = regex.compile(r"[^\p{L}\p{M}]+")  # marks are parts of letters
LETTER = regex.compile(r"\p{L}")


def features(text: str) -> np.ndarray | None:
    """Buckets of the letter pairs and triples of a text; None without a letter."""
    plain = OTHER.sub(" ", text.lower()).strip()
    if not LETTER.search(plain):
        return None
    c = np.frombuffer(f" {plain} ".encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    two = c[:-1] * np.uint64(1_000_003) + c[1:]
    three = two[:-1] * np.uint64(1_000_003) + c[2:] + np.uint64(1 << 60)
    h = np.concatenate([two, three]) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(50)).astype(np.int64)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """``n`` rows of +1 and -1; all splits of up to five languages, else drawn ones.

    Of 64 seeded drawings, the one with the largest least distance is taken.
    """
    if n <= 5:
        splits = [s for s in itertools.product((1, -1), repeat=n) if s[0] == 1 and -1 in s]
        return np.array(splits, dtype=np.int8).T.reshape(n, -1)
    width = 10 * int(np.ceil(np.log2(n)))
    rng = np.random.default_rng(seed)
    drawn = [rng.choice(np.array([1, -1], dtype=np.int8), size=(n, width)) for _ in range(64)]
    nearest = [min((width - int(a @ b)) // 2 for a, b in itertools.combinations(c.astype(int), 2)) for c in drawn]
    return drawn[int(np.argmax(nearest))]


def train(docs: DataFrame, learn: Column, per_lang: int = 2000) -> dict:
    """The model: languages, codewords, one weight per bit and bucket, bit weights."""
    rows = docs.where(learn & F.col("text").isNotNull() & F.col("lang").isNotNull())
    many = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(many)
    if not langs:
        return {"langs": []}
    # of 2**62 hashes, as many as make about ``per_lang`` rows; never none of a language
    part = F.create_map(*[x for lang in langs for x in (F.lit(lang), F.lit(min(1 << 62, -(-(per_lang << 62) // many[lang]))))])
    rows = rows.where(F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id"), 2) < part[F.col("lang")])

    def count(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                n = np.zeros(BUCKETS, dtype=np.int64)
                for t in texts:
                    f = features(t)
                    if f is not None:
                        n += np.bincount(f, minlength=BUCKETS)
                at = np.flatnonzero(n)
                yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})

    # languages x buckets numbers at most
    sums = rows.select("lang", "text").mapInPandas(count, "lang string, bucket long, n long")
    sums = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((len(langs), BUCKETS))
    counts[sums["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=int), sums["bucket"].to_numpy(dtype=int)] = sums["n"]
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    code = codewords(len(langs))
    weights = []
    for bit in code.T:
        weights.append(np.log(share[bit == 1].mean(axis=0)) - np.log(share[bit == -1].mean(axis=0)))
    weights = np.array(weights).reshape(code.shape[1], BUCKETS)
    # bits that part the languages' own n-grams well count for more
    margin = np.array([[(share[i] * w).sum() * c for w, c in zip(weights, code[i], strict=True)] for i in range(len(langs))])
    trust = np.clip(margin.mean(axis=0), 0.05, None) if margin.size else np.zeros(0)
    return {"langs": langs, "code": code, "weights": weights, "trust": trust / trust.sum() if trust.size else trust}


def predict(docs: DataFrame, model: dict, close: float = 0.2) -> DataFrame:
    """The input with ``lang_pred, score, ambiguous`` for its text.

    ``score`` is the softmax of the negative losses; ``ambiguous`` tells that
    the second best is within ``close`` of it.
    """
    import pandas as pd

    langs = model["langs"]
    docs = docs.drop("lang_pred", "score", "ambiguous")

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch:
                f = features(t) if t and langs else None
                if f is None:
                    rows.append(("und", 0.0, False))
                    continue
                if len(langs) == 1:
                    rows.append((langs[0], 1.0, False))
                    continue
                n = np.bincount(f, minlength=BUCKETS)
                at = np.flatnonzero(n)
                margin = np.clip(model["weights"][:, at] @ n[at] / np.sqrt(len(f)), -30, 30)
                loss = np.logaddexp(0, -model["code"] * margin) @ (model["trust"] * len(margin))
                p = np.exp(loss.min() - loss)
                p /= p.sum()
                best, second = np.argsort(-p, kind="stable")[:2]
                rows.append((langs[best], float(p[best]), bool(p[best] - p[second] < close)))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "ambiguous"])

    return docs.withColumn("_lid", judged(F.col("text"))).select(*[f"`{c}`" for c in docs.columns], "_lid.*")
