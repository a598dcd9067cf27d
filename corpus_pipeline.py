"""A training corpus in five stages, each an operator of the llm folder.

Toxic documents go, one document of each group of near copies stays, documents
with benchmark passages go, personal data becomes pseudonyms, and sources are
mixed to their weights. Every stage is written as Parquet in the shared folder
and read again by the next. The first four return the columns
of documents, the last one those and the second round and counts of the mix.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinflow.llm import decontaminate, jaccard, mixing, pii, toxicity
from twinflow.llm.common import table
from twinflow.session import staged

ORACLE_SQL = None  # models and pseudonyms are beyond SQL; tests use brute force


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go; null texts have the prior and stay."""
    everything = table(spark, sf_dir, "documents")
    model = toxicity.train(everything.select("doc_id", "text"), table(spark, sf_dir, "labels"), F.lit(True))
    scored = toxicity.score(docs, model, into=("_toxic_score", "_toxic_evidence"))
    return scored.where("_toxic_score < 0.5").drop("_toxic_score", "_toxic_evidence")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component stays; rows without an id stay."""
    groups = jaccard.jaccard_components(docs)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), into="_benchmark_hits")
    return found.where(F.size("_benchmark_hits") == 0).drop("_benchmark_hits")


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(docs, counts=False)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words taken of each document, a second time in ``text_again``; documents that give none go."""
    return mixing.mixture(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
