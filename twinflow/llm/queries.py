"""One query per operator, over its whole table with production parameters."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinflow.llm import (
    decontaminate, jaccard, language_id, lm_scoring, mixing, pii, prefix_trie, quality_rules, repeats, sharding, spelling,
    toxicity, url_filters,
)
from twinflow.llm.common import remainder, table, text_of


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is bad when the label of its number is of low quality or toxic."""
    labels = table(spark, sf_dir, "labels")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    return url_filters.judge(table(spark, sf_dir, "pages"), labels.select(F.col("doc_id").alias("page_id"), bad))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = remainder("doc_id", 10) != 0
    scored = lm_scoring.score(docs, lm_scoring.train(docs, learn), learn)
    return scored.withColumn("held_out", remainder("doc_id", 10) == 0)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    out = toxicity.score(docs, model)
    return out.select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence",
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs, remainder("doc_id", 4) != 2)
    out = language_id.predict(docs.drop("lang"), model)
    return out.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, those that give nothing too, with a digest of the words of both rounds."""
    out = mixing.mixture(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), empty=True)
    digest = F.sha2(F.concat_ws("\n", "text", "text_again"), 256).alias("taken_sha256")
    return out.select("doc_id", "size", "source_size", "target", "taken", digest)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 equal shards, and where each row goes with a 17th."""
    rows = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), [1.0] * 16, grown=1.0)
    rows = rows.select(
        "doc_id", (F.octet_length(text_of()) + 1).cast("long").alias("size"), F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "grown_shard", sharding.record_key().alias("key"),
    )
    return sharding.numbered(rows, F.col("key"), ties=("doc_id", "size", "text_crc32")).drop("key")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_quality_rules, op2_jaccard_join, op3_url_filters, op4_lm_scoring, op5_decontamination,
        op6_suffix_dedup, op7_toxicity, op8_language_id, op9_mixing, op10_pii, op11_spelling_variants, op12_sharding, op13_prefix_trie, pipeline,
    )
    return {f.__name__: f for f in ops}
