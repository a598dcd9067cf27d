"""Figures over messages and submitted observations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinflow.functions.times import in_calendar


def message_rates(df: DataFrame, width: str = "1 hour", late: str | None = None) -> DataFrame:
    """Messages per queue and type in tumbling windows of the message time.

    Messages without a time in the calendar are counted under a null window.
    ``late`` sets the watermark when ``df`` is a stream, which has no window
    for such messages and leaves them out.
    """
    known = in_calendar(F.col("timestamp"))
    ts = F.timestamp_millis(F.when(known, F.col("timestamp")))
    if df.isStreaming:
        timed = df.withColumn("message_ts", ts).withColumn("timed", F.lit(True))
    else:
        # Spark drops rows without a window, so these stand in any and are marked
        ts = F.coalesce(ts, F.timestamp_millis(F.lit(0)))
        timed = df.withColumn("message_ts", ts).withColumn("timed", known)
    if late is not None:
        timed = timed.withWatermark("message_ts", late)
    counted = timed.groupBy(F.window("message_ts", width), "timed", "queue", "type").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(
        F.when(F.col("timed"), F.unix_millis("window.start")).alias("window_start"),
        F.when(F.col("timed"), F.unix_millis("window.end")).alias("window_end"),
        "queue",
        "type",
        "n",
    )


def latest_message(df: DataFrame) -> DataFrame:
    """The last message of each scope, by time and then id.

    A maximum over a struct is reduced before the shuffle, so a scope with
    most of the messages costs no more than any other.
    """
    rest = [c for c in df.columns if c not in ("scope_id", "timestamp", "message_id")]
    newest = F.max(F.struct("timestamp", "message_id", *rest)).alias("m")
    return df.groupBy("scope_id").agg(newest).select("scope_id", "m.*")


def twin_summary(routed: DataFrame) -> DataFrame:
    """Per twin, outcome, type and error: records and different observations."""
    return routed.groupBy(
        "digital_twin", "outcome", "observation_type", "error_code"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("observation_id").alias("n_observations"),
    )


SUMMARY = ("digital_twin", "outcome", "observation_type", "error_code")


def summary_sketches(routed: DataFrame, lg_k: int = 12) -> DataFrame:
    """``twin_summary`` in a form that adds up: counts, and a sketch of the different observations.

    Parts, say a batch's or a day's, are kept and merged instead of counted again. The sketch has
    2**lg_k registers; its relative standard error is about 0.8 / sqrt(2**lg_k), 1.3 % here.
    """
    sketch = F.hll_sketch_agg("observation_id", F.lit(lg_k)).alias("sketch")
    return routed.groupBy(*SUMMARY).agg(F.count(F.lit(1)).alias("n"), sketch)


def merged_summaries(parts: DataFrame) -> DataFrame:
    """Any number of parts as one, still in a form that adds up."""
    return parts.groupBy(*SUMMARY).agg(F.sum("n").alias("n"), F.hll_union_agg("sketch").alias("sketch"))


def summary_estimates(parts: DataFrame) -> DataFrame:
    """``twin_summary`` of parts: exact counts, estimated numbers of different observations."""
    merged = merged_summaries(parts)
    return merged.select(*SUMMARY, "n", F.hll_sketch_estimate("sketch").alias("n_observations"))
