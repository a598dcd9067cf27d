"""Filters and conversions of platform messages."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinflow.functions import attributes as A
from twinflow.functions.times import in_calendar
from twinflow.schemas import DEFAULT_QUEUES, QUEUES


def filter_queues(df: DataFrame, queues: Iterable[str] = DEFAULT_QUEUES) -> DataFrame:
    """Only messages of these queues; pushed down to the scan of a stored table."""
    queues = list(queues)
    unknown = sorted(set(queues) - set(QUEUES))
    if unknown:
        raise ValueError(f"unknown queues {unknown}; there are {list(QUEUES)}")
    return df.where(F.col("queue").isin(*queues))


def filter_payload(df: DataFrame, payload_class: str = "Message") -> DataFrame:
    """Only messages with a payload of this class."""
    return df.where(F.col("payload_class") == payload_class)


def filter_messages(
    df: DataFrame,
    types: Iterable[str] | None = None,
    classes: Iterable[str] | None = None,
    scopes: Iterable[str] | None = None,
    since: int | None = None,
    until: int | None = None,
) -> DataFrame:
    """Messages by type, class, scope and time [since, until) in milliseconds."""
    for column, wanted in (("type", types), ("class", classes), ("scope_id", scopes)):
        if wanted is not None:
            df = df.where(F.col(column).isin(*wanted))
    if since is not None:
        df = df.where(F.col("timestamp") >= since)
    if until is not None:
        df = df.where(F.col("timestamp") < until)
    return df


def payload_json(df: DataFrame, column: str = "payload") -> Column:
    """The payload as JSON text; text payloads already are."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column)
    return F.to_json(column)


def to_events(df: DataFrame, now_ms: Column | None = None) -> DataFrame:
    """Messages as records to relay: payload, attributes and the message time.

    A time outside of the calendar has no ``event_ts``; the attributes still
    tell the number that was sent.
    """
    sent = F.when(in_calendar(F.col("timestamp")), F.col("timestamp"))
    return df.select(
        "message_id",
        payload_json(df).alias("payload"),
        A.with_event_time(A.message_attributes(), now_ms).alias("attributes"),
        F.timestamp_millis(sent).alias("event_ts"),
    )


def relay_messages(
    df: DataFrame, queues: Iterable[str] = DEFAULT_QUEUES, now_ms: Column | None = None
) -> DataFrame:
    """The relay: one record per message of the subscribed queues."""
    return to_events(filter_queues(df, queues), now_ms)
