"""Success, failure and event routes."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinflow.functions import attributes as A
from twinflow.operators.messages import filter_payload, to_events
from twinflow.operators.validate import fail_where
from twinflow.schemas import ROUTE_EVENTS, ROUTE_FAILURE, ROUTE_SUCCESS, UNRESOLVED_ID

OBSERVATION_FIELDS = (
    "digital_twin",
    "observation_id",
    "name",
    "urn",
    "observation_type",
    "geometry",
)


def serialize_observation(df: DataFrame) -> Column:
    """The whole observation as JSON; unset fields are left out."""
    fields = [F.col(c) for c in OBSERVATION_FIELDS if c in df.columns]
    return F.to_json(F.struct(*fields))


def route(df: DataFrame, with_content: bool = False, value: str = "value") -> DataFrame:
    """Add ``route``, ``attributes`` and ``content``.

    A failure keeps its input as content. A success carries the id and type
    as attributes and no content, or the observation with ``with_content``.
    An observation that still has no id is a failure.
    """
    if "observation_id" in df.columns:
        unresolved = F.col("observation_id") == UNRESOLVED_ID
        df = fail_where(df, unresolved, "unresolved")
    good = F.col("error_code").isNull()
    content = serialize_observation(df) if with_content else F.lit(None).cast("string")
    return (
        df.withColumn("route", F.when(good, ROUTE_SUCCESS).otherwise(ROUTE_FAILURE))
        .withColumn(
            "attributes",
            F.when(
                good,
                A.observation_attributes(F.col("observation_id"), F.col("observation_type")),
            ),
        )
        .withColumn("content", F.when(good, content).otherwise(F.col(value)))
    )


def route_documents(df: DataFrame) -> DataFrame:
    """Route enriched documents by their error; content is already set."""
    good = F.col("error_code").isNull()
    return df.withColumn("route", F.when(good, ROUTE_SUCCESS).otherwise(ROUTE_FAILURE))


def event_route(messages: DataFrame, payload_class: str = "Message", now_ms=None) -> DataFrame:
    """Messages raised during submission, as records of the events route."""
    events = to_events(filter_payload(messages, payload_class), now_ms)
    return events.withColumn("route", F.lit(ROUTE_EVENTS)).withColumnRenamed("payload", "content")


def all_routes(routed: DataFrame, events: DataFrame) -> DataFrame:
    """One table of outgoing records, to be written partitioned by route."""
    requests = routed.select(
        "route", "content", "attributes", "error_code", "error_detail"
    )
    return requests.unionByName(
        events.select("route", "content", "attributes"), allowMissingColumns=True
    )
