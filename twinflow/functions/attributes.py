"""String attributes that travel beside a record's content."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinflow.schemas import ATTRIBUTE_PREFIX


def string_map(**pairs: Column) -> Column:
    """``a__b=col`` becomes the entry ``a.b``; values are strings."""
    entries = []
    for key, value in pairs.items():
        entries += [F.lit(key.replace("__", ".")), value.cast("string")]
    return F.create_map(*entries)


def message_attributes() -> Column:
    """What a relayed message says about itself."""
    return string_map(
        message__type=F.col("type"),
        message__class=F.col("class"),
        message__queue=F.col("queue"),
        message__timestamp=F.col("timestamp"),
    )


def observation_attributes(observation_id: Column, observation_type: Column) -> Column:
    return string_map(observation__id=observation_id, observation__type=observation_type)


def with_event_time(attributes: Column, now_ms: Column | None = None) -> Column:
    """Add when the event was made here, as against when the message was sent."""
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    return F.map_concat(attributes, string_map(event__timestamp=now))


def urn_attribute(urn: Column, prefix: str = ATTRIBUTE_PREFIX) -> Column:
    return F.create_map(F.lit(f"{prefix}.urn"), urn)


def semantic_types(attributes: Column, prefix: str = ATTRIBUTE_PREFIX) -> Column:
    return F.try_element_at(attributes, F.lit(f"{prefix}.semanticTypes"))
