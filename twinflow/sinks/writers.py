"""Writers of requests, routed records and events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinflow.schemas import UNRESOLVED_ID


def request_json(id_key: str = "observationId") -> Column:
    """A request in wire form; unset fields are left out."""
    return F.to_json(
        F.struct(
            F.col("geometry").alias("geometry"),
            F.col("name").alias("name"),
            F.col("semantics").alias("semantics"),
            F.col("digital_twin").alias("digitalTwin"),
            F.coalesce(F.col("observation_id"), F.lit(UNRESOLVED_ID)).alias(id_key),
        )
    )


def request_payloads(df: DataFrame, id_key: str = "observationId") -> DataFrame:
    """Add ``value``, the JSON document of each request."""
    return df.withColumn("value", request_json(id_key))


def write_requests(df: DataFrame, path: str, id_key: str = "observationId") -> None:
    """One document per line, for ``sources.requests`` to read or stream."""
    request_payloads(df, id_key).select("value").write.mode("append").text(path)


def write_requests_topic(df: DataFrame, servers: str, topic: str) -> None:
    """One record per request on a Kafka topic (needs the Kafka connector)."""
    (
        request_payloads(df)
        .select(F.col("digital_twin").alias("key"), "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def write_routed(df: DataFrame, path: str, mode: str = "append") -> None:
    """All routes in one pass, one folder per route."""
    df.write.mode(mode).partitionBy("route").parquet(path)


def write_events(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).parquet(path)


def headers(attributes: Column) -> Column:
    """Attributes as Kafka headers."""
    return F.transform(
        F.map_entries(attributes),
        lambda e: F.struct(e["key"].alias("key"), F.encode(e["value"], "UTF-8").alias("value")),
    )


def write_events_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Payload as value, attributes as headers (needs the Kafka connector)."""
    (
        df.select(F.col("payload").alias("value"), headers(F.col("attributes")).alias("headers"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("includeHeaders", "true")
        .option("topic", topic)
        .save()
    )
