"""Requests as JSON documents, one per text row."""

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinflow.schemas import REQUEST, UNRESOLVED_ID

# What no document can hold: it is drawn anew by every process.
_MARK = f"m{secrets.token_hex(8)}"


def parse_object(value: Column, fields: T.StructType) -> Column:
    """One JSON text parsed once, for ``whole_object`` and ``is_whole``.

    The parser stops at the end of a value and would not see what follows. Here the text is the
    first item of an array and a mark is the second one, both under a key that a text cannot
    name: a text with anything after its value adds items, closes the array ahead of the mark or is
    an error.
    """
    item = T.StructType([*fields.fields, T.StructField(_MARK, T.StringType())])
    frame = [T.StructField(_MARK, T.ArrayType(item)), T.StructField("_corrupt", T.StringType())]
    text = F.concat(F.lit(f'{{"{_MARK}":['), value, F.lit(f',{{"{_MARK}":"end"}}]}}'))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    return F.from_json(text, T.StructType(frame), options)


def is_whole(doc: Column) -> Column:
    """The text was one JSON object with values of the right types."""
    items = doc[_MARK]
    mark = F.get(items, F.lit(1))[_MARK] == "end"
    good = doc["_corrupt"].isNull() & (F.size(items) == 2) & mark & F.get(items, F.lit(0)).isNotNull()
    return F.coalesce(good, F.lit(False))


def whole_object(doc: Column) -> Column:
    """The parsed object; look at ``is_whole`` first."""
    return F.get(doc[_MARK], F.lit(0))


def parse_requests(df: DataFrame, value: str = "value") -> DataFrame:
    """Documents to typed columns; unreadable ones are kept with ``malformed``.

    Other columns of ``df`` and the text itself stay, so a failure can be
    routed with its input.
    """
    return parse_with(df, value, REQUEST)


def parse_with(df: DataFrame, value: str, fields: T.StructType, *more: str) -> DataFrame:
    """``parse_requests`` of documents with further fields, which become columns ``more``."""
    doc = df.withColumn("_doc", parse_object(F.col(value), fields))
    doc = doc.withColumn("malformed", ~is_whole(F.col("_doc")))
    doc = doc.withColumn("_request", F.when(~F.col("malformed"), whole_object(F.col("_doc"))))
    further = [F.col("_request")[c].alias(c) for c in more]
    return doc.select(*df.columns, "malformed", *request_columns(F.col("_request")), *further)


def request_columns(request: Column) -> list[Column]:
    """The fields of a parsed request under the names the operators use."""
    # clients write the id under either key
    given_id = F.coalesce(request["observationId"], request["id"], F.lit(UNRESOLVED_ID))
    return [
        request["geometry"].alias("geometry"),
        request["name"].alias("name"),
        request["semantics"].alias("semantics"),
        request["digitalTwin"].alias("digital_twin"),
        given_id.alias("observation_id"),
    ]


def read_requests(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Batch scan: a document per line, or with ``multiline`` a document per file."""
    return parse_requests(spark.read.text(path, wholetext=multiline))


def stream_requests(
    spark: SparkSession, path: str, max_files: int | None = None, multiline: bool = False
) -> DataFrame:
    """Requests as they arrive in a landing folder, a document per line or,
    with ``multiline``, per file, as clients that indent their JSON send them."""
    reader = spark.readStream.format("text").option("wholetext", multiline)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_requests(reader.load(path))


def stream_requests_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Requests from a Kafka topic (needs the Kafka connector on the cluster)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
    )
    return parse_requests(reader.load().select(F.col("value").cast("string").alias("value")))


def with_request_ids(df: DataFrame, name: str = "request_id") -> DataFrame:
    """Unique bigint per row for inputs that bring none.

    The ids depend on how the input is split, so write the result
    (``session.staged``) before using it more than once.
    """
    return df.withColumn(name, F.monotonically_increasing_id())
