"""Platform messages from files or a topic."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinflow.schemas import MESSAGE, ROUTE_FAILURE
from twinflow.sources.requests import is_whole, parse_object, whole_object


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE).parquet(path)


def stream_messages(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Messages as files of ``fmt`` arrive; pass on to ``operators.messages``."""
    reader = spark.readStream.schema(MESSAGE).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_messages_topic(spark: SparkSession, servers: str, topics: str, **options) -> DataFrame:
    """Messages from Kafka, JSON encoded (needs the Kafka connector on the cluster)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .options(**options)
    )
    return parse_messages(reader.load().select(F.col("value").cast("string").alias("value")))


def parse_messages(df: DataFrame) -> DataFrame:
    """JSON texts to messages; unreadable ones are kept, with ``malformed``.

    No queue holds those: take them aside with ``malformed_messages`` before a
    filter on queues drops them.
    """
    parsed = df.withColumn("_doc", parse_object(F.col("value"), MESSAGE))
    parsed = parsed.withColumn("m", F.when(is_whole(F.col("_doc")), whole_object(F.col("_doc"))))
    fields = [F.col("m")[f].alias(f) for f in MESSAGE.fieldNames()]
    return parsed.select(*fields, "value", F.col("m.message_id").isNull().alias("malformed"))


def malformed_messages(df: DataFrame) -> DataFrame:
    """Records of the failure route for what ``parse_messages`` couldn't read."""
    return df.where("malformed").select(
        F.lit(ROUTE_FAILURE).alias("route"),
        F.col("value").alias("content"),
        F.lit("malformed_json").alias("error_code"),
    )
