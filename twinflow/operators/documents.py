"""Operators on free JSON documents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinflow.schemas import REQUEST
from twinflow.sources.requests import is_whole, parse_object, parse_with, whole_object


_URN = T.StructType([T.StructField("urn", T.StringType())])
_RELAYED = T.StructType([*REQUEST.fields, T.StructField("observation", T.StringType())])


def extract_urn(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``urn`` and, where there is none, ``error_code``."""
    parsed = df.withColumn("_doc", parse_object(F.col(value), _URN))
    whole = is_whole(F.col("_doc"))
    parsed = parsed.withColumn("urn", F.when(whole, whole_object(F.col("_doc"))["urn"]))
    error = F.when(~whole, F.lit("malformed_json")).when(F.col("urn").isNull(), F.lit("missing_urn"))
    return parsed.withColumn("error_code", error).drop("_doc")


def add_observable(value: Column, observable: Column) -> Column:
    """The document with one more key, all others as they were.

    The key is put in front of the closing brace, so nested values need not
    be taken apart. ``value`` has to be one JSON object.
    """
    head = F.regexp_replace(value, r"\}\s*$", "")
    comma = F.when(value.rlike(r"^\s*+\{\s*+\}\s*+$"), F.lit("")).otherwise(F.lit(","))
    return F.concat(head, comma, F.lit('"observable":'), F.to_json(observable), F.lit("}"))


def split_observation(df: DataFrame, value: str = "value") -> DataFrame:
    """Take ``observation`` (JSON text) off a document; the rest is a request."""
    rest = parse_with(df, value, _RELAYED, "observation")
    return rest.withColumn("error_code", F.when(F.col("malformed"), F.lit("malformed_json")))
