"""Semantics and URNs against the concept table.

Lookups are plain left joins without a hint. Spark compares the concept table
with its broadcast threshold: under it the join needs no shuffle; over it both
sides are shuffled and a key that many requests share is split at run time
(``spark.sql.adaptive.skewJoin``). Concepts are unique by ``urn``.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinflow.operators.documents import add_observable, extract_urn
from twinflow.operators.validate import fail_where


def resolve_observables(
    requests: DataFrame, concepts: DataFrame, brought: str | None = None
) -> DataFrame:
    """Add the observable of each request's semantics; unknown ones fail.

    ``brought`` names a column with an observable as JSON that comes with the
    record; where there is one it is used instead of the looked-up one.
    """
    found = concepts.select(
        F.col("urn").alias("semantics"), "concept_id", "observable_urn", "observation_type"
    )
    joined = requests.join(found, "semantics", "left")
    if brought is not None:
        for column, path in (("observable_urn", "$.urn"), ("observation_type", "$.type")):
            own = F.get_json_object(brought, path)
            joined = joined.withColumn(column, F.coalesce(own, F.col(column)))
    return fail_where(joined, F.col("observable_urn").isNull(), "unknown_semantics")


def resolve_urns(documents: DataFrame, concepts: DataFrame, value: str = "value") -> DataFrame:
    """Resolve each document's URN as resource, concept and observable at once
    and write the observable into the document."""
    found = concepts.select(
        "urn",
        F.col("resource").alias("resource_urn"),
        "concept_id",
        "observable_urn",
        "observation_type",
    )
    joined = extract_urn(documents, value).join(found, "urn", "left")
    known = F.col("observable_urn").isNotNull()
    error = F.coalesce(
        F.col("error_code"), F.when(~known, F.lit("unknown_semantics"))
    )
    observable = F.struct(
        F.col("observable_urn").alias("urn"),
        F.col("concept_id").alias("id"),
        F.col("observation_type").alias("type"),
    )
    return joined.withColumn("error_code", error).withColumn(
        "content",
        F.when(F.col("error_code").isNull(), add_observable(F.col(value), observable)).otherwise(
            F.col(value)
        ),
    )
