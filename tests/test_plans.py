"""What the plans have to look like to hold at scale."""

import pytest
from pyspark.sql import functions as F

from twinflow import schemas as S
from twinflow.operators import messages as M
from twinflow.operators.resolve import resolve_observables
from twinflow.operators.submit import submit_observations
from twinflow.plans import catalogue
from twinflow.plans import inputs as I
from twinflow.sources.requests import parse_requests

QUERIES = catalogue.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cross_join_and_no_row_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert ("ArrowEvalPython" in text) == (name in ("validate_coords", "build_requests"))
    assert "SinglePartition" not in text


@pytest.mark.parametrize(
    "name", ["parse_requests", "validate_requests", "validate_wkt", "relay_messages", "extract_urn", "build_observations"]
)
def test_row_operators_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan(QUERIES[name](spark, sf_dir))


def test_filters_and_columns_reach_the_scan(spark, sf_dir, tmp_path):
    I.messages(spark, sf_dir).write.parquet(str(tmp_path / "m"))
    m = spark.read.schema(S.MESSAGE).parquet(str(tmp_path / "m"))
    df = M.filter_messages(M.filter_queues(m), scopes=["dt-1"], since=5).select("message_id")
    text = plan(df)
    modes = spark._jvm.org.apache.spark.sql.execution.ExplainMode
    formatted = modes.fromString("formatted")
    pushed = df._jdf.queryExecution().explainString(formatted)
    pushed = pushed[pushed.index("PushedFilters") :]
    assert "In(queue, [Errors,Events,Status])" in pushed
    assert "EqualTo(scope_id,dt-1)" in pushed
    assert "GreaterThanOrEqual(timestamp,5)" in pushed
    assert "payload" not in text[text.index("ReadSchema") :].split("\n")[0]


def test_large_concept_table_is_not_broadcast(spark, sf_dir):
    requests = parse_requests(I.request_documents(spark, sf_dir))
    concepts = I.concepts(spark, sf_dir)
    assert "BroadcastHashJoin" in plan(resolve_observables(requests, concepts))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(resolve_observables(requests, concepts))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Broadcast" not in text and "SortMergeJoin" in text


def test_results_do_not_depend_on_the_join_strategy(spark, sf_dir):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    base = QUERIES["route_requests"](spark, sf_dir)
    want = sorted(map(repr, base.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted(map(repr, QUERIES["route_requests"](spark, sf_dir).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == want


def test_submission_carries_no_unused_payload(spark):
    """Counting outcomes must not move names and shapes through the shuffles."""
    obs = spark.range(10).select(
        F.col("id").alias("request_id"),
        F.lit("t").alias("digital_twin"),
        (F.col("id") % 3).alias("observation_id"),
        F.lit("a long name").alias("name"),
    )
    store = obs.select("digital_twin", "observation_id", "name").limit(0)
    text = submit_observations(obs, store).groupBy("outcome").count()
    assert "min_by" not in text._jdf.queryExecution().optimizedPlan().toString()


def test_a_key_of_many_requests_is_split_at_run_time(spark):
    """Over the broadcast threshold a third of all rows asks for one concept, a
    third for none."""
    semantics = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 900))
    requests = spark.range(0, 300_000, 1, 8).select(
        F.col("id").alias("request_id"), semantics.alias("semantics"), F.sha2(F.col("id").cast("string"), 512).alias("value")
    )
    keys = spark.range(0, 900).select(F.concat(F.lit("k"), "id").alias("urn")).unionByName(spark.sql("select 'hot' as urn"))
    concepts = keys.select(
        "urn", F.lit(1).alias("concept_id"), F.concat(F.lit("o:"), "urn").alias("observable_urn"),
        F.lit("SUBJECT").alias("observation_type"), F.lit(None).cast("string").alias("resource"),
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        df = resolve_observables(requests, concepts)
        rows = df._jdf.queryExecution()
        assert df.groupBy().agg(F.count("observable_urn"), F.count("value")).first() is not None
        assert len(df.toArrow()) == 300_000
        assert "skew=true" in rows.executedPlan().toString()
        assert df.where("observable_urn is not null").count() == 200_000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_twins_are_looked_up_before_requests_are_staged(spark, sf_dir):
    from twinflow.plans import catalogue, inputs, pipeline

    requests = catalogue._requests(spark, sf_dir)
    routed, _ = pipeline.run_scoped(
        requests, inputs.concepts(spark, sf_dir), inputs.store(spark, sf_dir), inputs.registry(spark, sf_dir), None
    )
    assert "region.parquet" not in str(routed.inputFiles())
