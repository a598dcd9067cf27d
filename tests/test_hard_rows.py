"""Rows and restarts that must neither end a job nor lose what others left."""

import json

import pytest
from pyspark.sql import functions as F

from twinflow.operators import submit
from twinflow import schemas as S
from twinflow.operators import documents as D
from twinflow.operators import messages as M
from twinflow.operators import monitor
from twinflow.operators.submit import stored_rows, submit_observations
from twinflow.plans import inputs as I
from twinflow.plans.pipeline import submit_checked
from twinflow.sources import messages as message_source
from twinflow.sources import requests as R
from twinflow.sources.builder import build_requests
from twinflow.streaming import jobs

NO_DOCUMENTS = [
    '{"name":"a","semantics":"s"},"zz":{}',
    '{"name":"a"},"request":{"name":"b"}',
    '{"urn":"a:B"},"x":1',
    '{"urn":"a:B"},"end":1} and more',
    '{"urn":"a:B"}] and more',
    '{"urn":"a:B"}],"x":[1',
    '{"urn":"a:B"}]}',
    '{"urn":"a:B"},',
    '[{"urn":"a:B"}]',
    "5",
    "null",
    '{"urn":"a:B","name":"x',
    '{"urn":"a:B"},{"urn":"a:C"}',
    '{"urn":"a:B"',
    "",
    None,
]


@pytest.mark.parametrize("text", NO_DOCUMENTS)
def test_text_around_a_document_is_malformed(spark, text):
    df = spark.createDataFrame([(text,)], "value string")
    assert R.parse_requests(df).first().malformed
    assert D.extract_urn(df).first().error_code == "malformed_json"
    assert D.split_observation(df).first().error_code == "malformed_json"


def test_indented_documents_arrive_whole(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    for i in range(3):
        (landing / f"{i}.json").write_text(json.dumps({"name": f"n{i}", "semantics": "s"}, indent=2))
    rows = R.stream_requests(spark, str(landing), multiline=True).select("malformed", "name")
    jobs.write_stream(rows, out, str(tmp_path / "check"), once=True).awaitTermination()
    got = spark.read.parquet(out).collect()
    assert sorted(r.name for r in got) == ["n0", "n1", "n2"] and not any(r.malformed for r in got)


def observations(spark, rows):
    fields = "request_id long, digital_twin string, observation_id long, name string, urn string, observation_type string"
    return spark.createDataFrame([(*r, "n", "u", "SUBJECT") for r in rows], fields).withColumn(
        "geometry", F.lit(None).cast(S.GEOMETRY)
    )


def test_a_twin_without_ids_left_fails_its_rows_alone(spark):
    largest = 2**63 - 1
    rows = observations(spark, [(1, "t", largest), (2, "t", -1), (3, "u", -1), (4, "v", largest - 1), (5, "v", -1), (6, "v", -1)])
    store = observations(spark, []).drop("request_id")
    got = {r.request_id: (r.observation_id, r.outcome) for r in submit_observations(rows, store).collect()}
    assert got[1] == (largest, "accepted") and got[3] == (1, "resolved")
    assert got[2] == (-1, None) and got[5] == (largest, "resolved") and got[6] == (-1, None)
    assert stored_rows(submit_observations(rows, store), store).where("observation_id = -1").isEmpty()

    errors = ("malformed_json", "error_detail")
    checked = rows.withColumns({c: F.lit(None).cast("string") for c in ("error_code", errors[1])})
    routed = submit_checked(checked.withColumn("value", F.lit("{}")), store).collect()
    failed = {r.request_id: (r.error_code, r.content) for r in routed if r.route == S.ROUTE_FAILURE}
    assert failed == {2: ("unresolved", "{}"), 6: ("unresolved", "{}")}


def messages(spark, times):
    return spark.createDataFrame(
        [(i, "t", "Runtime", "Events", ms, "s", "{}", "Message") for i, ms in enumerate(times)], S.MESSAGE
    )


def test_times_out_of_the_calendar(spark):
    df = messages(spark, [0, 1_700_000_000_000_000_000, None, 3_600_000])
    relayed = {r.message_id: r.event_ts for r in M.relay_messages(df, ["Events"]).collect()}
    assert len(relayed) == 4 and relayed[1] is None and relayed[2] is None and relayed[0] is not None
    counted = {r.window_start: r.n for r in monitor.message_rates(df).collect()}
    assert counted == {0: 1, 3_600_000: 1, None: 2}


def test_unreadable_topic_records_are_kept(spark):
    good = '{"message_id":1,"queue":"Events","timestamp":5}'
    df = spark.createDataFrame([(good,), ("{bad",), (None,), (good + ',"x":1',)], "value string")
    read = message_source.parse_messages(df)
    assert [r.message_id for r in read.where("not malformed").collect()] == [1]
    failed = message_source.malformed_messages(read).collect()
    assert sorted(str(r.content) for r in failed) == sorted(["{bad", "None", good + ',"x":1'])
    assert {r.route for r in failed} == {S.ROUTE_FAILURE}


def test_text_that_is_no_time(spark):
    parts = spark.createDataFrame(
        [("a", "s:S", "POINT(1 1)", "x", "5"), ("b", "s:S", "POINT(1 1)", "1", "5")],
        "name string, semantics string, wkt string, tstart string, tend string",
    )
    got = {r.name: r.error_code for r in build_requests(parts).collect()}
    assert got == {"a": "bad_time", "b": None}


def landed(spark, sf_dir, path, lo, hi):
    rows = I.request_documents(spark, sf_dir).where(F.col("request_id").between(lo, hi))
    rows.coalesce(1).select("value").write.mode("append").text(path)


def test_a_new_checkpoint_keeps_what_others_stored(spark, sf_dir, tmp_path):
    store, out, work = (str(tmp_path / n) for n in ("store", "out", "work"))
    jobs.seed_store(I.store(spark, sf_dir), store)
    keys = ["digital_twin", "observation_id", "name"]
    kept = []
    for number, (lo, hi) in enumerate([(0, 99), (100, 199)]):
        landing = str(tmp_path / f"in{number}")
        landed(spark, sf_dir, landing, lo, hi)
        source = R.stream_requests(spark, landing)
        jobs.submit(
            source, I.concepts(spark, sf_dir), store, out, work, str(tmp_path / f"check{number}"), once=True
        ).awaitTermination()
        kept.append({tuple(r) for r in jobs.read_store(spark, store).select(*keys).collect()})
    assert kept[0] < kept[1]
    assert len({k[:2] for k in kept[1]}) == len(kept[1])
    assert jobs.read_outcomes(spark, store).count() == 200


def test_a_new_checkpoint_keeps_registered_twins(spark, sf_dir, tmp_path):
    path = str(tmp_path / "registry")
    jobs.seed_registry(I.registry(spark, sf_dir), path)
    seen = []
    for number in range(2):
        landing = str(tmp_path / f"in{number}")
        landed(spark, sf_dir, landing, number * 100, number * 100 + 99)
        source = R.stream_requests(spark, landing)
        jobs.register(source, path, str(tmp_path / f"check{number}"), once=True).awaitTermination()
        seen.append([r.dt_url for r in jobs.read_registry(spark, path).collect()])
    assert set(seen[0]) <= set(seen[1]) and len(seen[1]) == len(set(seen[1]))


def test_the_first_failure_is_seen_beside_an_endless_stream(spark, sf_dir, tmp_path):
    path = str(tmp_path / "m")
    I.messages(spark, sf_dir).write.parquet(path)

    def bad(batch, batch_id):
        raise RuntimeError("broken")

    def good(batch, batch_id):
        pass

    source = message_source.stream_messages(spark, path)
    streams = jobs.fan_out(source, {"good": good, "bad": bad}, str(tmp_path / "c"), every="1 second")
    try:
        assert list(jobs.wait_all(streams, until_failure=True)) == ["bad"]
    finally:
        streams["good"].stop()


def test_whole_rows_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    """More rows make more tasks, not larger ones; what is submitted stays the same."""
    fields = "request_id long, digital_twin string, observation_id long, name string"
    rows = [(i << 18 if i % 7 else i, f"dt{i % 3}", -1 if i % 4 else i % 90, f"n{i}") for i in range(4000)]
    rows += [(-i, None, None if i % 2 else 5, None) for i in range(1, 200)]
    spark.createDataFrame(rows, fields).write.parquet(str(tmp_path / "rows"))
    written = spark.read.parquet(str(tmp_path / "rows"))
    store = spark.createDataFrame([("dt0", 12, "old"), ("dt1", 999, None)], "digital_twin string, observation_id long, name string")
    assert submit.parts_of(written) is None
    want = sorted(map(repr, submit.submit_observations(written, store).collect()))
    monkeypatch.setattr(submit, "_A_PART", 200)
    got = submit.submit_observations(written, store, parts=submit.parts_of(written))
    # a file for each task, with all columns; so few rows would be broadcast
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        got.write.parquet(str(tmp_path / "got"))
    finally:
        spark.conf.set(threshold, before)
    got = spark.read.schema(got.schema).parquet(str(tmp_path / "got"))
    assert sorted(map(repr, got.collect())) == want
    assert got.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] < len(rows) // 4
