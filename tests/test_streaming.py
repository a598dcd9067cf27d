import json

import pytest
from pyspark.sql import functions as F

from twinflow.operators import messages as M
from twinflow.operators import monitor
from twinflow.plans import inputs as I
from twinflow.plans.pipeline import check_relayed, run_relayed, run_requests
from twinflow.sources import messages as message_source
from twinflow.sources import requests as R
from twinflow.streaming import jobs, scopes


@pytest.fixture
def message_files(spark, sf_dir, tmp_path):
    path = str(tmp_path / "messages")
    I.messages(spark, sf_dir).repartitionByRange(5, "message_id").write.parquet(path)
    return path


def land(spark, sf_dir, path, lo, hi):
    rows = I.request_documents(spark, sf_dir).where(F.col("request_id").between(lo, hi))
    rows.coalesce(1).select("value").write.mode("append").text(path)


def table(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def test_relay_equals_batch_and_resumes(spark, message_files, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        source = message_source.stream_messages(spark, message_files, max_files=2)
        query = jobs.relay(source, out, check, once=True)
        query.awaitTermination()
        return spark.read.parquet(out)

    batch = M.relay_messages(message_source.read_messages(spark, message_files))
    assert table(run(), "message_id", "payload") == table(batch, "message_id", "payload")
    assert run().count() == batch.count()


def test_rates_equal_batch_for_closed_windows(spark, message_files, tmp_path):
    source = message_source.stream_messages(spark, message_files)
    jobs.rates(source, str(tmp_path / "o"), str(tmp_path / "c"), once=True).awaitTermination()
    read = message_source.read_messages(spark, message_files)
    end = read.agg(F.max("timestamp")).first()[0] - 600_000
    closed = monitor.message_rates(read).where(F.col("window_end") <= end)
    columns = ("window_start", "window_end", "queue", "type", "n")
    assert table(spark.read.parquet(str(tmp_path / "o")), *columns) == table(closed, *columns)


def test_fan_out_isolates_a_failing_listener(spark, message_files, tmp_path):
    def good(batch, batch_id):
        batch.write.mode("overwrite").parquet(str(tmp_path / "good" / f"batch_id={batch_id}"))

    def bad(batch, batch_id):
        raise RuntimeError("listener is broken")

    source = M.to_events(message_source.stream_messages(spark, message_files, max_files=2))
    streams = jobs.fan_out(source, {"bad": bad, "good": good}, str(tmp_path / "c"), once=True)
    failed = jobs.wait_all(streams)
    assert list(failed) == ["bad"] and "listener is broken" in failed["bad"]
    total = message_source.read_messages(spark, message_files).count()
    assert spark.read.parquet(str(tmp_path / "good")).count() == total


def test_register_survives_restart(spark, sf_dir, tmp_path):
    landing, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    known = I.registry(spark, sf_dir)

    def run():
        source = R.stream_requests(spark, landing)
        jobs.register(source, out, check, once=True).awaitTermination()
        return sorted(r.dt_url for r in jobs.read_registry(spark, out).collect())

    jobs.seed_registry(known, out)
    land(spark, sf_dir, landing, 0, 20)
    first = run()
    land(spark, sf_dir, landing, 21, 999)
    after = run()
    assert set(first) <= set(after) and len(after) == len(set(after))
    every = {r.digital_twin for r in R.read_requests(spark, landing).collect()} - {None, "", "not a url"}
    assert set(after) == every | {r.dt_url for r in known.collect()}
    assert run() == after


def submit_paths(tmp_path):
    return [str(tmp_path / n) for n in ("store", "out", "work")]


def test_submit_equals_batch(spark, sf_dir, tmp_path):
    """Each batch sees what the ones before it stored."""
    concepts, store = I.concepts(spark, sf_dir), I.store(spark, sf_dir)
    paths = submit_paths(tmp_path)
    jobs.seed_store(store, paths[0])
    step = jobs.submit_batch(concepts, *paths)
    requests = R.parse_requests(I.request_documents(spark, sf_dir))
    parts = [requests.where(F.col("request_id").between(i * 250, i * 250 + 249)) for i in range(4)]
    want = {}
    grown = store
    for i, part in enumerate(parts):
        step(part, i)
        batch = run_requests(part, concepts, grown)
        want.update({r.request_id: (r.outcome, r.observation_id, r.error_code) for r in batch.collect()})
        grown = jobs.read_store(spark, paths[0])
    out = jobs.read_outcomes(spark, paths[0])
    assert {r.request_id: (r.outcome, r.observation_id, r.error_code) for r in out.collect()} == want
    keys = grown.select("digital_twin", "observation_id")
    assert keys.count() == keys.distinct().count()

    # the same batch once more adds nothing
    before = table(out, "request_id", "outcome", "observation_id"), grown.count()
    step(parts[3], 3)
    again = jobs.read_outcomes(spark, paths[0])
    assert (table(again, "request_id", "outcome", "observation_id"), jobs.read_store(spark, paths[0]).count()) == before


def test_submit_stream_resumes(spark, sf_dir, tmp_path):
    landing, check = str(tmp_path / "in"), str(tmp_path / "check")
    concepts = I.concepts(spark, sf_dir)
    paths = submit_paths(tmp_path)
    jobs.seed_store(I.store(spark, sf_dir), paths[0])

    def run():
        source = R.stream_requests(spark, landing, max_files=1)
        jobs.submit(source, concepts, *paths, check, once=True).awaitTermination()
        return jobs.read_outcomes(spark, paths[0]).count(), jobs.read_store(spark, paths[0]).count()

    land(spark, sf_dir, landing, 0, 99)
    land(spark, sf_dir, landing, 100, 199)
    first = run()
    assert first[0] == 200
    assert run() == first
    land(spark, sf_dir, landing, 200, 249)
    assert run()[0] == 250


def test_requests_can_be_sent_as_a_stream(spark, sf_dir, tmp_path):
    landing, sent = str(tmp_path / "in"), str(tmp_path / "sent")
    land(spark, sf_dir, landing, 0, 49)
    good = R.stream_requests(spark, landing).where("not malformed")
    jobs.send_requests(good, sent, str(tmp_path / "c"), once=True).awaitTermination()
    there = R.read_requests(spark, sent)
    here = R.read_requests(spark, landing).where("not malformed")
    assert table(there, "name", "geometry", "observation_id") == table(here, "name", "geometry", "observation_id")
    assert json.loads(there.first().value)["observationId"] is not None


def test_observation_relay_as_a_stream(spark, sf_dir, tmp_path):
    landing, paths = str(tmp_path / "in"), submit_paths(tmp_path)
    I.relay_documents(spark, sf_dir).coalesce(1).write.parquet(landing)
    concepts, store = I.concepts(spark, sf_dir), I.store(spark, sf_dir)
    jobs.seed_store(store, paths[0])
    documents = spark.readStream.schema("request_id bigint, value string").parquet(landing)
    jobs.submit(
        documents, concepts, *paths, str(tmp_path / "check"), once=True,
        checker=check_relayed, with_content=True,
    ).awaitTermination()
    batch = run_relayed(I.relay_documents(spark, sf_dir), concepts, store)
    columns = ("request_id", "route", "error_code", "outcome", "observation_id", "content")
    assert table(jobs.read_outcomes(spark, paths[0]), *columns) == table(batch, *columns)


def test_counts_of_a_stream_lose_no_message(spark, message_files, tmp_path):
    """Untimed, late and open-window messages, over many batches, restarts and folds, equal the batch."""
    hard = F.expr("case when message_id % 9 = 0 then null when message_id % 7 = 0 then 253402300800000 else timestamp end")
    path, check = str(tmp_path / "rates"), str(tmp_path / "c")

    def run(source, **kw):
        source = source.withColumn("timestamp", hard)
        jobs.count_messages(source, path, check, once=True, **kw).awaitTermination()
        return table(jobs.read_rates(spark, path), *columns)

    columns = ("window_start", "window_end", "queue", "type", "n")
    source = message_source.stream_messages(spark, message_files, max_files=1)
    run(source, fold_every=2)
    late = message_source.read_messages(spark, message_files).where("message_id % 5 = 0").coalesce(1)
    late.write.mode("append").parquet(message_files)  # long after their windows
    got = run(source)
    whole = message_source.read_messages(spark, message_files).withColumn("timestamp", hard)
    assert got == table(monitor.message_rates(whole), *columns)
    assert run(source) == got
    rows = jobs.read_rates(spark, path)
    assert rows.agg(F.sum("n")).first()[0] == whole.count() and rows.where("window_start is null").count() > 0
    newest = rows.agg(F.max("window_start")).first()[0]
    closed = jobs.read_rates(spark, path, late_ms=3_600_000)
    assert table(closed, *columns) == table(rows.where(F.col("window_end") <= newest - 3_600_000), *columns)


@pytest.fixture
def keyed_state(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", scopes.PROVIDER)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_scopes_as_state(spark, sf_dir, tmp_path, keyed_state):
    """First one wins over restarts, and in a run with other partitions that starts from the registry."""
    landing, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    known = I.registry(spark, sf_dir)

    def run(registry, out, check):
        opened = scopes.opened_scopes(R.stream_requests(spark, landing), registry)
        jobs.write_stream(opened, out, check, once=True).awaitTermination()
        return spark.read.schema("dt_url string, scope_kind string, first_seen timestamp").parquet(out)

    land(spark, sf_dir, landing, 0, 20)
    first = table(run(known, out, check), "dt_url", "first_seen")
    land(spark, sf_dir, landing, 21, 399)
    after = run(known, out, check)
    assert set(first) <= set(table(after, "dt_url", "first_seen"))
    every = {r.digital_twin for r in R.read_requests(spark, landing).collect()} - {None, "", "not a url"}
    opened = [r.dt_url for r in after.collect()]
    assert sorted(opened) == sorted(every - {r.dt_url for r in known.collect()})
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        everything = after.unionByName(known, allowMissingColumns=True)
        land(spark, sf_dir, landing, 400, 999)
        more = run(everything, str(tmp_path / "out2"), str(tmp_path / "check2"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    every = {r.digital_twin for r in R.read_requests(spark, landing).collect()} - {None, "", "not a url"}
    assert {r.dt_url for r in more.collect()} == every - {r.dt_url for r in everything.collect()}
