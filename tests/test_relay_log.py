import pytest
from pyspark.sql import functions as F

from twinflow.operators import messages as M
from twinflow.operators import monitor
from twinflow.plans import inputs as I
from twinflow.sources import messages as source
from twinflow.streaming import relay_log


@pytest.fixture
def log(spark, sf_dir, tmp_path):
    """A log of three steps: JSON records, some unreadable, read once."""
    landing, path = str(tmp_path / "in"), str(tmp_path / "log")
    rows = I.messages(spark, sf_dir).where("message_id < 300")
    text = rows.select(F.to_json(F.struct("*")).alias("value"), "message_id")
    text = text.withColumn("value", F.when(F.col("message_id") % 50 == 0, F.concat("value", F.lit(" x}"))).otherwise(F.col("value")))
    text.repartitionByRange(3, "message_id").select("value").write.text(landing)
    stream = source.parse_messages(spark.readStream.option("maxFilesPerTrigger", 1).text(landing))
    for _ in range(2):  # the second run finds nothing new
        relay_log.relay(stream, path, str(tmp_path / "check"), once=True).awaitTermination()
    return path


def kept(spark, sf_dir):
    rows = I.messages(spark, sf_dir).where("message_id < 300 and message_id % 50 > 0")
    return sorted(r.message_id for r in M.relay_messages(rows).collect())


def test_a_poisoned_message_stops_nobody_for_good(spark, sf_dir, log):
    given = {"good": {}, "bad": {}}
    poisoned = kept(spark, sf_dir)[10]

    def good(events, step, part):
        given["good"][step, part] = [r.message_id for r in events.collect()]

    def bad(events, step, part):
        rows = [r.message_id for r in events.collect()]
        if poisoned in rows:
            raise RuntimeError("poisoned")
        given["bad"][step, part] = rows

    assert relay_log.deliver(spark, log, "good", good) == 3
    assert relay_log.deliver(spark, log, "bad", bad, attempts=2) == 3
    for name, lost in (("good", []), ("bad", [poisoned])):
        assert sorted(sum(given[name].values(), [])) == sorted(set(kept(spark, sf_dir)) - set(lost))
        assert [r.message_id for r in relay_log.dead_letters(spark, log, name).collect()] == lost
        assert relay_log.deliver(spark, log, name, bad) == 0  # nothing is given twice
    failures = relay_log.read_failures(spark, log)
    assert failures.count() == 6 and {r.error_code for r in failures.collect()} == {"malformed_json"}


def test_attempts_outlive_a_listener_that_dies(spark, log):
    calls = []

    def dies(events, step, part):
        calls.append((step, part))
        raise KeyboardInterrupt

    for _ in range(2):
        with pytest.raises(KeyboardInterrupt):
            relay_log.deliver(spark, log, "l", dies, attempts=2)
    seen = []
    assert relay_log.deliver(spark, log, "l", lambda e, s, p: seen.append((s, p)), attempts=2) == 3
    assert {p for s, p in seen if s == calls[0][0]} == {"0-of-2", "1-of-2"}  # its attempts were used up


def test_merged_summaries(spark):
    rows = spark.range(60_000).selectExpr(
        "concat('t', id % 3) as digital_twin", "if(id % 2 = 0, 'existing', null) as outcome", "'S' as observation_type",
        "cast(null as string) as error_code", "if(id % 11 = 0, null, id % 9000) as observation_id", "id % 5 as part",
    )
    parts = monitor.summary_sketches(rows.where("part = 0"))
    for i in range(1, 5):
        parts = parts.unionByName(monitor.summary_sketches(rows.where(f"part = {i}")))
    got = {tuple(r)[:4]: r for r in monitor.summary_estimates(monitor.merged_summaries(parts)).collect()}
    want = {tuple(r)[:4]: r for r in monitor.twin_summary(rows).collect()}
    assert set(got) == set(want) and len(want) == 6
    for key, row in want.items():
        assert got[key].n == row.n
        assert abs(got[key].n_observations - row.n_observations) <= 0.06 * row.n_observations
