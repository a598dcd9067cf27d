"""Steps count whole or not at all, wherever a run breaks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from twinflow.operators.submit import highest_ids
from twinflow.plans import inputs as I
from twinflow.session import staged
from twinflow.sources import requests as R
from twinflow.streaming import commits, jobs
from twinflow.streaming import store as folded_store

KEYS = ("digital_twin", "observation_id")


def land(spark, sf_dir, path, lo, hi):
    rows = I.request_documents(spark, sf_dir).where(F.col("request_id").between(lo, hi))
    rows.coalesce(1).select("value").write.mode("append").text(path)


class Places:
    def __init__(self, spark, sf_dir, tmp_path):
        self.spark, self.sf_dir, self.tmp = spark, sf_dir, tmp_path
        self.store, self.out, self.work = (str(tmp_path / n) for n in ("store", "out", "work"))
        jobs.seed_store(I.store(spark, sf_dir), self.store, I.registry(spark, sf_dir))

    def run(self, name, lo=None, hi=None, **kw):
        """A run of its own checkpoint on its own requests."""
        landing = str(self.tmp / f"in-{name}")
        if lo is not None:
            land(self.spark, self.sf_dir, landing, lo, hi)
        source = R.stream_requests(self.spark, landing)
        concepts, check = I.concepts(self.spark, self.sf_dir), str(self.tmp / f"check-{name}")
        jobs.submit(source, concepts, self.store, self.out, self.work, check, once=True, **kw).awaitTermination()

    def rows(self):
        return jobs.read_store(self.spark, self.store)

    def assert_sound(self, n):
        rows = self.rows().select(*KEYS)
        assert rows.count() == rows.distinct().count()
        outcomes = jobs.read_outcomes(self.spark, self.store)
        assert outcomes.count() == n
        new = outcomes.where("outcome in ('resolved', 'accepted')").select(*KEYS)
        assert new.count() == new.distinct().count()
        assert new.join(rows, list(KEYS), "left_anti").count() == 0
        twins = jobs.read_registry(self.spark, self.store)
        assert twins.count() == twins.select("dt_url").distinct().count()
        heads = commits.read(self.spark, commits.state(self.spark, self.store), "heads", jobs._HEADS)
        heads = heads.groupBy("digital_twin").agg(F.max("start").alias("start"))
        want = highest_ids(self.rows())
        assert sorted(map(tuple, heads.collect())) == sorted(map(tuple, want.collect()))


@pytest.fixture
def places(spark, sf_dir, tmp_path):
    return Places(spark, sf_dir, tmp_path)


def broken_after(monkeypatch, writes):
    """The ``writes``-th table written ends the run right after it."""
    real, count = DataFrameWriter.parquet, []

    def parquet(self, *a, **kw):
        real(self, *a, **kw)
        count.append(a)
        if len(count) == writes:
            raise RuntimeError("broken on purpose")

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)


def test_a_run_that_breaks_after_any_write(places, monkeypatch):
    spark = places.spark

    def step(run, lo, hi):
        """A batch in a new process of the run."""
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", run)
        rows = I.request_documents(spark, places.sf_dir).where(F.col("request_id").between(lo, hi))
        concepts = I.concepts(spark, places.sf_dir)
        jobs.submit_batch(concepts, places.store, places.out, places.work)(R.parse_requests(rows), 0)

    def seen():
        now = commits.state(spark, places.store)
        return now.folders, now.done

    try:
        before = seen()
        for writes in range(1, 6):
            with monkeypatch.context() as patch:
                broken_after(patch, writes)
                with pytest.raises(RuntimeError, match="broken on purpose"):
                    step("broken", 0, 79)
            assert seen() == before
        step("next", 80, 139)  # a new checkpoint goes on
        places.assert_sound(60)
        step("broken", 0, 79)  # and the broken one, from its own checkpoint
        step("broken", 0, 79)
        places.assert_sound(140)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    tables = [f"{places.store}/{t}" for t in ("rows", "heads", "registry")]
    assert commits.sweep(spark, places.store, [*tables, places.out]) == 4 + 3 + 2 + 1
    places.assert_sound(140)


def test_a_stream_that_breaks_between_rows_and_heads(places, monkeypatch):
    with monkeypatch.context() as patch:
        broken_after(patch, 3)
        with pytest.raises(Exception, match="broken on purpose"):
            places.run("broken", 0, 59)
    places.run("next", 60, 99)
    places.assert_sound(40)
    places.run("broken")
    places.assert_sound(100)


def test_a_run_that_breaks_after_the_manifest(places, monkeypatch):
    real = commits.Writer.commit

    def commit(self, *a, **kw):
        real(self, *a, **kw)
        raise RuntimeError("broken on purpose")

    with monkeypatch.context() as patch:
        patch.setattr(commits.Writer, "commit", commit)
        with pytest.raises(Exception, match="broken on purpose"):
            places.run("broken", 0, 59)
    places.assert_sound(60)
    places.run("broken")  # its batch is there already
    places.assert_sound(60)


def test_an_older_writer_is_fenced(places):
    spark = places.spark
    old, new = commits.Writer(places.store), commits.Writer(places.store)
    old.open(spark)
    new.open(spark)
    with pytest.raises(commits.Fenced):
        old.commit(spark, {}, "old", 0)
    assert new.commit(spark, {}, "new", 0) and not new.commit(spark, {}, "new", 0)
    old.opened = None  # the older one starts again
    old.open(spark)
    assert old.commit(spark, {}, "old", 0)
    with pytest.raises(commits.Fenced):
        new.commit(spark, {}, "new", 1)


def test_one_version_is_put_down_once(spark, tmp_path):
    root = str(tmp_path / "t")
    assert commits._put(spark, root, {"version": 0, "kind": "open"})
    assert not commits._put(spark, root, {"version": 0, "kind": "open"})
    assert commits.state(spark, root).version == 0
    assert commits.state(spark, str(tmp_path / "nothing")) == commits.State()


def test_closed_registry(places):
    places.run("closed", 0, 199, scope_kind=None)
    places.assert_sound(200)
    known = {r.dt_url for r in I.registry(places.spark, places.sf_dir).collect()}
    out = jobs.read_outcomes(places.spark, places.store)
    assert {r.digital_twin for r in out.where("outcome is not null").collect()} <= known
    assert out.where("error_code = 'unknown_twin'").count() > 0
    assert {r.dt_url for r in jobs.read_registry(places.spark, places.store).collect()} == known


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_rows(df):
    """Rows that the scans of an executed plan gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.finalPhysicalPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.length()))


def test_folded_store(places, monkeypatch):
    spark = places.spark
    whole = sorted(map(repr, places.rows().collect()))
    places.run("a", 0, 99, fold_every=1)
    grown = sorted(map(repr, places.rows().collect()))
    assert set(whole) < set(grown) and commits.state(spark, places.store).folders["rows"] == []
    places.assert_sound(100)
    places.run("b", 100, 199)
    places.assert_sound(200)

    concepts = I.concepts(spark, places.sf_dir)
    requests = R.parse_requests(I.request_documents(spark, places.sf_dir)).where("request_id >= 700")
    checked = staged(jobs.check_requests(requests, concepts), "checked")
    rows = staged(places.rows(), "rows")
    columns = ("request_id", "outcome", "observation_id", "error_code")
    want = sorted(map(repr, jobs.submit_checked(checked, rows).select(*columns).collect()))
    now = commits.state(spark, places.store)
    for few in (1000, 0):  # named hashes, then the join by buckets
        monkeypatch.setattr(folded_store, "FEW", few)
        got = jobs.submit_checked(checked, rows, find=lambda keys: folded_store.matching(spark, now, keys))
        assert sorted(map(repr, got.select(*columns).collect())) == want
    assert commits.sweep(spark, places.store, [f"{places.store}/rows"]) > 0
    places.assert_sound(200)


def test_a_small_batch_skips_files_and_a_large_one_moves_only_itself(places, monkeypatch):
    spark = places.spark
    jobs.fold(spark, places.store)
    folder = commits.state(spark, places.store).folders["folded"][0]
    now = commits.State(folders={"folded": [folder]})
    keys = spark.createDataFrame([("https://twins.example.org/dt/1", 1)], "digital_twin string, observation_id long")
    small = folded_store.matching(spark, now, keys)
    assert "PushedFilters: [IsNotNull(key_hash), EqualTo(key_hash" in plan_of(small)
    assert 4 * scanned_rows(small) <= 2 * places.rows().count()
    monkeypatch.setattr(folded_store, "FEW", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = staged(places.rows().select(*KEYS), "keys")
        joined = plan_of(folded_store.matching(spark, now, many)).split("LeftSemi")[-1]
        store_side = joined[: joined.index("folded_")]
        assert "Exchange" not in store_side and "Bucketed: true" in joined
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
