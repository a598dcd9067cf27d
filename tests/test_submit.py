import random

import pytest
from pyspark.sql import functions as F

from twinflow import schemas as S
from twinflow.operators import submit as U
from twinflow.operators.ranking import rank_in_group

OBS = "request_id bigint, digital_twin string, observation_id bigint, name string, urn string, observation_type string"


def with_geometry(df):
    return df.withColumn("geometry", F.lit(None).cast(S.GEOMETRY))


def store_of(spark, rows):
    return with_geometry(
        spark.createDataFrame(rows, "digital_twin string, observation_id bigint, name string, urn string, observation_type string")
    )


def expected(requests, store):
    """One request after the other, as a single writer would do it."""
    have = {(t, i): (n, u, o) for t, i, n, u, o in store}
    top = {}
    for t, i, *_ in store:
        top[t] = max(top.get(t, 0), i)
    for _, t, i, *_ in requests:
        if i != -1:
            top[t] = max(top.get(t, 0), i)
    out, seen = {}, {}
    for rid, t, i, *rest in sorted(requests):
        if i == -1:
            top[t] = top.get(t, 0) + 1
            out[rid] = ("resolved", top[t], *rest)
        elif (t, i) in have:
            out[rid] = ("existing", i, *have[(t, i)])
        elif (t, i) in seen:
            out[rid] = ("existing", i, *seen[(t, i)])
        else:
            seen[(t, i)] = tuple(rest)
            out[rid] = ("accepted", i, *rest)
    return out


def result(df):
    return {
        r.request_id: (r.outcome, r.observation_id, r.name, r.urn, r.observation_type)
        for r in df.collect()
    }


def random_case(seed, n, hot):
    rng = random.Random(seed)
    ids = rng.sample(range(-(2**40), 2**40), n)  # far apart: many blocks
    requests = []
    for rid in ids:
        twin = "a" if rng.random() < hot else rng.choice("bcd")
        kind = rng.random()
        obs = -1 if kind < 0.3 else 5 if kind < 0.3 + hot / 2 else rng.randrange(60)
        requests.append((rid, twin, obs, rng.choice([None, f"n{rid}"]), f"u{rid}", rng.choice("SQ")))
    stored = {(rng.choice("abcde"), rng.randrange(80)) for _ in range(60)} - {("a", 5)}
    store = [(t, i, f"s{t}{i}", None, "P") for t, i in stored]
    return requests, store


@pytest.mark.parametrize("seed, hot", [(1, 0.3), (2, 0.9)])
def test_against_one_by_one(spark, seed, hot):
    requests, store = random_case(seed, 600, hot)
    obs = with_geometry(spark.createDataFrame(requests, OBS))
    got = result(U.submit_observations(obs, store_of(spark, store)))
    assert got == expected(requests, store)


def test_submitting_again_changes_nothing(spark):
    requests, store = random_case(3, 200, 0.5)
    obs = with_geometry(spark.createDataFrame(requests, OBS))
    stored = store_of(spark, store)
    first = U.submit_observations(obs, stored)
    grown = stored.unionByName(U.stored_rows(first, stored))
    assert grown.count() == grown.select("digital_twin", "observation_id").distinct().count()
    again = U.submit_observations(first.drop("outcome"), grown)
    assert {r.outcome for r in again.collect()} == {"existing"}
    assert {k: v[1:] for k, v in result(again).items()} == {k: v[1:] for k, v in result(first).items()}


def test_rows_without_twin_or_id_are_kept(spark):
    rows = [(1, None, 4, "n", "u", "S"), (2, None, None, "n", "u", "S"), (3, "t", None, "n", "u", "S")]
    obs = with_geometry(spark.createDataFrame(rows, OBS))
    got = result(U.submit_observations(obs, store_of(spark, [])))
    assert {k: v[:2] for k, v in got.items()} == {1: ("accepted", 4), 2: ("resolved", 5), 3: ("resolved", 1)}


def test_ranks_have_no_gaps_over_many_blocks(spark):
    rng = random.Random(5)
    orders = [rng.randrange(-(2**62), 2**62) for _ in range(300)] + list(range(2**18 - 50, 2**18 + 50)) + list(range(2**40 - 50, 2**40 + 50))
    rows = [(o, "hot" if i % 3 else "cold") for i, o in enumerate(orders)]
    df = spark.createDataFrame(rows, "o bigint, g string")
    got = {(r.g, r.o): r["rank"] for r in rank_in_group(df, "g", "o").collect()}
    for g in ("hot", "cold"):
        inside = sorted(o for o, h in rows if h == g)
        assert [got[(g, o)] for o in inside] == list(range(1, len(inside) + 1))


def test_one_id_in_every_request(spark):
    obs = with_geometry(
        spark.range(0, 20000).selectExpr(
            "id as request_id", "'a' as digital_twin", "7L as observation_id",
            "concat('n', id) as name", "'u' as urn", "'S' as observation_type",
        )
    )
    out = U.submit_observations(obs, store_of(spark, []))
    counts = {r.outcome: (r.n, r.names) for r in out.groupBy("outcome").agg(F.count("*").alias("n"), F.countDistinct("name").alias("names")).collect()}
    assert counts == {"accepted": (1, 1), "existing": (19999, 1)}
    assert out.where("name <> 'n0'").count() == 0
    # no step may see all of them as one group: the join keys carry the salt
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan


REGISTRY = "dt_url string, scope_kind string"


U1, U2, U3 = (f"https://h.org/u{i}" for i in (1, 2, 3))


def test_registry(spark):
    known = spark.createDataFrame([(U1, "context"), (U2, "context")], REGISTRY)
    rows = spark.createDataFrame([(U1,), (U3,), (U3,), ("",), (None,)], "digital_twin string")
    assert [r.digital_twin for r in U.known_twins(rows, known).collect()] == [U1]
    assert [r.dt_url for r in U.new_twins(rows, known).collect()] == [U3]
    flags = sorted((r.digital_twin or "", r.known) for r in U.contains_twin(rows, known).collect())
    assert flags == [("", False), ("", False), (U1, True), (U3, False), (U3, False)]
    scopes = sorted(map(str, [(r.digital_twin, r.scope_kind) for r in U.lookup_scope(rows, known, "user").collect()]))
    assert scopes == sorted(map(str, [(U1, "context"), (U3, None), (U3, None), ("", "user"), (None, "user")]))
    after = U.register_twins(rows, known)
    assert sorted(tuple(r) for r in after.collect()) == [(U1, "context"), (U2, "context"), (U3, "user")]
    assert U.register_twins(rows, after).count() == 3
    timed = known.withColumn("first_seen", F.lit(None).cast("timestamp"))
    assert U.register_twins(rows, timed).where("first_seen is not null").count() == 1
