import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from twinflow import schemas as S
from twinflow.operators.validate import PLACES, request_rules, validate_requests
from twinflow.plans.pipeline import check_requests, run_requests, submit_checked
from twinflow.sinks import writers
from twinflow.sources import requests as R

TWIN = "https://twins.example.org/dt/A.1"
SPACE = {"shape": "EPSG:4326 " + S.CONTEXT_SHAPE, "sgrid": "1.km", "proj": "EPSG:4326"}
TIME = {"tstart": 1325376000000, "tend": 1356998400000, "tunit": "year", "tscope": 1}
CONTEXT = {
    "geometry": {"space": SPACE, "time": TIME},
    "name": "example",
    "semantics": "earth:Terrestrial earth:Region",
    "digitalTwin": TWIN,
    "observationId": -1,
}
PLAIN = {"name": "example", "semantics": "geography:Elevation", "digitalTwin": TWIN, "observationId": 123456789}


def frame(spark, documents):
    texts = [(i, d if d is None or isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    return R.parse_requests(spark.createDataFrame(texts, "request_id bigint, value string"))


def errors(spark, documents, profile="strict", require_twin=True):
    checked = validate_requests(frame(spark, documents), profile, require_twin)
    return [r.error_code for r in checked.orderBy("request_id").collect()]


def change(**kw):
    return {k: v for k, v in {**CONTEXT, **kw}.items() if v is not ...}


def space(**kw):
    return change(geometry={"space": {k: v for k, v in {**SPACE, **kw}.items() if v is not ...}, "time": TIME})


def time(**kw):
    return change(geometry={"space": SPACE, "time": {k: v for k, v in {**TIME, **kw}.items() if v is not ...}})


MALFORMED = [
    "{bad", "[1]", "null", "", None, '"text"', "5",
    '{"name":"a"} xyz', '{"name":"a"}{"name":"b"}', '{"name":"a"}}', '[{"name":"a"}]', '{"name":"a"',
    '{"observationId":"zz"}', '{"geometry":5}',
]


def test_malformed(spark):
    assert errors(spark, MALFORMED) == ["malformed_json"] * len(MALFORMED)


def test_examples_pass(spark):
    assert errors(spark, [CONTEXT, PLAIN, "  " + json.dumps(PLAIN) + "\n"]) == [None] * 3


# document, error per profile (strict, java, python)
RULES = [
    (change(name=...), "missing_name", "missing_name", "missing_name"),
    (change(name=""), "missing_name", None, "missing_name"),
    (change(semantics=...), "missing_semantics", "missing_semantics", "missing_semantics"),
    (change(semantics=""), "missing_semantics", None, "missing_semantics"),
    (space(shape=...), "missing_shape", "missing_shape", "missing_shape"),
    (space(shape=""), "missing_shape", "bad_wkt", "missing_shape"),
    (space(shape="EPSG:4326 POLYGON((0 0, 1 0, 1 1, 0 1))"), "bad_wkt", "bad_wkt", "bad_wkt"),
    (space(shape="hello"), "bad_wkt", "bad_wkt", "bad_wkt"),
    (space(shape="POINT(1 2)"), None, None, None),
    (time(tend=TIME["tstart"]), None, None, None),
    (time(tend=TIME["tstart"] - 1), "time_reversed", "time_reversed", "time_reversed"),
    (time(tstart=...), "bad_time", None, "bad_time"),
    (time(tstart=S.MIN_MILLIS), None, None, None),
    (time(tstart=S.MIN_MILLIS - 1), "bad_time", None, "bad_time"),
    (time(tend=S.MAX_MILLIS), None, None, None),
    (time(tend=S.MAX_MILLIS + 1), "bad_time", None, "bad_time"),
    (time(tunit="YEAR"), None, None, None),
    (time(tunit="month"), "bad_time_unit", None, "bad_time_unit"),
    (time(tunit=""), "bad_time_unit", None, "bad_time_unit"),
    (time(tunit=...), None, None, None),
    (change(geometry={"space": SPACE}), "incomplete_geometry", None, None),
    (change(geometry={"time": TIME}), "incomplete_geometry", None, None),
    (change(geometry=...), None, None, None),
    (change(digitalTwin=...), "missing_digital_twin", "missing_digital_twin", "missing_digital_twin"),
    (change(digitalTwin=""), "missing_digital_twin", "missing_digital_twin", "missing_digital_twin"),
    (change(digitalTwin="not a url"), "bad_digital_twin", "bad_digital_twin", None),
]


@pytest.mark.parametrize("which, profile", [(1, "strict"), (2, "java"), (3, "python")])
def test_rules(spark, which, profile):
    got = errors(spark, [r[0] for r in RULES], profile)
    assert got == [r[which] for r in RULES]


def test_twin_may_be_optional(spark):
    docs = [change(digitalTwin=...), change(digitalTwin=""), change(digitalTwin="not a url")]
    assert errors(spark, docs, require_twin=False) == [None, None, "bad_digital_twin"]


def test_first_error_wins_and_names_its_place(spark):
    row = validate_requests(frame(spark, [change(name="", semantics="")])).first()
    assert (row.error_code, row.error_detail) == ("missing_name", "name")


def test_every_rule_has_a_place(spark):
    for profile in ("strict", "java", "python"):
        assert {code for code, _ in request_rules(profile)} <= set(PLACES)
    with pytest.raises(ValueError):
        request_rules("other")


def test_python_profile_drops_incomplete_geometry(spark):
    row = validate_requests(frame(spark, [change(geometry={"space": SPACE})]), "python").first()
    assert row.geometry is None


def test_either_id_key(spark):
    docs = [{"id": 7}, {"observationId": 8}, {"id": 7, "observationId": 8}, {"id": 0}, {}]
    rows = frame(spark, docs).orderBy("request_id").collect()
    assert [r.observation_id for r in rows] == [7, 8, 8, 0, -1]


def test_unset_fields_are_left_out(spark):
    payload = writers.request_payloads(frame(spark, [PLAIN])).first().value
    assert json.loads(payload) == PLAIN


text = st.one_of(st.none(), st.text(st.characters(exclude_categories=("Cs",)), max_size=12))
requests = st.lists(
    st.tuples(text, text, text, st.integers(-(2**62), 2**62), st.one_of(st.none(), st.integers(-(2**40), 2**40))),
    min_size=1, max_size=30,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(requests)
def test_json_round_trip(spark, rows):
    flat = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "request_id bigint, name string, semantics string, digital_twin string, observation_id bigint, t bigint",
    )
    geometry = F.when(F.col("t").isNotNull(), F.struct(
        F.struct(F.col("name").alias("shape"), F.lit("g").alias("sgrid"), F.lit("p").alias("proj")).alias("space"),
        F.struct(F.col("t").alias("tstart"), F.col("t").alias("tend"), F.lit("year").alias("tunit"), F.lit(1).alias("tscope")).alias("time"),
    )).cast(S.GEOMETRY)
    before = flat.withColumn("geometry", geometry).drop("t")
    after = R.parse_requests(writers.request_payloads(before).select("request_id", "value"))
    assert after.where("malformed").count() == 0
    columns = before.columns
    order = lambda df: sorted(map(repr, df.select(*columns).collect()))
    assert order(after) == order(before)


def concepts(spark):
    return spark.createDataFrame(
        [("earth:Terrestrial earth:Region", 1, "o:Region", "SUBJECT", None), ("geography:Elevation", 2, "o:Elevation", "QUALITY", "r:1")],
        S.CONCEPT,
    )


def empty_store(spark):
    return spark.createDataFrame([], S.OBSERVATION)


def test_examples_are_routed_to_success(spark):
    rows = run_requests(frame(spark, [CONTEXT, PLAIN, "{bad"]), concepts(spark), empty_store(spark))
    got = {r.request_id: r for r in rows.collect()}
    assert [got[i].route for i in range(3)] == ["success", "success", "failure"]
    assert got[0].outcome == "resolved" and got[0].observation_id == 123456790
    assert got[0].attributes == {"observation.id": "123456790", "observation.type": "SUBJECT"}
    assert got[1].outcome == "accepted" and got[1].content is None
    assert got[2].content == "{bad" and got[2].error_code == "malformed_json"


def test_default_twin(spark):
    rows = frame(spark, [change(digitalTwin=...)])
    with pytest.raises(ValueError):
        check_requests(rows, concepts(spark), require_twin=False)
    checked = check_requests(rows, concepts(spark), require_twin=False, default_twin=TWIN)
    routed = submit_checked(checked, empty_store(spark)).first()
    assert (routed.digital_twin, routed.observation_id, routed.route) == (TWIN, 1, "success")


def test_files(spark, tmp_path):
    writers.write_requests(frame(spark, [CONTEXT, PLAIN]), str(tmp_path / "lines"))
    back = R.read_requests(spark, str(tmp_path / "lines"))
    assert sorted(r.observation_id for r in back.collect()) == [-1, 123456789]
    (tmp_path / "one.json").write_text(json.dumps(CONTEXT, indent=2))
    whole = R.read_requests(spark, str(tmp_path / "one.json"), multiline=True).first()
    assert whole.geometry.time.tstart == TIME["tstart"] and not whole.malformed
