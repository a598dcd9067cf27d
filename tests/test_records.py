"""Documents, messages, routes and monitoring on hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F

from twinflow import schemas as S
from twinflow.functions import attributes as A
from twinflow.functions import times, urls
from twinflow.operators import documents as D
from twinflow.operators import messages as M
from twinflow.operators import monitor
from twinflow.operators import observations as O
from twinflow.operators import routing as R
from twinflow.operators.resolve import resolve_urns
from twinflow.sinks import writers
from twinflow.sources import context, messages as sources


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "request_id bigint, value string")


def test_urn_of_documents(spark):
    rows = D.extract_urn(docs(spark, '{"urn":"a:B"}', "{bad", "[1]", "{}", '{"urn":"a"} x', None, '{"urn":null}'))
    got = [(r.urn, r.error_code) for r in rows.orderBy("request_id").collect()]
    bad = (None, "malformed_json")
    assert got == [("a:B", None), bad, bad, (None, "missing_urn"), bad, bad, (None, "missing_urn")]


def test_document_keeps_all_it_had(spark):
    concepts = spark.createDataFrame([("a:B", 4, "o:B", "SUBJECT", None)], S.CONCEPT)
    source = {"urn": "a:B", "deep": {"list": [1, {"x": "y}"}], "n": None}, "t": "q\"{}"}
    texts = [json.dumps(source), json.dumps(source, indent=1) + "\n", '{"urn":"no"}']
    rows = resolve_urns(docs(spark, *texts), concepts).orderBy("request_id").collect()
    for r in rows[:2]:
        assert json.loads(r.content) == {**source, "observable": {"urn": "o:B", "id": 4, "type": "SUBJECT"}}
    assert (rows[2].content, rows[2].error_code) == (texts[2], "unknown_semantics")


def test_observable_into_empty_document(spark):
    value = F.lit(" { } ")
    row = spark.range(1).select(D.add_observable(value, F.struct(F.lit(1).alias("id"))).alias("v")).first()
    assert json.loads(row.v) == {"observable": {"id": 1}}


def test_split_observation(spark):
    text = json.dumps({"observation": {"a": {"b": [1]}}, "name": "n", "semantics": "s", "id": 3, "other": 1})
    row = D.split_observation(docs(spark, text)).first()
    assert json.loads(row.observation) == {"a": {"b": [1]}}
    assert (row.name, row.semantics, row.observation_id, row.error_code) == ("n", "s", 3, None)


def messages(spark):
    rows = [
        (1, "error", "Runtime", "Errors", 1000, "s1", '{"k":1}', "Message"),
        (2, "click", "Runtime", "UI", 2500, "s1", '{"k":2}', "Message"),
        (3, "signup", "Service", "Status", 2500, "s1", '{"k":3}', "Other"),
        (4, "purchase", "Service", "Events", 4000, "s2", '{"k":4}', "Message"),
        (5, "view", "Service", "Debug", 4100, "s2", None, "Message"),
    ]
    return spark.createDataFrame(rows, S.MESSAGE)


def ids(df):
    return sorted(r.message_id for r in df.collect())


def test_message_filters(spark):
    m = messages(spark)
    assert ids(M.filter_queues(m)) == [1, 3, 4]
    assert ids(M.filter_queues(m, ["UI", "Debug"])) == [2, 5]
    with pytest.raises(ValueError):
        M.filter_queues(m, ["Nope"])
    assert ids(M.filter_payload(m)) == [1, 2, 4, 5]
    assert ids(M.filter_messages(m, types=["click", "view"], since=2500, until=4100)) == [2]
    assert ids(M.filter_messages(m, classes=["Service"], scopes=["s2"])) == [4, 5]
    assert ids(M.filter_messages(m)) == [1, 2, 3, 4, 5]


def test_relay(spark):
    rows = {r.message_id: r for r in M.relay_messages(messages(spark), now_ms=F.lit(9)).collect()}
    assert sorted(rows) == [1, 3, 4]
    assert rows[1].attributes == {
        "message.type": "error", "message.class": "Runtime", "message.queue": "Errors",
        "message.timestamp": "1000", "event.timestamp": "9",
    }
    assert rows[1].payload == '{"k":1}'
    structured = messages(spark).withColumn("payload", F.from_json("payload", "k int"))
    assert {r.payload for r in M.relay_messages(structured).collect()} == {'{"k":1}', '{"k":3}', '{"k":4}'}


def test_latest_and_rates(spark):
    latest = {r.scope_id: r.message_id for r in monitor.latest_message(messages(spark)).collect()}
    assert latest == {"s1": 3, "s2": 5}
    rates = monitor.message_rates(messages(spark), "2 seconds").where("queue = 'UI'").first()
    assert (rates.window_start, rates.window_end, rates.n) == (2000, 4000, 1)


def test_unresolved_is_a_failure(spark):
    rows = spark.createDataFrame(
        [("v", None, -1, "S"), ("w", None, 4, "S"), ("x", "bad_wkt", 4, "S")],
        "value string, error_code string, observation_id bigint, observation_type string",
    )
    got = [(r.route, r.error_code, r.content) for r in R.route(rows).orderBy("value").collect()]
    assert got == [("failure", "unresolved", "v"), ("success", None, None), ("failure", "bad_wkt", "x")]


def test_routed_files(spark, tmp_path):
    rows = spark.createDataFrame([("v", "bad", 1, "S"), ("w", None, 4, "S")], "value string, error_code string, observation_id bigint, observation_type string")
    events = R.event_route(messages(spark))
    out = R.all_routes(R.route(rows).withColumn("error_detail", F.lit(None).cast("string")), events)
    writers.write_routed(out, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out")).groupBy("route").count().collect()
    assert {r.route: r["count"] for r in back} == {"success": 1, "failure": 1, "events": 4}
    assert spark.read.parquet(str(tmp_path / "out" / "route=events")).count() == 4


def test_events_and_messages_files(spark, tmp_path):
    messages(spark).write.parquet(str(tmp_path / "m"))
    read = sources.read_messages(spark, str(tmp_path / "m"))
    writers.write_events(M.relay_messages(read), str(tmp_path / "e"))
    back = spark.read.parquet(str(tmp_path / "e"))
    assert ids(back) == [1, 3, 4]
    heads = back.where("message_id = 1").select(writers.headers(F.col("attributes")).alias("h")).first().h
    assert {(h.key, bytes(h.value).decode()) for h in heads} >= {("message.queue", "Errors")}


def test_id_policy(spark):
    df = spark.createDataFrame([(5,), (0,), (None,), (-1,)], "i bigint")
    got = df.select(
        O.id_policy(F.col("i")), O.id_policy(F.col("i"), profile="python"), O.id_policy(F.col("i"), federated=True)
    ).collect()
    assert [tuple(r) for r in got] == [(5, 5, -1), (0, -1, -1), (-1, -1, -1), (-1, -1, -1)]


def test_names_urls_times(spark):
    df = spark.createDataFrame([("a", "HTTPS://h.org/x"), (" ", " https://h.org "), (None, "mailto:a@b")], "n string, u string")
    got = df.select(O.default_name(F.col("n"), F.lit(5)), urls.normalize_url(F.col("u")), urls.is_url(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [("a", "https://h.org/x", True), ("testing-5", "https://h.org", True), ("testing-5", None, False)]
    row = spark.sql("select timestamp_ntz'1969-12-31 23:59:59.9995' t").select(times.epoch_millis(F.col("t"))).first()
    assert row[0] == -1


def test_context_requests(spark):
    params = spark.createDataFrame([(1, None, " "), (2, "n", "https://h.org/a")], "p int, name string, digital_twin string")
    rows = context.build_context_requests(params, F.lit(7), prefix="acme").orderBy("p").collect()
    assert [(r.p, r.name, r.digital_twin) for r in rows] == [(1, "testing-7", None), (2, "n", "https://h.org/a")]
    assert rows[0].attributes == {"acme.urn": S.CONTEXT_SEMANTICS}
    assert rows[0].geometry.space.shape == "EPSG:4326 " + S.CONTEXT_SHAPE
    assert (rows[0].geometry.time.tstart, rows[0].observation_id) == (1325376000000, -1)


def test_template(spark):
    rows = spark.createDataFrame(
        [("s", {"twin.semanticTypes": "a"}), (None, {"twin.semanticTypes": "a"}), (None, None)],
        "semantics string, attributes map<string,string>",
    ).withColumn("geometry", F.lit(None).cast(S.GEOMETRY))
    assert [r.urn for r in context.init_observations(rows).collect()] == ["s", "a", S.CONTEXT_SEMANTICS]
    assert A.ATTRIBUTE_PREFIX == "twin"


def test_observation_filter_edges(spark):
    space = lambda s: {"space": {"shape": s, "sgrid": None, "proj": None}, "time": {"tstart": 10, "tend": 20, "tunit": None, "tscope": None}}
    rows = spark.createDataFrame(
        [("touch", "d", space("EPSG:4326 POINT(1 1)")), ("off", "d", space("POINT(1.1 1)")), ("empty", "d", space("POINT EMPTY")), ("none", "d", None)],
        "urn string, digital_twin string, geometry " + S.GEOMETRY.simpleString(),
    )
    names = lambda df: sorted(r.urn for r in df.collect())
    assert names(O.filter_observations(rows, bbox=(0, 0, 1, 1))) == ["touch"]
    assert names(O.filter_observations(rows, interval=(19, 30))) == ["empty", "off", "touch"]
    assert names(O.filter_observations(rows, interval=(20, 30))) == []
    assert names(O.filter_observations(rows, urns=["off", "none"], twins=["d"])) == ["none", "off"]
