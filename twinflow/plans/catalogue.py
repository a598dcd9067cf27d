"""Every operator as a query over the driver tables: name -> (spark, sf_dir) -> DataFrame."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinflow import schemas as S
from twinflow.functions import attributes as A
from twinflow.functions import shapes, times, urls, wkt
from twinflow.operators import documents as D
from twinflow.operators import messages as M
from twinflow.operators import monitor
from twinflow.operators import observations as O
from twinflow.operators import routing as R
from twinflow.operators import spatial
from twinflow.operators import submit as U
from twinflow.operators import validate as V
from twinflow.operators.resolve import resolve_observables, resolve_urns
from twinflow.plans import inputs as I
from twinflow.plans import pipeline
from twinflow.session import fresh_dir, staged
from twinflow.sinks.writers import request_payloads
from twinflow.sources import builder, context
from twinflow.sources import requests as requests_source
from twinflow.sources.requests import parse_requests
from twinflow.streaming import jobs, relay_log, scopes

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# "Now" where a result holds it, so that it can be compared.
NOW_MS = 1700000000000


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    _QUERIES[fn.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_requests(I.request_documents(spark, sf_dir))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.check_requests(_requests(spark, sf_dir), I.concepts(spark, sf_dir))


def _routed(spark: SparkSession, sf_dir: str, with_content: bool = False) -> DataFrame:
    return pipeline.run_requests(
        _requests(spark, sf_dir), I.concepts(spark, sf_dir), I.store(spark, sf_dir), with_content
    )


def _flat(geometry: Column) -> list[Column]:
    space, time = geometry["space"], geometry["time"]
    return [space[c].alias(c) for c in ("shape", "sgrid", "proj")] + [
        time[c].alias(c) for c in ("tstart", "tend", "tunit", "tscope")
    ]


def _json(column: str, path: str) -> Column:
    return F.get_json_object(column, path)


# --- requests: reading, checking, defaults


@query
def parse_requests_q(spark, sf_dir):
    return _requests(spark, sf_dir).select(
        "request_id",
        "malformed",
        "name",
        "semantics",
        "digital_twin",
        "observation_id",
        *_flat(F.col("geometry")),
    )


@query
def validate_requests(spark, sf_dir):
    return V.validate_requests(_requests(spark, sf_dir)).select(
        "request_id", "error_code", "error_detail"
    )


@query
def validate_requests_java(spark, sf_dir):
    return V.validate_requests(_requests(spark, sf_dir), "java", require_twin=False).select(
        "request_id", "error_code"
    )


@query
def validate_requests_python(spark, sf_dir):
    checked = V.validate_requests(_requests(spark, sf_dir), "python", require_twin=False)
    return checked.select(
        "request_id", "error_code", F.col("geometry").isNotNull().alias("has_geometry")
    )


@query
def error_counts(spark, sf_dir):
    return V.error_counts(_checked(spark, sf_dir))


@query
def validate_wkt(spark, sf_dir):
    fields = I.request_fields(spark, sf_dir)
    text = wkt.wkt_of(I.shape_text(F.col("wkt_kind")))
    return fields.select("request_id", "wkt_kind", wkt.is_wkt(text).alias("ok"))


@query
def validate_coords(spark, sf_dir):
    rows = I.shapes(spark, sf_dir)
    return rows.select("shape_id", "kind", shapes.coords_valid(F.col("coords")).alias("ok"))


@query
def validate_urls(spark, sf_dir):
    return I.urls(spark, sf_dir).select("page_id", urls.is_url(F.col("url")).alias("ok"))


@query
def normalize_url(spark, sf_dir):
    return I.urls(spark, sf_dir).select("page_id", urls.normalize_url(F.col("url")).alias("url"))


@query
def prefix_shape(spark, sf_dir):
    fields = I.request_fields(spark, sf_dir)
    box = wkt.bbox_to_wkt(*[F.col(c) for c in ("min_x", "min_y", "max_x", "max_y")])
    return fields.select("request_id", wkt.prefixed(F.lit("EPSG:4326"), box).alias("shape"))


@query
def bbox_to_wkt(spark, sf_dir):
    fields = I.request_fields(spark, sf_dir)
    box = wkt.bbox_to_wkt(*[F.col(c) for c in ("min_x", "min_y", "max_x", "max_y")])
    return fields.select("request_id", box.alias("wkt"))


@query
def coords_to_wkt(spark, sf_dir):
    rows = I.shapes(spark, sf_dir)
    return rows.select("shape_id", wkt.coords_to_wkt(F.col("coords")).alias("wkt"))


@query
def shape_bbox(spark, sf_dir):
    shape = I.shape_text(F.col("wkt_kind"))
    rows = I.request_fields(spark, sf_dir).select("request_id", shape.alias("shape"))
    box = wkt.bbox(wkt.wkt_of(F.col("shape")))
    return rows.select("request_id", wkt.proj_of(F.col("shape")).alias("proj"), box.alias("b")).select(
        "request_id", "proj", "b.*"
    )


@query
def epoch_millis(spark, sf_dir):
    events = I.table(spark, sf_dir, "events")
    return events.select("event_id", times.epoch_millis(F.col("ts")).alias("millis"))


def _gappy(spark, sf_dir) -> DataFrame:
    """Requests whose geometry lacks a field here and there."""
    rows = I.with_geometry(I.request_fields(spark, sf_dir))
    rid = F.col("request_id")

    def gap(column: Column, every: int) -> Column:
        return F.when(rid % every != 0, column)

    g = F.col("geometry")
    holes = O.geometry_struct(
        wkt.wkt_of(g["space"]["shape"]),
        gap(g["space"]["sgrid"], 2),
        gap(F.lit("EPSG:3857"), 5),
        g["time"]["tstart"],
        g["time"]["tend"],
        gap(g["time"]["tunit"], 3),
        gap(F.lit(3), 4),
    )
    parts = F.struct(
        F.when(g["space"].isNotNull(), holes["space"]).alias("space"),
        F.when(g["time"].isNotNull(), holes["time"]).alias("time"),
    )
    return rows.withColumn("geometry", F.when(g.isNotNull(), parts))


@query
def apply_defaults(spark, sf_dir):
    return _gappy(spark, sf_dir).select(
        "request_id", *_flat(O.apply_defaults(F.col("geometry")))
    )


@query
def build_geometry(spark, sf_dir):
    return _gappy(spark, sf_dir).select(
        "request_id", *_flat(O.build_geometry(F.col("geometry")))
    )


@query
def default_name(spark, sf_dir):
    name = O.default_name(F.col("name"), F.lit(NOW_MS))
    return I.request_fields(spark, sf_dir).select("request_id", name.alias("name"))


@query
def id_policy(spark, sf_dir):
    given = F.col("observation_id")
    return I.request_fields(spark, sf_dir).select(
        "request_id",
        O.id_policy(given).alias("single"),
        O.id_policy(given, federated=True).alias("federated"),
        O.id_policy(given, profile="python").alias("python"),
    )


@query
def build_observations(spark, sf_dir):
    rows = O.build_observations(I.with_geometry(I.request_fields(spark, sf_dir)))
    return rows.select(
        "request_id", "digital_twin", "observation_id", "name", "urn", *_flat(F.col("geometry"))
    )


@query
def request_payloads_q(spark, sf_dir):
    rows = request_payloads(I.with_geometry(I.request_fields(spark, sf_dir)))
    return rows.select(
        "request_id",
        _json("value", "$.name").alias("name"),
        _json("value", "$.semantics").alias("semantics"),
        _json("value", "$.digitalTwin").alias("digital_twin"),
        _json("value", "$.observationId").cast("bigint").alias("observation_id"),
        _json("value", "$.geometry.space.shape").alias("shape"),
        _json("value", "$.geometry.time.tstart").cast("bigint").alias("tstart"),
        F.array_contains(F.json_object_keys("value"), "geometry").alias("has_geometry"),
    )


@query
def build_requests(spark, sf_dir):
    sid = F.col("shape_id")
    parts = I.shapes(spark, sf_dir, "ts", "user_id").select(
        "shape_id",
        F.when(sid % 9 != 0, F.concat(F.lit("shape-"), sid)).otherwise("").alias("name"),
        F.concat(F.lit("nation:NATION_"), F.col("user_id") % 25).alias("semantics"),
        F.when(sid % 10 != 0, F.col("coords")).alias("coords"),
        F.col("ts").alias("tstart"),
        F.when(sid % 13 != 0, F.col("ts") + F.expr("interval 1 day"))
        .otherwise(F.col("ts") - F.expr("interval 1 second"))
        .alias("tend"),
        F.when(sid % 4 == 0, 2).alias("tscope"),
        (sid % 6).alias("id"),
    )
    return builder.build_requests(parts, "python").select(
        "shape_id", "name", "semantics", "observation_id", "error_code", *_flat(F.col("geometry"))
    )


@query
def context_requests(spark, sf_dir):
    rows = context.build_context_requests(I.context_params(spark, sf_dir), F.lit(NOW_MS))
    return rows.select(
        "param_id",
        "name",
        "semantics",
        "digital_twin",
        "observation_id",
        *_flat(F.col("geometry")),
        F.element_at("attributes", f"{S.ATTRIBUTE_PREFIX}.urn").alias("urn_attribute"),
    )


@query
def init_observations(spark, sf_dir):
    types = F.when(
        F.col("request_id") % 2 == 0,
        F.create_map(F.lit(f"{S.ATTRIBUTE_PREFIX}.semanticTypes"), F.lit("x:FromAttribute")),
    )
    rows = context.init_observations(_requests(spark, sf_dir).withColumn("attributes", types))
    return rows.select("request_id", "name", "urn", *_flat(F.col("geometry")))


# --- documents


@query
def extract_urn(spark, sf_dir):
    return D.extract_urn(I.urn_documents(spark, sf_dir)).select("request_id", "urn", "error_code")


@query
def resolve_urns_q(spark, sf_dir):
    rows = resolve_urns(I.urn_documents(spark, sf_dir), I.concepts(spark, sf_dir))
    routed = R.route_documents(rows)
    good = F.col("route") == S.ROUTE_SUCCESS
    return routed.select(
        "request_id",
        "urn",
        "resource_urn",
        "concept_id",
        "observable_urn",
        "error_code",
        "route",
        F.when(good, _json("content", "$.observable.urn")).alias("content_observable"),
        F.when(good, _json("content", "$.extra.k").cast("bigint")).alias("content_k"),
    )


@query
def split_observation(spark, sf_dir):
    return D.split_observation(I.relay_documents(spark, sf_dir)).select(
        "request_id",
        _json("observation", "$.urn").alias("observation_urn"),
        _json("observation", "$.metadata.k").cast("bigint").alias("observation_k"),
        "name",
        "semantics",
        "digital_twin",
        "observation_id",
        "error_code",
    )


# --- lookups and submission


@query
def resolve_observables_q(spark, sf_dir):
    checked = V.validate_requests(_requests(spark, sf_dir))
    return resolve_observables(checked, I.concepts(spark, sf_dir)).select(
        "request_id", "concept_id", "observable_urn", "observation_type", "error_code"
    )


@query
def known_twins(spark, sf_dir):
    requests = I.request_fields(spark, sf_dir).select("request_id", "digital_twin")
    return U.known_twins(requests, I.registry(spark, sf_dir))


@query
def contains_twin(spark, sf_dir):
    requests = I.request_fields(spark, sf_dir).select("request_id", "digital_twin")
    return U.contains_twin(requests, I.registry(spark, sf_dir))


@query
def new_twins(spark, sf_dir):
    return U.new_twins(I.request_fields(spark, sf_dir), I.registry(spark, sf_dir))


@query
def lookup_scope(spark, sf_dir):
    requests = I.request_fields(spark, sf_dir).select("request_id", "digital_twin")
    return U.lookup_scope(requests, I.registry(spark, sf_dir), default_scope="user")


@query
def create_scopes(spark, sf_dir):
    requests = I.request_fields(spark, sf_dir).select("request_id", "digital_twin")
    return U.create_scopes(requests, I.registry(spark, sf_dir), default_scope="user")


@query
def register_twins(spark, sf_dir):
    return U.register_twins(I.request_fields(spark, sf_dir), I.registry(spark, sf_dir))


def _good(spark, sf_dir) -> DataFrame:
    return staged(_checked(spark, sf_dir), "checked").where(F.col("error_code").isNull())


@query
def submit_observations(spark, sf_dir):
    return U.submit_observations(_good(spark, sf_dir), I.store(spark, sf_dir)).select(
        "request_id",
        "digital_twin",
        "outcome",
        "observation_id",
        "name",
        "urn",
        "observation_type",
        F.col("geometry.space.shape").alias("shape"),
    )


@query
def submit_federated(spark, sf_dir):
    checked = pipeline.check_requests(
        _requests(spark, sf_dir), I.concepts(spark, sf_dir), federated=True
    )
    submitted = pipeline.submit_checked(staged(checked, "federated"), I.store(spark, sf_dir))
    return submitted.select("request_id", "outcome", "observation_id", "route")


@query
def filter_observations(spark, sf_dir):
    return O.filter_observations(
        _good(spark, sf_dir),
        urns=[f"nation:NATION_{i}" for i in range(20)],
        twins=[f"https://twins.example.org/dt/{i}" for i in (0, 2, 3, 5)],
        bbox=(-20.0, -20.0, 20.0, 10.0),
        interval=(1704412800000, 1705708800000),
    ).select("request_id", "digital_twin", "urn")


@query
def filter_indexed(spark, sf_dir):
    path = fresh_dir(spark, "by-place")
    spatial.write_indexed(_good(spark, sf_dir), path)
    return spatial.read_indexed(
        spark,
        path,
        urns=[f"nation:NATION_{i}" for i in range(20)],
        twins=[f"https://twins.example.org/dt/{i}" for i in (0, 2, 3, 5)],
        bbox=(-20.0, -20.0, 20.0, 10.0),
        interval=(1704412800000, 1705708800000),
    ).select("request_id", "digital_twin", "urn")


# --- routes


@query
def route_requests(spark, sf_dir):
    return _routed(spark, sf_dir).select(
        "request_id", "digital_twin", "outcome", "observation_id", "route", "error_code"
    )


@query
def routed_counts(spark, sf_dir):
    events = R.event_route(I.messages(spark, sf_dir))
    rows = R.all_routes(_routed(spark, sf_dir), events)
    return rows.groupBy("route").agg(
        F.count(F.lit(1)).alias("n"), F.count("content").alias("n_content")
    )


@query
def written_routes(spark, sf_dir):
    """All three routes written and read back."""
    path = fresh_dir(spark, "routes")
    pipeline.write_routes(_routed(spark, sf_dir), I.messages(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("route").agg(
        F.count(F.lit(1)).alias("n"), F.count("content").alias("n_content")
    )


@query
def route_scoped(spark, sf_dir):
    """With a closed registry: records of unknown twins fail."""
    routed, _ = pipeline.run_scoped(
        _requests(spark, sf_dir), I.concepts(spark, sf_dir), I.store(spark, sf_dir), I.registry(spark, sf_dir), None
    )
    return routed.groupBy("route", "outcome", "error_code").agg(F.count(F.lit(1)).alias("n"))


@query
def failed_requests(spark, sf_dir):
    failed = _routed(spark, sf_dir).where(F.col("route") == S.ROUTE_FAILURE)
    return failed.select(
        "request_id",
        "error_code",
        (F.col("content") == F.col("value")).alias("kept"),
        _json("content", "$.name").alias("content_name"),
        F.col("attributes").isNull().alias("no_attributes"),
    )


@query
def success_attributes(spark, sf_dir):
    good = _routed(spark, sf_dir).where(F.col("route") == S.ROUTE_SUCCESS)
    return good.select(
        "request_id",
        F.element_at("attributes", "observation.id").alias("id_attribute"),
        F.element_at("attributes", "observation.type").alias("type_attribute"),
        F.col("content").isNull().alias("empty"),
    )


@query
def resolved_payloads(spark, sf_dir):
    good = _routed(spark, sf_dir, with_content=True).where(F.col("route") == S.ROUTE_SUCCESS)
    back = good.select("request_id", F.from_json("content", S.OBSERVATION).alias("o"))
    o = F.col("o")
    return back.select(
        "request_id",
        *[o[c].alias(c) for c in ("digital_twin", "observation_id", "name", "urn", "observation_type")],
        *_flat(o["geometry"]),
    )


@query
def relay_observations(spark, sf_dir):
    rows = pipeline.run_relayed(
        I.relay_documents(spark, sf_dir), I.concepts(spark, sf_dir), I.store(spark, sf_dir)
    )
    good = F.col("route") == S.ROUTE_SUCCESS
    return rows.select(
        "request_id",
        "route",
        "error_code",
        "outcome",
        F.when(good, _json("content", "$.observation_id").cast("bigint")).alias("observation_id"),
        F.when(good, _json("content", "$.name")).alias("name"),
        F.when(good, _json("content", "$.observation_type")).alias("observation_type"),
        F.element_at("attributes", "observation.id").alias("id_attribute"),
    )


# --- messages


@query
def filter_queues(spark, sf_dir):
    return M.filter_queues(I.messages(spark, sf_dir)).select("message_id", "queue")


@query
def filter_messages(spark, sf_dir):
    return M.filter_messages(
        I.messages(spark, sf_dir),
        types=["error", "click"],
        classes=["Runtime", "Service"],
        scopes=["dt-1", "dt-2", "dt-5"],
        since=1704412800000,
        until=1705708800000,
    ).select("message_id", "type", "class", "scope_id", "timestamp")


def _with_attributes(df: DataFrame, *columns) -> DataFrame:
    names = ("type", "class", "queue", "timestamp")
    return df.select(
        *columns, *[F.element_at("attributes", f"message.{n}").alias(f"a_{n}") for n in names]
    )


@query
def message_attributes(spark, sf_dir):
    rows = I.messages(spark, sf_dir).withColumn("attributes", A.message_attributes())
    return _with_attributes(rows, "message_id")


@query
def relay_messages(spark, sf_dir):
    rows = M.relay_messages(I.messages(spark, sf_dir), now_ms=F.lit(NOW_MS))
    return _with_attributes(
        rows,
        "message_id",
        "payload",
        F.element_at("attributes", "event.timestamp").alias("a_event"),
        F.unix_millis("event_ts").alias("event_ms"),
    )


@query
def event_route(spark, sf_dir):
    rows = R.event_route(I.messages(spark, sf_dir))
    return _with_attributes(rows, "message_id", "route", "content")


@query
def message_rates(spark, sf_dir):
    return monitor.message_rates(I.messages(spark, sf_dir))


@query
def latest_message(spark, sf_dir):
    return monitor.latest_message(I.messages(spark, sf_dir))


@query
def twin_summary(spark, sf_dir):
    return monitor.twin_summary(_routed(spark, sf_dir))


@query
def twin_summary_merged(spark, sf_dir):
    """Sketches of four parts, merged, beside the exact numbers."""
    routed = staged(_routed(spark, sf_dir), "routed")
    parts = [monitor.summary_sketches(routed.where(F.pmod("request_id", F.lit(4)) == i)) for i in range(4)]
    merged = staged(reduce(lambda a, b: a.unionByName(b), parts), "sketches")
    about = monitor.summary_estimates(merged).withColumnRenamed("n_observations", "about")
    exact = monitor.twin_summary(routed).drop("n")
    same = reduce(lambda a, b: a & b, [exact[c].eqNullSafe(about[c]) for c in monitor.SUMMARY])
    near = F.abs(F.col("about") - F.col("n_observations")) <= 1 + 0.06 * F.col("n_observations")
    return about.join(exact, same).select(*[about[c] for c in monitor.SUMMARY], "n", near.alias("near"))


# --- streams: each runs over the events table until it has read all of it


def _finish(stream) -> None:
    failed = jobs.wait_all(stream if isinstance(stream, dict) else {"stream": stream})
    if failed:
        raise RuntimeError(f"stream failed: {failed}")


def _request_stream(spark, sf_dir) -> DataFrame:
    fields = I.view(I.events_stream(spark, sf_dir), I.REQUESTS, "events")
    return parse_requests(I.documents_of(fields))


def _message_stream(spark, sf_dir) -> DataFrame:
    return I.view(I.events_stream(spark, sf_dir), I.MESSAGES, "events")


@query
def stream_requests(spark, sf_dir):
    run = fresh_dir(spark, "stream")
    rows = V.validate_requests(_request_stream(spark, sf_dir))
    _finish(jobs.write_stream(rows, f"{run}/out", f"{run}/checkpoint", once=True))
    return spark.read.schema(rows.schema).parquet(f"{run}/out").select(
        "request_id", "name", "semantics", "digital_twin", "observation_id", "error_code"
    )


@query
def stream_relay(spark, sf_dir):
    run = fresh_dir(spark, "stream")
    source = _message_stream(spark, sf_dir)
    _finish(jobs.relay(source, f"{run}/out", f"{run}/checkpoint", once=True))
    return _with_attributes(spark.read.parquet(f"{run}/out"), "message_id", "payload")


@query
def stream_fanout(spark, sf_dir):
    run = fresh_dir(spark, "stream")
    events = M.relay_messages(_message_stream(spark, sf_dir), S.QUEUES)

    def to_folder(name):
        def listener(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{run}/{name}/batch_id={batch_id}")

        return listener

    names = ("first", "second")
    streams = jobs.fan_out(events, {n: to_folder(n) for n in names}, f"{run}/checkpoints", once=True)
    _finish(streams)
    parts = [
        spark.read.parquet(f"{run}/{n}").select(F.lit(n).alias("listener"), "message_id", "payload")
        for n in names
    ]
    return parts[0].unionByName(parts[1])


@query
def stream_fanout_log(spark, sf_dir):
    """The source read once, two listeners reading the log."""
    run = fresh_dir(spark, "stream")
    stream = relay_log.relay(_message_stream(spark, sf_dir), f"{run}/log", f"{run}/checkpoint", S.QUEUES, once=True)
    _finish(stream)

    def to_folder(name):
        def listener(events, step, part):
            events.write.mode("overwrite").parquet(f"{run}/{name}/step={step}/part=p{part}")

        return listener

    parts = []
    for name in ("first", "second"):
        relay_log.deliver(spark, f"{run}/log", name, to_folder(name))
        rows = spark.read.schema(relay_log.EVENT).parquet(f"{run}/{name}")
        parts.append(rows.select(F.lit(name).alias("listener"), "message_id", "payload"))
    return parts[0].unionByName(parts[1])


@query
def stream_landed(spark, sf_dir):
    """Documents land as lines of text, are read as a stream, submitted and routed."""
    run = fresh_dir(spark, "stream")
    I.request_documents(spark, sf_dir).select("value").write.text(f"{run}/landing")
    jobs.seed_store(I.store(spark, sf_dir), f"{run}/store")
    places = [f"{run}/{p}" for p in ("store", "out", "work", "checkpoint")]
    source = requests_source.stream_requests(spark, f"{run}/landing")
    _finish(jobs.submit(source, I.concepts(spark, sf_dir), *places, once=True))
    out = jobs.read_outcomes(spark, f"{run}/store")
    return out.groupBy("route", "outcome", "error_code").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_register(spark, sf_dir):
    run = fresh_dir(spark, "stream")
    fields = I.view(I.events_stream(spark, sf_dir), I.REQUESTS, "events")
    jobs.seed_registry(I.registry(spark, sf_dir), f"{run}/registry")
    _finish(jobs.register(fields, f"{run}/registry", f"{run}/checkpoint", once=True))
    return jobs.read_registry(spark, f"{run}/registry").select("dt_url", "scope_kind")


@query
def stream_submit(spark, sf_dir):
    run = fresh_dir(spark, "stream")
    jobs.seed_store(I.store(spark, sf_dir), f"{run}/store")
    _finish(
        jobs.submit(
            _request_stream(spark, sf_dir),
            I.concepts(spark, sf_dir),
            f"{run}/store",
            f"{run}/out",
            f"{run}/work",
            f"{run}/checkpoint",
            once=True,
        )
    )
    return jobs.read_outcomes(spark, f"{run}/store").select(
        "request_id", "digital_twin", "outcome", "observation_id", "route", "error_code"
    )


@query
def stream_rates(spark, sf_dir):
    run = fresh_dir(spark, "stream")
    # some messages without a time, or with one outside of the calendar
    hard = "case when message_id % 97 = 0 then null when message_id % 101 = 0 then 253402300800000 else timestamp end"
    source = _message_stream(spark, sf_dir).withColumn("timestamp", F.expr(hard))
    _finish(jobs.count_messages(source, f"{run}/rates", f"{run}/checkpoint", once=True))
    return jobs.read_rates(spark, f"{run}/rates")


@query
def stream_scopes(spark, sf_dir):
    run = fresh_dir(spark, "stream")
    fields = I.view(I.events_stream(spark, sf_dir), I.REQUESTS, "events")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, scopes.PROVIDER)
    try:
        opened = scopes.opened_scopes(fields, I.registry(spark, sf_dir))
        _finish(jobs.write_stream(opened, f"{run}/scopes", f"{run}/checkpoint", once=True))
    finally:
        spark.conf.set(provider, before)
    opened = spark.read.schema(S.SCOPE).parquet(f"{run}/scopes")
    return opened.unionByName(I.registry(spark, sf_dir), allowMissingColumns=True).select("dt_url", "scope_kind")


# names that are operators in this module as well
for _name in ("parse_requests", "request_payloads", "resolve_urns", "resolve_observables"):
    _QUERIES[_name] = _QUERIES.pop(f"{_name}_q")
