"""Requests, messages, concepts, store and registry derived from the driver tables.

Nothing in the tables is a request or a message, so these views say how rows
of ``events``, ``orders``, ``nation`` and ``region`` stand for them. The text
is the same for Spark and the oracle but for ``{ms}`` and the table names.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinflow import schemas as S
from twinflow.functions import wkt
from twinflow.operators.observations import geometry_struct
from twinflow.sinks.writers import request_json

MESSAGES = """
select event_id as message_id, event_type as type,
       case event_id % 3 when 0 then 'Runtime' when 1 then 'Knowledge' else 'Service' end as class,
       case event_type when 'error' then 'Errors' when 'signup' then 'Status'
                       when 'purchase' then 'Events' when 'click' then 'UI' else 'Debug' end as queue,
       {ms} as timestamp, concat('dt-', cast(user_id % 7 as string)) as scope_id,
       props as payload, case when event_id % 4 = 0 then 'Other' else 'Message' end as payload_class
from {events}
"""

# Ids grow with the number of users, so each is named a few times at any scale.
# Half of all requests go to one twin.
REQUESTS = """
select event_id as request_id,
       case when event_id % 11 = 0 then '' when event_id % 13 = 0 then null
            else concat('obs-', cast(event_id as string)) end as name,
       case when event_id % 17 = 0 then null when event_id % 19 = 0 then 'x:Unknown'
            else concat('nation:NATION_', cast(user_id % 25 as string)) end as semantics,
       case when event_id % 23 = 0 then '' when event_id % 29 = 0 then 'not a url'
            when user_id % 2 = 0 then 'https://twins.example.org/dt/0'
            else concat('https://twins.example.org/dt/', cast(user_id % 7 as string)) end as digital_twin,
       case when event_id % 3 = 0 then -1 else user_id * 10 + event_id % 10 end as observation_id,
       case when event_id % 5 = 0 then 'none' when event_id % 53 = 0 then 'space'
            when event_id % 59 = 0 then 'time' else 'both' end as geometry_kind,
       cast(event_id % 340 as double) / 4 - 40 as min_x, cast(user_id % 90 as double) / 2 - 30 as min_y,
       cast(event_id % 340 as double) / 4 - 39 as max_x, cast(user_id % 90 as double) / 2 - 28 as max_y,
       case when event_id % 31 = 0 then 'unclosed' when event_id % 37 = 0 then 'garbage'
            when event_id % 61 = 0 then 'missing' else 'ok' end as wkt_kind,
       case when event_id % 67 = 0 then null when event_id % 71 = 0 then 253402300800000
            else {ms} end as tstart,
       {ms} + case when event_id % 41 = 0 then -1 when event_id % 7 = 0 then 0 else 86400000 end as tend,
       case when event_id % 43 = 0 then 'month' when event_id % 2 = 0 then 'YEAR' else 'year' end as tunit,
       event_id % 47 = 0 as cut
from {events}
"""

CONCEPTS = """
select concat('nation:', n_name) as urn, cast(n_nationkey as bigint) as concept_id,
       concat('obs:', n_name) as observable_urn,
       case n_regionkey % 3 when 0 then 'SUBJECT' when 1 then 'QUALITY' else 'PROCESS' end as observation_type,
       case when n_nationkey % 2 = 0 then concat('res:', n_name) else null end as resource
from {nation}
"""

STORE = """
select concat('https://twins.example.org/dt/', cast(o_custkey % 7 as string)) as digital_twin,
       o_orderkey as observation_id, concat('stored-', cast(o_orderkey as string)) as name,
       concat('nation:NATION_', cast(o_custkey % 25 as string)) as urn,
       case o_orderstatus when 'F' then 'SUBJECT' when 'O' then 'QUALITY' else 'PROCESS' end as observation_type
from {orders}
"""

REGISTRY = """
select concat('https://twins.example.org/dt/', cast(r_regionkey as string)) as dt_url,
       'context' as scope_kind
from {region}
"""

CONTEXT_PARAMS = """
select c_custkey as param_id,
       case when c_custkey % 3 = 0 then ' ' when c_custkey % 5 = 0 then null else c_name end as name,
       case when c_custkey % 4 = 0 then '' else concat('HTTPS://twins.example.org/dt/', cast(c_nationkey as string)) end as digital_twin,
       case when c_custkey % 7 = 0 then null else cast(c_nationkey as double) / 4 - 10 end as min_x,
       cast(c_custkey % 80 as double) / 2 - 20 as min_y,
       cast(c_nationkey as double) / 4 - 9 as max_x, cast(c_custkey % 80 as double) / 2 - 19 as max_y
from {customer}
"""

# n corners of a convex curve in order ("bow"), or in steps of two, which for an
# odd n makes a star whose edges cross.
SHAPES = """
select event_id as shape_id,
       case event_id % 8 when 0 then 'point' when 1 then 'line' when 2 then 'same' when 3 then 'square'
                         when 4 then 'bowtie' when 5 then 'flat' when 6 then 'bow' else 'star' end as kind,
       user_id as x0, event_id % 90 as y0, 5 + 2 * (user_id % 40) as n
from {events}
"""


# Addresses as found and damaged in some ways.
URLS = """
select page_id, case page_id % 6 when 1 then concat('  ', url) when 2 then replace(url, '://', ':')
                when 3 then replace(url, 'http', 'HTTP') when 4 then replace(url, 'http', 'gopher')
                else url end as url
from {pages}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(source: DataFrame, text: str, table_name: str) -> DataFrame:
    """One of the views above over a batch or streaming table."""
    ms = "unix_millis(cast(ts as timestamp))"
    spark = source.sparkSession
    return spark.sql(text.replace("{ms}", ms), **{table_name: source})


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return reader.parquet(sf_dir)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(table(spark, sf_dir, "events"), MESSAGES, "events")


def request_fields(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    text = REQUESTS.replace("from {events}", "".join(f", {c}" for c in extra) + " from {events}")
    return view(table(spark, sf_dir, "events"), text, "events")


def concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(table(spark, sf_dir, "nation"), CONCEPTS, "nation")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(table(spark, sf_dir, "region"), REGISTRY, "region")


def context_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(table(spark, sf_dir, "customer"), CONTEXT_PARAMS, "customer")


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(table(spark, sf_dir, "pages"), URLS, "pages")


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(table(spark, sf_dir, "orders"), STORE, "orders")
    return rows.withColumn("geometry", F.lit(None).cast(S.GEOMETRY))


def shape_text(kind: Column) -> Column:
    """The text of a request's shape: closed, cut in two ways, or none."""
    box = [F.col(c) for c in ("min_x", "min_y", "max_x", "max_y")]
    whole = wkt.bbox_to_wkt(*box)
    last = F.format_string(", %f %f))", box[0], box[1])
    unclosed = F.concat(F.substr(whole, F.lit(1), F.length(whole) - F.length(last)), F.lit("))"))
    garbage = F.format_string("POLYGON((%f %f", box[0], box[1])
    text = F.when(kind == "ok", whole).when(kind == "unclosed", unclosed).when(kind == "garbage", garbage)
    return F.when(kind != "missing", wkt.prefixed(F.lit(S.DEFAULT_PROJ), text))


def with_geometry(fields: DataFrame) -> DataFrame:
    """Fold the flat geometry fields into ``geometry``."""
    kind = F.col("geometry_kind")
    whole = geometry_struct(
        shape_text(F.col("wkt_kind")),
        F.lit(S.DEFAULT_GRID),
        F.lit(S.DEFAULT_PROJ),
        F.col("tstart"),
        F.col("tend"),
        F.col("tunit"),
        F.lit(S.DEFAULT_TSCOPE),
    )
    geometry = F.when(
        kind != "none",
        F.struct(
            F.when(kind.isin("both", "space"), whole["space"]).alias("space"),
            F.when(kind.isin("both", "time"), whole["time"]).alias("time"),
        ),
    )
    return fields.withColumn("geometry", geometry)


def documents_of(fields: DataFrame) -> DataFrame:
    """Requests as JSON text; ``cut`` ones lack their last character."""
    whole = with_geometry(fields).withColumn("value", request_json())
    value = F.when(F.col("cut"), F.substr("value", F.lit(1), F.length("value") - 1))
    return whole.select("request_id", value.otherwise(F.col("value")).alias("value"))


def request_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_of(request_fields(spark, sf_dir))


def urn_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that name a URN, name none, or are no objects."""
    fields = request_fields(spark, sf_dir, "props")
    nested = F.from_json("props", "k bigint")
    whole = F.to_json(
        F.struct(F.col("semantics").alias("urn"), nested.alias("extra"), F.col("name").alias("note"))
    )
    value = F.when(F.col("cut"), F.substr(whole, F.lit(1), F.length(whole) - 1))
    value = value.when(F.col("wkt_kind") == "garbage", F.concat(F.lit("["), whole, F.lit("]")))
    return fields.select("request_id", value.otherwise(whole).alias("value"))


def relay_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request documents with an ``observation`` inside, as the relay gets them."""
    fields = request_fields(spark, sf_dir, "props")
    observation = F.struct(
        F.col("semantics").alias("urn"),
        F.when(F.col("request_id") % 2 == 0, "PROCESS").alias("type"),
        F.from_json("props", "k bigint").alias("metadata"),
    )
    whole = F.to_json(
        F.struct(
            F.when(F.col("wkt_kind") != "missing", observation).alias("observation"),
            F.col("name").alias("name"),
            F.col("semantics").alias("semantics"),
            F.col("digital_twin").alias("digitalTwin"),
            F.col("observation_id").alias("id"),
        )
    )
    value = F.when(F.col("cut"), F.substr(whole, F.lit(1), F.length(whole) - 1))
    return fields.select("request_id", value.otherwise(whole).alias("value"))


def shapes(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """shape_id, kind, the coordinate list ``coords`` and columns of events."""
    text = SHAPES.replace("from {events}", "".join(f", {c}" for c in extra) + " from {events}")
    rows = view(table(spark, sf_dir, "events"), text, "events")

    def at(dx: Column, dy: Column) -> Column:
        return F.struct(
            (F.col("x0") / 2 + dx).cast("double").alias("x"),
            (F.col("y0") / 2 + dy).cast("double").alias("y"),
        )

    def along(step: int) -> Column:
        def corner(i: Column) -> Column:
            j = (i * step) % F.col("n").cast("int")
            return at(j, j * j)

        return F.transform(F.sequence(F.lit(0), F.col("n").cast("int") - 1), corner)

    fixed = {
        "point": [(0, 0)],
        "line": [(0, 0), (1, 1)],
        "same": [(0, 0), (0, 0)],
        "square": [(0, 0), (1, 0), (1, 1), (0, 1)],
        "bowtie": [(0, 0), (1, 1), (1, 0), (0, 1)],
        "flat": [(0, 0), (1, 0), (2, 0)],
    }
    coords = F.when(F.col("kind") == "bow", along(1)).when(F.col("kind") == "star", along(2))
    for kind, points in fixed.items():
        coords = coords.when(F.col("kind") == kind, F.array(*[at(F.lit(x), F.lit(y)) for x, y in points]))
    return rows.select("shape_id", "kind", coords.alias("coords"), *extra)
