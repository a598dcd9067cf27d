"""Record types, defaults and error codes shared by all operators."""

from pyspark.sql import types as T

SPACE = T.StructType(
    [
        T.StructField("shape", T.StringType()),
        T.StructField("sgrid", T.StringType()),
        T.StructField("proj", T.StringType()),
    ]
)
TIME = T.StructType(
    [
        T.StructField("tstart", T.LongType()),
        T.StructField("tend", T.LongType()),
        T.StructField("tunit", T.StringType()),
        T.StructField("tscope", T.IntegerType()),
    ]
)
GEOMETRY = T.StructType([T.StructField("space", SPACE), T.StructField("time", TIME)])

REQUEST = T.StructType(
    [
        T.StructField("geometry", GEOMETRY),
        T.StructField("name", T.StringType()),
        T.StructField("semantics", T.StringType()),
        T.StructField("digitalTwin", T.StringType()),
        T.StructField("observationId", T.LongType()),
        T.StructField("id", T.LongType()),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("message_id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("class", T.StringType()),
        T.StructField("queue", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("scope_id", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("payload_class", T.StringType()),
    ]
)

CONCEPT = T.StructType(
    [
        T.StructField("urn", T.StringType()),
        T.StructField("concept_id", T.LongType()),
        T.StructField("observable_urn", T.StringType()),
        T.StructField("observation_type", T.StringType()),
        T.StructField("resource", T.StringType()),
    ]
)

OBSERVATION = T.StructType(
    [
        T.StructField("digital_twin", T.StringType()),
        T.StructField("observation_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("urn", T.StringType()),
        T.StructField("observation_type", T.StringType()),
        T.StructField("geometry", GEOMETRY),
    ]
)

SCOPE = T.StructType(
    [
        T.StructField("dt_url", T.StringType()),
        T.StructField("scope_kind", T.StringType()),
        T.StructField("first_seen", T.TimestampType()),
    ]
)

# These have to equal what the clients and the platform send.
UNRESOLVED_ID = -1
DEFAULT_GRID = "1.km"
DEFAULT_PROJ = "EPSG:4326"
DEFAULT_TUNIT = "year"
DEFAULT_TSCOPE = 1
DEFAULT_NAME_PREFIX = "testing-"
TIME_UNITS = ("year",)
QUEUES = ("Events", "Errors", "Status", "Info", "Warning", "Debug", "UI")
DEFAULT_QUEUES = ("Events", "Errors", "Status")
CONTEXT_SEMANTICS = "earth:Terrestrial earth:Region"
CONTEXT_BBOX = (33.796, -9.41, 35.946, -7.086)
CONTEXT_SHAPE = (
    "POLYGON((33.796 -7.086, 35.946 -7.086, 35.946 -9.41, 33.796 -9.41, 33.796 -7.086))"
)
CONTEXT_TSTART = 1325376000000
CONTEXT_TEND = 1356998400000

# The URN and semantic-type attributes carry a prefix that belongs to the
# installation; pass the one your flows already use.
ATTRIBUTE_PREFIX = "twin"

# First and last millisecond of the years 1 to 9999.
MIN_MILLIS = -62135596800000
MAX_MILLIS = 253402300799999

ROUTE_SUCCESS = "success"
ROUTE_FAILURE = "failure"
ROUTE_EVENTS = "events"

OUTCOME_RESOLVED = "resolved"
OUTCOME_EXISTING = "existing"
OUTCOME_ACCEPTED = "accepted"
