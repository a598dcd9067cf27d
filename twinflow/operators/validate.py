"""Checks on requests. Every rule is a native boolean column; none raises."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinflow.functions import times, urls, wkt
from twinflow.schemas import DEFAULT_TUNIT

PROFILES = ("strict", "java", "python")


def _present(column: Column, allow_empty: bool) -> Column:
    return column.isNotNull() if allow_empty else F.coalesce(column, F.lit("")) != ""


# Where each error is found in a request.
PLACES = {
    "malformed_json": "value",
    "missing_name": "name",
    "missing_semantics": "semantics",
    "missing_shape": "geometry.space.shape",
    "bad_wkt": "geometry.space.shape",
    "bad_coords": "geometry.space.shape",
    "bad_time": "geometry.time",
    "time_reversed": "geometry.time",
    "bad_time_unit": "geometry.time.tunit",
    "incomplete_geometry": "geometry",
    "missing_digital_twin": "digitalTwin",
    "bad_digital_twin": "digitalTwin",
    "unknown_semantics": "semantics",
    "unresolved": "observationId",
}


def request_rules(profile: str = "strict", require_twin: bool = True) -> list[tuple[str, Column]]:
    """(error code, rule) in the order in which the first failure counts.

    ``java`` and ``python`` accept what the client of that language accepts,
    ``strict`` only what both do. The text of the shape is in ``_wkt``.
    """
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}, not {profile!r}")
    java, python = profile == "java", profile == "python"
    geometry = F.col("geometry")
    space, time = geometry["space"], geometry["time"]
    twin = F.col("digital_twin")
    no_space, no_time = space.isNull(), time.isNull()
    tstart, tend = time["tstart"], time["tend"]
    if java:  # an absent long is 0 there
        tstart, tend = F.coalesce(tstart, F.lit(0)), F.coalesce(tend, F.lit(0))

    rules = [
        ("malformed_json", ~F.col("malformed")),
        ("missing_name", _present(F.col("name"), java)),
        ("missing_semantics", _present(F.col("semantics"), java)),
        ("missing_shape", no_space | _present(space["shape"], java)),
        ("bad_wkt", no_space | wkt.is_wkt(F.col("_wkt"))),
    ]
    if not java:
        calendar = times.in_calendar(tstart) & times.in_calendar(tend)
        rules.append(("bad_time", no_time | calendar))
    rules.append(("time_reversed", no_time | times.ordered(tstart, tend)))
    if not java:
        unit = F.coalesce(time["tunit"], F.lit(DEFAULT_TUNIT))
        rules.append(("bad_time_unit", no_time | times.known_unit(unit)))
    if profile == "strict":
        rules.append(("incomplete_geometry", geometry.isNull() | (no_space == no_time)))
    if require_twin:
        rules.append(("missing_digital_twin", _present(twin, False)))
    if not python:
        rules.append(("bad_digital_twin", ~_present(twin, False) | urls.is_url(twin)))
    return rules


def with_place(df: DataFrame) -> DataFrame:
    """Set ``error_detail`` by ``error_code``."""
    places = F.create_map(*[F.lit(x) for pair in PLACES.items() for x in pair])
    return df.withColumn("error_detail", F.try_element_at(places, F.col("error_code")))


def validate_requests(
    df: DataFrame, profile: str = "strict", require_twin: bool = True
) -> DataFrame:
    """Add ``error_code`` and ``error_detail``, the field at fault.

    All rules are one CASE: after the first that fails none is evaluated.
    The result is worth writing (``session.staged``) before rows are picked
    by their error, or the checks run again in the filter.
    """
    if profile == "python":  # this client leaves an incomplete geometry out
        whole = F.col("geometry.space").isNotNull() & F.col("geometry.time").isNotNull()
        df = df.withColumn("geometry", F.when(whole, F.col("geometry")))
    first = None
    for code, rule in request_rules(profile, require_twin):
        failed = ~F.coalesce(rule, F.lit(False))
        first = (F if first is None else first).when(failed, F.lit(code))
    text = wkt.wkt_of(F.col("geometry.space.shape"))
    return with_place(df.withColumn("_wkt", text).withColumn("error_code", first).drop("_wkt"))


def fail_where(df: DataFrame, condition: Column, code: str) -> DataFrame:
    """Add a later rule: an earlier error keeps its place."""
    later = F.when(condition, F.lit(code))
    earlier = [F.col("error_code")] if "error_code" in df.columns else []
    return with_place(df.withColumn("error_code", F.coalesce(*earlier, later)))


def error_counts(df: DataFrame) -> DataFrame:
    """How often each error is the first one, and how many records are good."""
    return df.groupBy(F.coalesce("error_code", F.lit("ok")).alias("error_code")).agg(
        F.count(F.lit(1)).alias("n")
    )
