"""Requests built from parts, as the clients do before they send one."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinflow import schemas as S
from twinflow.functions import shapes, times, wkt
from twinflow.operators.observations import geometry_struct, id_policy
from twinflow.operators.validate import validate_requests, with_place

_CORNERS = ("min_x", "min_y", "max_x", "max_y")


def _millis(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return times.epoch_millis(F.col(name))
    # a text that is no number is a part without a value, which the rules on time refuse
    return F.col(name).try_cast("bigint")


def build_requests(
    parts: DataFrame, profile: str = "strict", require_twin: bool = False
) -> DataFrame:
    """One request per row of parts, with ``error_code`` where a client would
    refuse to build it.

    Parts are ``name``, ``semantics``, a shape as text (``wkt``), as points
    (``coords``, array of x and y) or as corners (``min_x`` ... ``max_y``),
    ``proj``, ``grid``, ``tstart`` and ``tend`` (milliseconds or timestamps),
    ``tunit``, ``tscope``, ``digital_twin`` and ``id``. Any but name and
    semantics may be absent; absent settings take their defaults. All other
    columns pass through.
    """
    have = set(parts.columns)

    def part(name: str, default, kind: str) -> Column:
        default = F.lit(default).cast(kind)
        return F.coalesce(F.col(name).try_cast(kind), default) if name in have else default

    text = F.col("wkt") if "wkt" in have else F.lit(None).cast("string")
    if "coords" in have:
        text = F.coalesce(text, wkt.coords_to_wkt(F.col("coords")))
    if set(_CORNERS) <= have:
        text = F.coalesce(text, wkt.bbox_to_wkt(*[F.col(c) for c in _CORNERS]))
    parts = parts.withColumn("_text", text)
    text = F.col("_text")
    proj = part("proj", S.DEFAULT_PROJ, "string")
    tstart, tend = (
        _millis(parts, c) if c in have else F.lit(None).cast("bigint") for c in ("tstart", "tend")
    )
    whole = geometry_struct(
        F.when(text.isNotNull(), wkt.prefixed(proj, text)),
        part("grid", S.DEFAULT_GRID, "string"),
        proj,
        tstart,
        tend,
        part("tunit", S.DEFAULT_TUNIT, "string"),
        part("tscope", S.DEFAULT_TSCOPE, "int"),
    )
    # a part is there when something was said about it
    shaped = [c for c in ("wkt", "coords", *_CORNERS) if c in have]
    timed = [c for c in ("tstart", "tend") if c in have]

    def given(columns: list[str]) -> Column:
        return F.coalesce(*[F.when(F.col(c).isNotNull(), True) for c in columns], F.lit(False))

    geometry = F.when(
        given(shaped) | given(timed),
        F.struct(
            F.when(given(shaped), whole["space"]).alias("space"),
            F.when(given(timed), whole["time"]).alias("time"),
        ),
    )
    own = {*_CORNERS, "wkt", "coords", "proj", "grid", "tstart", "tend", "tunit", "tscope", "id"}
    own |= {"name", "semantics", "digital_twin", "_text"}
    built = parts.select(
        *[c for c in parts.columns if c not in own],
        *(["coords"] if "coords" in have else []),
        F.lit(False).alias("malformed"),
        geometry.alias("geometry"),
        "name",
        "semantics",
        part("digital_twin", None, "string").alias("digital_twin"),
        id_policy(part("id", None, "bigint"), profile=profile).alias("observation_id"),
    )
    checked = validate_requests(built, profile, require_twin)
    if "coords" in have:
        points = F.col("coords")
        bad = points.isNotNull() & (F.size(points) > 0) & ~shapes.coords_valid(points)
        checked = _points_rule(checked.withColumn("_bad", bad))
    return checked.drop("coords", "malformed", "_bad")


def _points_rule(checked: DataFrame) -> DataFrame:
    """Points that make no valid shape are found before the rules on time."""
    earlier = F.col("error_code").isin("missing_name", "missing_semantics", "missing_shape")
    hit = F.col("_bad") & F.coalesce(~earlier, F.lit(True))
    return with_place(
        checked.withColumn("error_code", F.when(hit, "bad_coords").otherwise(F.col("error_code")))
    )
