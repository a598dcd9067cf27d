"""From request columns to observation columns, and filters over observations."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinflow import schemas as S
from twinflow.functions import wkt
from twinflow.functions.text import is_blank, strip


def default_name(name: Column, now_ms: Column | None = None) -> Column:
    """The name, or ``testing-<now>`` for a null or blank one."""
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    made = F.concat(F.lit(S.DEFAULT_NAME_PREFIX), now.cast("string"))
    return F.when(is_blank(name), made).otherwise(name)


def id_policy(observation_id: Column, federated: bool = False, profile: str = "strict") -> Column:
    """Federated submission always asks for a new observation. The Python
    client also takes id 0 as "no id"; Java keeps it."""
    unresolved = F.lit(S.UNRESOLVED_ID).cast("bigint")
    if federated:
        return unresolved
    if profile == "python":
        return F.when(F.coalesce(observation_id, F.lit(0)) == 0, unresolved).otherwise(
            observation_id
        )
    return F.coalesce(observation_id, unresolved)


def geometry_struct(
    shape: Column,
    sgrid: Column,
    proj: Column,
    tstart: Column,
    tend: Column,
    tunit: Column,
    tscope: Column,
) -> Column:
    return F.struct(
        F.struct(shape.alias("shape"), sgrid.alias("sgrid"), proj.alias("proj")).alias("space"),
        F.struct(
            tstart.cast("bigint").alias("tstart"),
            tend.cast("bigint").alias("tend"),
            tunit.alias("tunit"),
            tscope.cast("int").alias("tscope"),
        ).alias("time"),
    ).cast(S.GEOMETRY)


def _parts(geometry: Column, submitted: bool) -> Column:
    """Geometry with defaults filled in; a missing part stays missing.

    Written out from the fields given, not from a filled struct: Spark would
    work out that struct again for every field taken from it.
    """
    space, time = geometry["space"], geometry["time"]
    shape, tunit = space["shape"], F.coalesce(time["tunit"], F.lit(S.DEFAULT_TUNIT))
    proj = F.coalesce(space["proj"], wkt.proj_of(shape), F.lit(S.DEFAULT_PROJ))
    if submitted:
        text = F.when(wkt.has_prefix(shape), strip(shape)).otherwise(wkt.prefixed(proj, shape))
        shape, tunit = F.when(shape.isNotNull(), text), F.lower(tunit)
    filled_space = F.struct(
        shape.alias("shape"),
        F.coalesce(space["sgrid"], F.lit(S.DEFAULT_GRID)).alias("sgrid"),
        proj.alias("proj"),
    )
    filled_time = F.struct(
        time["tstart"].alias("tstart"),
        time["tend"].alias("tend"),
        tunit.alias("tunit"),
        F.coalesce(time["tscope"], F.lit(S.DEFAULT_TSCOPE)).alias("tscope"),
    )
    both = F.struct(
        F.when(space.isNotNull(), filled_space).alias("space"),
        F.when(time.isNotNull(), filled_time).alias("time"),
    )
    return F.when(geometry.isNotNull(), both)


def apply_defaults(geometry: Column) -> Column:
    """Fill grid, projection, unit and scope."""
    return _parts(geometry, submitted=False)


def build_geometry(geometry: Column) -> Column:
    """What is submitted: prefixed shape, grid, projection, interval and the
    temporal resolution (unit and how many of it)."""
    return _parts(geometry, submitted=True)


def build_observations(
    df: DataFrame, federated: bool = False, profile: str = "strict"
) -> DataFrame:
    """Request columns to observation columns: the URN is the semantics text."""
    return (
        df.withColumn("geometry", build_geometry(F.col("geometry")))
        .withColumn("urn", F.col("semantics"))
        .withColumn("observation_id", id_policy(F.col("observation_id"), federated, profile))
    )


def filter_observations(
    df: DataFrame,
    urns: Iterable[str] | None = None,
    twins: Iterable[str] | None = None,
    bbox: tuple[float, float, float, float] | None = None,
    interval: tuple[int, int] | None = None,
) -> DataFrame:
    """Keep observations by what they observe, whose they are, where and when.

    ``bbox`` is (min_x, min_y, max_x, max_y), touching counts; ``interval`` is
    [from, to) in milliseconds.
    """
    if urns is not None:
        df = df.where(F.col("urn").isin(*urns))
    if twins is not None:
        df = df.where(F.col("digital_twin").isin(*twins))
    if interval is not None:
        start, end = interval
        time = F.col("geometry.time")
        df = df.where((time["tstart"] < end) & (time["tend"] > start))
    if bbox is not None:
        box = wkt.bbox(wkt.wkt_of(F.col("geometry.space.shape")))
        df = (
            df.withColumn("_box", box)
            .where(
                (F.col("_box.min_x") <= bbox[2])
                & (F.col("_box.max_x") >= bbox[0])
                & (F.col("_box.min_y") <= bbox[3])
                & (F.col("_box.max_y") >= bbox[1])
            )
            .drop("_box")
        )
    return df
