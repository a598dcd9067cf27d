"""Requests made from parameters, and observations made from a template."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinflow import schemas as S
from twinflow.functions import attributes as A
from twinflow.functions import urls, wkt
from twinflow.functions.text import is_blank
from twinflow.operators.observations import default_name, geometry_struct


def _param(df: DataFrame, name: str, default: Column) -> Column:
    return F.coalesce(F.col(name), default) if name in df.columns else default


def default_geometry() -> Column:
    """The region and year used where a record names none."""
    return geometry_struct(
        wkt.prefixed(F.lit(S.DEFAULT_PROJ), F.lit(S.CONTEXT_SHAPE)),
        F.lit(S.DEFAULT_GRID),
        F.lit(S.DEFAULT_PROJ),
        F.lit(S.CONTEXT_TSTART),
        F.lit(S.CONTEXT_TEND),
        F.lit(S.DEFAULT_TUNIT),
        F.lit(S.DEFAULT_TSCOPE),
    )


def build_context_requests(
    params: DataFrame, now_ms: Column | None = None, prefix: str = S.ATTRIBUTE_PREFIX
) -> DataFrame:
    """One request per parameter row.

    ``params`` may have ``name, digital_twin, semantics, min_x, min_y, max_x,
    max_y, tstart, tend``; what is missing or null takes the default. All
    other columns pass through.
    """
    proj, grid = F.lit(S.DEFAULT_PROJ), F.lit(S.DEFAULT_GRID)
    corners = ("min_x", "min_y", "max_x", "max_y")
    text = F.lit(S.CONTEXT_SHAPE)
    if set(corners) <= set(params.columns):
        text = F.coalesce(wkt.bbox_to_wkt(*[F.col(c) for c in corners]), text)
    semantics = _param(params, "semantics", F.lit(S.CONTEXT_SEMANTICS))
    twin = _param(params, "digital_twin", F.lit(None).cast("string"))
    own = {*corners, "name", "digital_twin", "semantics", "tstart", "tend"}
    return params.select(
        *[c for c in params.columns if c not in own],
        geometry_struct(
            wkt.prefixed(proj, text),
            grid,
            proj,
            _param(params, "tstart", F.lit(S.CONTEXT_TSTART)),
            _param(params, "tend", F.lit(S.CONTEXT_TEND)),
            F.lit(S.DEFAULT_TUNIT),
            F.lit(S.DEFAULT_TSCOPE),
        ).alias("geometry"),
        default_name(_param(params, "name", F.lit(None).cast("string")), now_ms).alias("name"),
        semantics.alias("semantics"),
        F.when(~is_blank(twin), urls.normalize_url(twin)).alias("digital_twin"),
        F.lit(S.UNRESOLVED_ID).cast("bigint").alias("observation_id"),
        A.urn_attribute(semantics, prefix).alias("attributes"),
    )


def init_observations(df: DataFrame, prefix: str = S.ATTRIBUTE_PREFIX) -> DataFrame:
    """Requests to observations: fields of the record win over the template.

    The semantics come from the record, else from its semantic-types
    attribute, else from the template. Each field of the geometry that the
    record leaves open is the template's. A malformed record stays as it is,
    with its flag, and gets nothing from the template.
    """
    urn = F.col("semantics")
    if "attributes" in df.columns:
        urn = F.coalesce(urn, A.semantic_types(F.col("attributes"), prefix))
    readable = ~F.col("malformed") if "malformed" in df.columns else F.lit(True)
    template = default_geometry()
    parts = {p.name: p.dataType.names for p in S.GEOMETRY}

    def filled(part: str) -> Column:
        own = F.col("geometry")[part]
        return F.struct(*[F.coalesce(own[f], template[part][f]).alias(f) for f in parts[part]])

    whole = F.struct(*[filled(p).alias(p) for p in parts])
    return df.withColumn(
        "urn", F.when(readable, F.coalesce(urn, F.lit(S.CONTEXT_SEMANTICS)))
    ).withColumn("geometry", F.when(readable, whole))
