"""Submission of observations to a store, and the registry of twins."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinflow.functions.urls import normalize_url
from twinflow.operators.ranking import rank_in_group
from twinflow.operators.validate import fail_where
from twinflow.schemas import (
    OUTCOME_ACCEPTED,
    OUTCOME_EXISTING,
    OUTCOME_RESOLVED,
    UNRESOLVED_ID,
)

_KEY = ["digital_twin", "observation_id"]
# Requests that name the same observation are spread over this many parts.
_SALTS = 1024
# Rows with their documents that one task sorts.
_A_PART = 1 << 16


def submit_observations(
    observations: DataFrame,
    store: DataFrame,
    row_id: str = "request_id",
    highest: DataFrame | None = None,
    find: Callable[[DataFrame], DataFrame] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Submit so that doing it again changes nothing.

    * no id (-1): a new observation, ``resolved``, with the next free id of
      its twin in ``row_id`` order;
    * id already stored in the twin: ``existing``, the stored row comes back;
    * id not stored: ``accepted``. Of several in one input the first by
      ``row_id`` is accepted and the others get that one as ``existing``.

    ``observations`` needs ``digital_twin``, ``observation_id`` and a unique
    bigint ``row_id``; ``store`` is unique by twin and id. A missing twin is
    the one named ''. The observation columns both sides have (name, urn,
    type, geometry) are the ones a stored row overrides; others pass through.
    ``highest`` (``highest_ids``) spares a scan of the store for its ids.
    ``find`` gets the keys and returns the store's rows with them, or a few more.
    ``parts`` (``parts_of``) is the number of tasks that whole rows are dealt to; without it Spark chooses.

    The input is read several times: hand in a written table
    (``session.staged``) when it is expensive to make.
    """
    payload = [c for c in store.columns if c in observations.columns and c not in _KEY]
    unresolved = F.coalesce("observation_id", F.lit(UNRESOLVED_ID)) == UNRESOLVED_ID
    named = observations.withColumn("digital_twin", F.coalesce("digital_twin", F.lit("")))
    given = named.where(~unresolved)
    fresh = named.where(unresolved)
    if highest is None:
        highest = highest_ids(store)
    taken = highest_ids(given).unionByName(highest)
    return _submit_given(given, store, payload, row_id, find, parts).unionByName(
        _submit_fresh(fresh, taken, row_id, parts)
    )


def parts_of(written: DataFrame) -> int | None:
    """Tasks for the rows of a written table, so that none sorts many more than ``_A_PART`` of them however large
    the table is; few rows are left to Spark."""
    n = written.count()
    # with fewer tasks than shuffle partitions Spark would deal the rows a second time
    least = int(written.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-n // _A_PART)) if n > _A_PART else None


def highest_ids(rows: DataFrame) -> DataFrame:
    """Per twin the largest id, as ``start``."""
    return rows.groupBy("digital_twin").agg(F.max("observation_id").alias("start"))


def _submit_given(
    given: DataFrame,
    store: DataFrame,
    payload: list[str],
    row_id: str,
    find: Callable[[DataFrame], DataFrame] | None,
    parts: int | None,
) -> DataFrame:
    """One id may be named by a large part of all rows, so no step groups or
    joins such rows by twin and id alone: they are first reduced to at most
    ``_SALTS`` rows per id, decided there, and joined back part by part."""
    salted = given.withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(_SALTS)))
    salty = salted.groupBy(*_KEY, "_salt").agg(
        F.min(row_id).alias("_first"),
        *[F.min_by(c, row_id).alias(f"_first_{c}") for c in payload],
    )
    per_id = Window.partitionBy(*_KEY)
    firsts = (salty.repartition(parts, *_KEY) if parts else salty).select(
        *_KEY,
        "_salt",
        F.min("_first").over(per_id).alias("_first"),
        *[F.min_by(f"_first_{c}", "_first").over(per_id).alias(f"_first_{c}") for c in payload],
    )
    # the semi join lets a small input be broadcast to the store, which then
    # is read but not shuffled; the left join after it sees only the matches
    keys = salty.select(*_KEY)
    stored = find(keys) if find else store.join(keys, _KEY, "left_semi")
    stored = stored.select(
        *_KEY, F.lit(True).alias("_stored"), *[F.col(c).alias(f"_stored_{c}") for c in payload]
    )
    winners = firsts.join(stored, _KEY, "left")
    if parts:
        salted = salted.repartition(parts, *_KEY, "_salt")
    joined = salted.join(winners, [*_KEY, "_salt"])

    in_store = F.col("_stored").isNotNull()
    first = F.col(row_id) == F.col("_first")
    outcome = F.when(~in_store & first, OUTCOME_ACCEPTED).otherwise(OUTCOME_EXISTING)

    def winner(c: str) -> Column:
        return (
            F.when(in_store, F.col(f"_stored_{c}"))
            .when(first, F.col(c))
            .otherwise(F.col(f"_first_{c}"))
        )

    return joined.select(
        *[winner(c).alias(c) if c in payload else F.col(c) for c in given.columns],
        outcome.alias("outcome"),
    )


def _submit_fresh(fresh: DataFrame, taken: DataFrame, row_id: str, parts: int | None) -> DataFrame:
    """New ids follow the largest id the twin has, stored or given in this input.

    Where a client took the largest bigint for its own, none are left: such
    rows keep -1 and have no outcome, and the router fails them.
    """
    start = taken.groupBy("digital_twin").agg(
        F.greatest(F.max("start"), F.lit(0)).alias("start")
    )
    ranked = rank_in_group(fresh, "digital_twin", row_id, "_new_id", after=start, parts=parts)
    new_id = F.coalesce("_new_id", F.lit(UNRESOLVED_ID).cast("bigint")).alias("observation_id")
    return ranked.select(
        *[new_id if c == "observation_id" else F.col(c) for c in fresh.columns],
        F.when(F.col("_new_id").isNotNull(), OUTCOME_RESOLVED).alias("outcome"),
    )


def stored_rows(submitted: DataFrame, store: DataFrame) -> DataFrame:
    """The rows a submission adds to its store."""
    return submitted.where(F.col("outcome") != OUTCOME_EXISTING).select(*store.columns)


def fail_unknown_twins(checked: DataFrame, registry: DataFrame) -> DataFrame:
    """Good rows whose twin is not registered fail as ``unknown_twin``."""
    known = contains_twin(checked, registry)
    return fail_where(known, ~F.col("known"), "unknown_twin").drop("known")


def known_twins(df: DataFrame, registry: DataFrame, twin: str = "digital_twin") -> DataFrame:
    """Rows whose twin is registered."""
    return df.join(registry, normalize_url(df[twin]) == registry["dt_url"], "left_semi")


def contains_twin(df: DataFrame, registry: DataFrame, twin: str = "digital_twin") -> DataFrame:
    """All rows with a flag ``known``."""
    urls = registry.select("dt_url", F.lit(True).alias("known"))
    joined = df.join(urls, normalize_url(df[twin]) == urls["dt_url"], "left").drop("dt_url")
    return joined.withColumn("known", F.coalesce("known", F.lit(False)))


def new_twins(
    df: DataFrame, registry: DataFrame | None = None, twin: str = "digital_twin"
) -> DataFrame:
    """The distinct twins that are not registered yet, as normalised addresses.

    Text that is no address is no twin.
    """
    urls = df.select(normalize_url(F.col(twin)).alias("dt_url")).where("dt_url is not null")
    urls = urls.distinct()
    return urls if registry is None else urls.join(registry, "dt_url", "left_anti")


def lookup_scope(
    df: DataFrame,
    registry: DataFrame,
    default_scope: str | None = None,
    twin: str = "digital_twin",
) -> DataFrame:
    """Add ``scope_kind`` of the row's twin; rows without a twin use the
    configured ``default_scope``."""
    scopes = registry.select("dt_url", "scope_kind")
    missing = F.coalesce(F.col(twin), F.lit("")) == ""
    joined = df.join(scopes, normalize_url(df[twin]) == scopes["dt_url"], "left").drop("dt_url")
    return joined.withColumn(
        "scope_kind", F.when(missing, F.lit(default_scope)).otherwise(F.col("scope_kind"))
    )


def create_scopes(
    df: DataFrame,
    registry: DataFrame,
    default_scope: str | None = None,
    scope_kind: str = "user",
    twin: str = "digital_twin",
) -> DataFrame:
    """Get or create: as ``lookup_scope``, but a twin not registered yet has
    the scope that ``register_twins`` would give it; text that is no address
    has none."""
    found = lookup_scope(df, registry, default_scope, twin)
    named = normalize_url(F.col(twin)).isNotNull()
    made = F.when(named, F.coalesce("scope_kind", F.lit(scope_kind)))
    return found.withColumn("scope_kind", made.otherwise(F.col("scope_kind")))


def register_twins(
    df: DataFrame, registry: DataFrame, scope_kind: str = "user", twin: str = "digital_twin"
) -> DataFrame:
    """The registry with the unknown twins of ``df``; known ones stay as they are."""
    added = new_twins(df, registry, twin).withColumn("scope_kind", F.lit(scope_kind))
    if "first_seen" in registry.columns:
        added = added.withColumn("first_seen", F.current_timestamp())
    return registry.unionByName(added.select(*registry.columns))
