"""From JSON documents to routed outcomes."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinflow.operators.documents import split_observation
from twinflow.operators.observations import build_observations
from twinflow.operators.resolve import resolve_observables
from twinflow.operators.routing import all_routes, event_route, route
from twinflow.operators.submit import fail_unknown_twins, parts_of, register_twins, submit_observations
from twinflow.operators.validate import validate_requests
from twinflow.session import staged
from twinflow.sinks.writers import write_routed


def check_requests(
    requests: DataFrame,
    concepts: DataFrame,
    profile: str = "strict",
    require_twin: bool = True,
    federated: bool = False,
    default_twin: str | None = None,
    brought: str | None = None,
) -> DataFrame:
    """Parsed requests, validated, resolved and turned into observations.

    With ``require_twin=False`` a request without a twin goes to
    ``default_twin``, the one the installation is configured for.
    """
    if not require_twin and not default_twin:
        raise ValueError("requests without a twin need a default_twin")
    valid = validate_requests(requests, profile, require_twin)
    checked = resolve_observables(valid, concepts, brought)
    observations = build_observations(checked, federated, profile)
    if not require_twin:
        twin = F.col("digital_twin")
        observations = observations.withColumn(
            "digital_twin", F.when(F.coalesce(twin, F.lit("")) == "", default_twin).otherwise(twin)
        )
    return observations


def check_relayed(documents: DataFrame, concepts: DataFrame, **check) -> DataFrame:
    """Documents that may bring their observable under ``observation``, checked."""
    parts = split_observation(documents).drop("error_code")
    return check_requests(parts, concepts, brought="observation", **check)


def submit_checked(
    checked: DataFrame,
    store: DataFrame,
    with_content: bool = False,
    row_id: str = "request_id",
    highest: DataFrame | None = None,
    find: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Submit the good rows of ``check_requests``, written before, and route all rows."""
    good = checked.where(F.col("error_code").isNull())
    failed = checked.where(F.col("error_code").isNotNull())
    submitted = submit_observations(good, store, row_id, highest, find, parts_of(checked))
    return route(submitted, with_content).unionByName(
        route(failed.withColumn("outcome", F.lit(None).cast("string")))
    )


def run_relayed(
    documents: DataFrame, concepts: DataFrame, store: DataFrame, **check
) -> DataFrame:
    """The observation relay in batch: a success carries the observation as content."""
    checked = staged(check_relayed(documents, concepts, **check), "checked")
    return submit_checked(checked, store, with_content=True)


def run_requests(
    requests: DataFrame,
    concepts: DataFrame,
    store: DataFrame,
    with_content: bool = False,
    **check,
) -> DataFrame:
    """The whole request path in batch.

    Parsing and checking are done once, into a table in the shared folder;
    the submission then reads only the columns it needs from it.
    """
    checked = staged(check_requests(requests, concepts, **check), "checked")
    return submit_checked(checked, store, with_content)


def run_scoped(
    requests: DataFrame,
    concepts: DataFrame,
    store: DataFrame,
    registry: DataFrame,
    scope_kind: str | None = "user",
    with_content: bool = False,
    **check,
) -> tuple[DataFrame, DataFrame]:
    """The request path with the scope stage: outcomes, and the registry afterwards.

    A twin that is not registered is registered with ``scope_kind``, as whoever connects first
    does; where that is None, good rows of unknown twins fail as ``unknown_twin``.
    """
    checked = check_requests(requests, concepts, **check)
    if scope_kind is None:
        # before they are written: the submission reads them several times
        checked = staged(fail_unknown_twins(checked, registry), "checked")
        return submit_checked(checked, store, with_content), registry
    checked = staged(checked, "checked")
    return submit_checked(checked, store, with_content), register_twins(checked, registry, scope_kind)


def write_routes(routed: DataFrame, messages: DataFrame, path: str, mode: str = "append") -> None:
    """All three routes under ``path``: outcomes, and the messages raised meanwhile as events."""
    routed = routed.select("route", "content", "attributes", "error_code", "error_detail")
    write_routed(all_routes(routed, event_route(messages)), path, mode)
