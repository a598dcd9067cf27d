"""The registry of twins as keyed state: the first request that names a twin opens its scope.

The state outlives restarts with the checkpoint. A run with a new checkpoint, say with
another number of partitions, starts from the registry that is there. A scope that was
opened longer ago than ``ttl_ms`` is forgotten and opened anew by the next request.
Needs the RocksDB provider for state:
``spark.sql.streaming.stateStore.providerClass`` =
``org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider``.
"""

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from twinflow.functions.urls import normalize_url

# Executors get the processors with the plan; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OUT = "dt_url string, scope_kind string, first_seen timestamp"
_SALTS = 64


class FirstOfSalt(StatefulProcessor):
    """Lets the first row of a key through and no other."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        for _ in rows:
            pass
        if not self.seen.exists():
            self.seen.update((True,))
            yield pd.DataFrame({"dt_url": [key[0]]})

    def close(self) -> None:
        pass


class Scope(StatefulProcessor):
    """Opens a scope for the first row of a twin; known scopes come from the initial state."""

    def __init__(self, scope_kind: str, ttl_ms: int | None):
        self.scope_kind, self.ttl_ms = scope_kind, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.scope = handle.getValueState("scope", "scope_kind string, first_seen timestamp", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        for _ in rows:
            pass
        if not self.scope.exists():
            now = pd.Timestamp.now("UTC").tz_localize(None)
            self.scope.update((self.scope_kind, now.to_pydatetime()))
            yield pd.DataFrame({"dt_url": [key[0]], "scope_kind": [self.scope_kind], "first_seen": [now]})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        seen = initialState["first_seen"].iloc[0]
        self.scope.update((initialState["scope_kind"].iloc[0], None if pd.isna(seen) else seen.to_pydatetime()))

    def close(self) -> None:
        pass


def opened_scopes(
    requests: DataFrame,
    registry: DataFrame,
    scope_kind: str = "user",
    ttl_ms: int | None = None,
    twin: str = "digital_twin",
) -> DataFrame:
    """The scopes that a stream of requests opens: ``dt_url, scope_kind, first_seen``.

    A twin that most requests name is no hot spot: rows are dealt out by twin and a
    part of their own, and each part lets only its first row on to the twin.
    """
    mode = "processingTime" if ttl_ms else "none"
    urls = requests.select(normalize_url(F.col(twin)).alias("dt_url"), F.pmod(F.xxhash64("*"), F.lit(_SALTS)).alias("salt"))
    urls = urls.where("dt_url is not null")
    firsts = urls.groupBy("dt_url", "salt").transformWithStateInPandas(FirstOfSalt(ttl_ms), "dt_url string", "append", mode)
    known = registry if "first_seen" in registry.columns else registry.withColumn("first_seen", F.lit(None).cast("timestamp"))
    known = known.select("dt_url", "scope_kind", "first_seen").groupBy("dt_url")
    return firsts.groupBy("dt_url").transformWithStateInPandas(
        Scope(scope_kind, ttl_ms), _OUT, "append", mode, initialState=known
    )
