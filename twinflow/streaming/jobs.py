"""Streams of requests and messages.

Each job takes a checkpoint folder of its own. Sources are replayed from it
after a failure, and every sink here takes a replayed batch without writing
it twice.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from twinflow import schemas as S
from twinflow.operators.messages import relay_messages
from twinflow.operators.monitor import message_rates
from twinflow.operators.submit import fail_unknown_twins, highest_ids, new_twins, stored_rows
from twinflow.plans.pipeline import check_requests, submit_checked
from twinflow.sinks.writers import request_payloads
from twinflow.sources.requests import with_request_ids
from twinflow.streaming import commits
from twinflow.streaming.store import matching, stored, write_folded

Listener = Callable[[DataFrame, int], None]


def _triggered(writer: DataStreamWriter, once: bool, every: str) -> DataStreamWriter:
    """All that is there now and stop, or a batch every so often."""
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    once: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Append to files; each input row ends up in them exactly once."""
    writer = df.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer.option("path", path), once, every).start()


def send_requests(df: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Requests as JSON lines into a landing folder."""
    return write_stream(request_payloads(df).select("value"), path, checkpoint, "text", **kw)


def relay(
    messages: DataFrame, path: str, checkpoint: str, queues=S.DEFAULT_QUEUES, **kw
) -> StreamingQuery:
    """The message relay: subscribed queues, attributes, append to files."""
    return write_stream(relay_messages(messages, queues), path, checkpoint, **kw)


def fan_out(
    df: DataFrame,
    listeners: dict[str, Listener],
    checkpoint_root: str,
    once: bool = False,
    every: str = "10 seconds",
) -> dict[str, StreamingQuery]:
    """Give every batch to every listener, each in a query of its own.

    A listener that raises ends its query and no other. Adding a listener is
    starting a query, removing one is ``query.stop()``. A batch may come
    again after a failure; its id tells.
    """
    queries = {}
    for name, listener in listeners.items():
        writer = (
            df.writeStream.queryName(name)
            .option("checkpointLocation", f"{checkpoint_root}/{name}")
            .foreachBatch(listener)
        )
        queries[name] = _triggered(writer, once, every).start()
    return queries


def wait_all(
    queries: dict[str, StreamingQuery], until_failure: bool = False, look_every: int = 1
) -> dict[str, str]:
    """Wait for the queries; the message of those that failed, by name.

    All are looked at in turn, so that with ``until_failure`` the first failure
    is returned while endless queries go on.
    """
    failed = {}
    running = dict(queries)
    while running and not (until_failure and failed):
        for name, query in list(running.items()):
            try:
                ended = query.awaitTermination(look_every)
            except Exception as e:
                failed[name], ended = str(e), True
            if ended:
                del running[name]
    return failed


def rates(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 hour",
    late: str = "10 minutes",
    **kw,
) -> StreamingQuery:
    """Message rates of closed windows; each is written once, when the watermark has passed it.

    Messages without a usable time and those that come after their window was closed
    are left out, as Spark drops them; ``count_messages`` keeps all.
    """
    return write_stream(message_rates(messages, width, late), path, checkpoint, **kw)


def _run_of(batch: DataFrame) -> str:
    """The identity of the query a batch belongs to.

    Spark keeps it in the checkpoint: a restart has the same one, and a new
    checkpoint, whose batches start at 0 again, another.
    """
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return run or "direct"


def _write(df: DataFrame, schema: T.StructType, folder: str) -> list[str]:
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    rows.write.parquet(folder)
    return [folder]


def _stepped(
    source: DataFrame, step: Listener, checkpoint: str, once: bool, every: str
) -> StreamingQuery:
    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    return _triggered(writer, once, every).start()


def _seed(spark: SparkSession, path: str, tables: dict[str, tuple[DataFrame, T.StructType]]) -> None:
    """What is there before the first batch; where it was laid down already nothing changes."""
    writer = commits.Writer(path)
    if writer.open(spark).has("seed", 0):
        return
    folders = {
        name: _write(rows, schema, commits.new_folder(f"{path}/{name}", "seed", 0))
        for name, (rows, schema) in tables.items()
    }
    writer.commit(spark, folders, "seed", 0)


def _scopes(registry: DataFrame) -> DataFrame:
    if "first_seen" in registry.columns:
        return registry
    return registry.withColumn("first_seen", F.lit(None).cast("timestamp"))


_RATES = T.StructType(
    [
        T.StructField("window_start", T.LongType()),
        T.StructField("window_end", T.LongType()),
        T.StructField("queue", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)


def count_messages(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 hour",
    once: bool = False,
    every: str = "10 seconds",
    fold_every: int = 0,
) -> StreamingQuery:
    """Message rates that lose no message, for ``read_rates``.

    Every batch adds its own counts, late messages and those under a null window too;
    open windows are there like closed ones. Nothing is kept as state, so there is no watermark to
    choose. Counts are committed whole; a batch that comes again adds nothing.
    """
    writer = commits.Writer(path)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, _run_of(batch)
        if writer.open(spark).has(run, batch_id):
            return
        folder = commits.new_folder(f"{path}/counts", run, batch_id)
        counts = _write(message_rates(batch, width), _RATES, folder)
        writer.commit(spark, {"counts": counts}, run, batch_id)
        if fold_every and batch_id % fold_every == fold_every - 1:
            fold_rates(spark, path, writer)

    return _stepped(messages, step, checkpoint, once, every)


def _summed(spark: SparkSession, now: commits.State) -> DataFrame:
    counts = commits.read(spark, now, "counts", _RATES)
    return counts.groupBy("window_start", "window_end", "queue", "type").agg(F.sum("n").alias("n"))


def read_rates(spark: SparkSession, path: str, late_ms: int | None = None) -> DataFrame:
    """The counts of all committed batches. With ``late_ms`` only windows that ended so long before
    the newest window began; more can only come for them from messages later than that."""
    rows = _summed(spark, commits.state(spark, path))
    if late_ms is None:
        return rows
    newest = rows.agg((F.max("window_start") - late_ms).alias("closed"))
    return rows.join(F.broadcast(newest), F.col("window_end") <= F.col("closed"), "left_semi")


def fold_rates(spark: SparkSession, path: str, writer: commits.Writer | None = None) -> None:
    """One row per window, queue and type in place of one per batch."""
    writer = writer or commits.Writer(path)
    now = writer.open(spark)
    folder = commits.new_folder(f"{path}/counts", "fold", now.version)
    writer.replace(spark, now, {"counts": _write(_summed(spark, now), _RATES, folder)})


def seed_registry(registry: DataFrame, path: str) -> None:
    """Lay down the twins known before the first batch (there may be none)."""
    _seed(registry.sparkSession, path, {"registry": (_scopes(registry), S.SCOPE)})


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The twins of all committed steps, of a registry's folder or a store's."""
    return commits.read(spark, commits.state(spark, path), "registry", S.SCOPE)


def _added_twins(rows: DataFrame, known: DataFrame, scope_kind: str) -> DataFrame:
    """The twins seen for the first time. The rows are reduced to distinct twins before
    anything is shuffled, so it does not matter how many requests name the same one."""
    return new_twins(rows, known).select(
        "dt_url", F.lit(scope_kind).alias("scope_kind"), F.current_timestamp().alias("first_seen")
    )


def register(
    requests: DataFrame,
    path: str,
    checkpoint: str,
    scope_kind: str = "user",
    once: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Add each twin to the registry at ``path`` the first time it is seen.

    One writer at a time: a query that starts fences the one before it.
    """
    writer = commits.Writer(path)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, _run_of(batch)
        now = writer.open(spark)
        if now.has(run, batch_id):
            return
        known = commits.read(spark, now, "registry", S.SCOPE)
        added = _added_twins(batch, known, scope_kind)
        folder = commits.new_folder(f"{path}/registry", run, batch_id)
        writer.commit(spark, {"registry": _write(added, S.SCOPE, folder)}, run, batch_id)

    return _stepped(requests, step, checkpoint, once, every)


# Largest id per twin, kept beside the store so that no batch has to scan it for that.
_HEADS = T.StructType(
    [T.StructField("digital_twin", T.StringType()), T.StructField("start", T.LongType())]
)


def seed_store(store: DataFrame, path: str, registry: DataFrame | None = None) -> None:
    """Lay down an existing store (or an empty one) ahead of the first batch, and the
    twins known then; without ``registry`` those of the store."""
    if registry is None:
        registry = new_twins(store).withColumn("scope_kind", F.lit("user"))
    tables = {
        "rows": (store, S.OBSERVATION),
        "heads": (highest_ids(store), _HEADS),
        "registry": (_scopes(registry), S.SCOPE),
    }
    _seed(store.sparkSession, path, tables)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed steps."""
    return stored(spark, commits.state(spark, path))


def read_outcomes(spark: SparkSession, store_path: str) -> DataFrame:
    """The outcomes of all committed steps, with ``route``, ``run`` and ``batch_id``; files of
    attempts that broke are not seen."""
    folders = commits.state(spark, store_path).folders.get("outcomes", [])
    if not folders:
        raise FileNotFoundError(f"no step was committed to {store_path}")
    places: dict[str, list[str]] = {}
    for folder in folders:
        places.setdefault(folder.partition("/run=")[0], []).append(folder)
    parts = [spark.read.option("basePath", p).parquet(*fs) for p, fs in places.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).drop("try")


def submit_batch(
    concepts: DataFrame,
    store_path: str,
    out_path: str,
    work_path: str,
    checker: Callable[..., DataFrame] = check_requests,
    with_content: bool = False,
    scope_kind: str | None = "user",
    fold_every: int = 0,
    **check,
) -> Listener:
    """The batch step of ``submit``.

    Rows are numbered, parsed and checked once into ``work_path``. Twins that are
    not in the registry are registered with ``scope_kind``; where it is None, good rows
    of theirs fail as ``unknown_twin``. Outcomes
    under ``out_path``, store rows, largest ids and twins become visible at once
    with the step's manifest under ``store_path``, or not at all: a step that breaks
    anywhere leaves files that nobody reads, and is done again from what was
    committed. A step that comes again after its manifest does nothing. A
    run that starts takes the store over; one that still writes then ends with
    ``commits.Fenced``. Request ids made here are unique within a batch;
    ``run``, ``batch_id`` and ``request_id`` together name an outcome.
    ``checker=check_relayed`` with ``with_content=True`` makes it the
    observation relay. ``fold_every`` folds the store each so many batches.

    A batch is matched with the store by key only; see ``store.matching``.
    """
    writer = commits.Writer(store_path)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, _run_of(batch)
        now = writer.open(spark)
        if now.has(run, batch_id):
            return
        rows = batch if "request_id" in batch.columns else with_request_ids(batch)
        checked = checker(rows, concepts, **check)
        work, schema = commits.new_folder(f"{work_path}/checked", run, batch_id), checked.schema
        checked.write.parquet(work)
        checked = spark.read.schema(schema).parquet(work)
        known = commits.read(spark, now, "registry", S.SCOPE)
        if scope_kind is None:
            checked = fail_unknown_twins(checked, known)
        heads = commits.read(spark, now, "heads", _HEADS)
        store = commits.read(spark, now, "rows", S.OBSERVATION)
        outcomes = submit_checked(
            checked, store, with_content, highest=heads, find=lambda keys: matching(spark, now, keys)
        )
        out = commits.new_folder(out_path, run, batch_id)
        outcomes.write.partitionBy("route").parquet(out)
        written = spark.read.schema(outcomes.schema).parquet(out)
        success = written.where(F.col("route") == S.ROUTE_SUCCESS)
        added = stored_rows(success, store)
        folders = {"outcomes": [out]}
        folders["rows"] = _write(added, S.OBSERVATION, commits.new_folder(f"{store_path}/rows", run, batch_id))
        taken = commits.read(spark, commits.State(folders=folders), "rows", S.OBSERVATION)
        folders["heads"] = _write(highest_ids(taken), _HEADS, commits.new_folder(f"{store_path}/heads", run, batch_id))
        if scope_kind is not None:
            twins = _added_twins(checked, known, scope_kind)
            folders["registry"] = _write(twins, S.SCOPE, commits.new_folder(f"{store_path}/registry", run, batch_id))
        writer.commit(spark, folders, run, batch_id)
        commits.drop(spark, work)
        if fold_every and batch_id % fold_every == fold_every - 1:
            fold(spark, store_path, writer)

    return step


def fold(spark: SparkSession, store_path: str, writer: commits.Writer | None = None) -> None:
    """Make one bucketed table of all store rows, one row a twin of the largest ids, and
    one folder of the registry; outcomes stay. What was folded stays on disk, for readers that began
    before, until ``commits.sweep``. Without ``writer``, running writers are fenced."""
    writer = writer or commits.Writer(store_path)
    now = writer.open(spark)
    heads = commits.read(spark, now, "heads", _HEADS)
    heads = heads.groupBy("digital_twin").agg(F.max("start").alias("start"))
    twins = commits.read(spark, now, "registry", S.SCOPE)

    def folder(table: str) -> str:
        return commits.new_folder(f"{store_path}/{table}", "fold", now.version)

    folders = {
        "rows": [],
        "folded": [write_folded(stored(spark, now), f"{store_path}/rows", now.version)],
        "heads": _write(heads, _HEADS, folder("heads")),
        "registry": _write(twins.repartition("dt_url"), S.SCOPE, folder("registry")),
    }
    writer.replace(spark, now, folders)


def submit(
    requests: DataFrame,
    concepts: DataFrame,
    store_path: str,
    out_path: str,
    work_path: str,
    checkpoint: str,
    once: bool = False,
    every: str = "10 seconds",
    **check,
) -> StreamingQuery:
    """Check, register, resolve, submit and route requests as they come."""
    step = submit_batch(concepts, store_path, out_path, work_path, **check)
    return _stepped(requests, step, checkpoint, once, every)
