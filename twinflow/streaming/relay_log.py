"""A relay that reads its source once for any number of listeners.

The relay appends messages to a log of steps; what it cannot read goes to the log's failures. Every
listener has an offset of its own, the last step it was given, so it can stop, start late and
fall behind without the source being read again. A step that a listener fails on is given
again up to a number of attempts, which outlive a restart; then it is given in parts, halved down
to single messages, and those that still fail are put aside as dead letters. So one poisoned message
stops neither its listener nor another one. A listener may get a step or a part of it again
after a failure; the step's number and the part's name tell.
"""

import logging
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from twinflow.operators.messages import relay_messages
from twinflow.schemas import DEFAULT_QUEUES
from twinflow.sources.messages import malformed_messages
from twinflow.streaming import commits

EVENT = T.StructType(
    [
        T.StructField("message_id", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("event_ts", T.TimestampType()),
    ]
)
FAILURE = T.StructType([T.StructField(c, T.StringType()) for c in ("route", "content", "error_code")])
_log = logging.getLogger(__name__)
HALVES = 24  # how often a step is halved at most
Handler = Callable[[DataFrame, int, str], None]


def relay(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    queues: Iterable[str] = DEFAULT_QUEUES,
    once: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Append the messages of the queues to the log at ``path``, a step per batch.

    With a column ``malformed`` (``parse_messages``) unreadable records become failures instead.
    """
    writer, queues = commits.Writer(path), list(queues)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        if writer.open(spark).has(run, batch_id):
            return
        folders = {}
        good = batch
        if "malformed" in batch.columns:
            folder = commits.new_folder(f"{path}/failures", run, batch_id)
            malformed_messages(batch).write.parquet(folder)
            folders["failures"] = [folder]
            good = batch.where("not malformed")
        folder = commits.new_folder(f"{path}/events", run, batch_id)
        relay_messages(good, queues).select(*EVENT.fieldNames()).write.parquet(folder)
        folders["events"] = [folder]
        writer.commit(spark, folders, run, batch_id)

    stream = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step)
    return (stream.trigger(availableNow=True) if once else stream.trigger(processingTime=every)).start()


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return commits.read(spark, commits.state(spark, path), "events", EVENT)


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    return commits.read(spark, commits.state(spark, path), "failures", FAILURE)


def dead_letters(spark: SparkSession, path: str, listener: str) -> DataFrame:
    return commits.read(spark, commits.state(spark, _place(path, listener)), "dead", EVENT)


def _place(path: str, listener: str) -> str:
    return f"{path}/listeners/{listener}"


def deliver(spark: SparkSession, path: str, listener: str, handle: Handler, attempts: int = 3) -> int:
    """Give a listener all steps behind its offset, in order; returns how many.

    ``handle`` gets the events, the step's number and the name of the part, ``""`` for the whole step.
    A listener has one deliverer; one that starts fences the one before.
    """
    place = _place(path, listener)
    writer = commits.Writer(place)
    now = writer.open(spark)
    given = 0
    for version, folders in commits.steps(spark, path):
        if now.has("given", version) or "events" not in folders:
            continue
        events = spark.read.schema(EVENT).parquet(*folders["events"])
        tried = now.done.get(f"tried-{version}", 0)
        done = False
        while not done and tried < attempts:
            tried += 1
            writer.commit(spark, {}, f"tried-{version}", tried)  # counted before, as a handler may end the process
            try:
                handle(events, version, "")
                done = True
            except Exception as error:
                _log.warning("%s, step %s, attempt %s: %s", listener, version, tried, error)
        dead = {}
        if not done:
            poisoned = _halved(events, version, handle, 0, 0)
            folder = commits.new_folder(f"{place}/dead", "given", version)
            poisoned.write.parquet(folder)
            dead = {"dead": [folder]}
        writer.commit(spark, dead, "given", version)
        given += 1
    return given


def _halved(events: DataFrame, version: int, handle: Handler, depth: int, rest: int) -> DataFrame:
    """Give the part of a step with this remainder; what fails to the last is returned."""
    side = 1 << depth
    part = events.where(F.pmod(F.xxhash64("message_id", "payload"), F.lit(side)) == rest)
    if part.isEmpty():
        return part
    try:
        if depth:  # the whole has been tried
            handle(part, version, f"{rest}-of-{side}")
            return part.limit(0)
    except Exception:
        if depth == HALVES or part.limit(2).count() == 1:
            return part
    low = _halved(events, version, handle, depth + 1, rest)
    return low.unionByName(_halved(events, version, handle, depth + 1, rest + side))
