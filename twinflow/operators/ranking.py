"""Consecutive numbers within a group that may be a large part of all rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows are counted in blocks of 2**18 order values, blocks in runs of 2**22.
# With unique bigint order values a window below holds at most 2**18 rows, 2**22
# blocks or 2**24 runs, whatever the size of a group.
_BLOCK_BITS = 18
_RUN_BITS = 22


def rank_in_group(
    df: DataFrame,
    group: str,
    order: str,
    name: str = "rank",
    after: DataFrame | None = None,
    parts: int | None = None,
) -> DataFrame:
    """1, 2, 3, ... by ``order`` within each ``group``.

    ``order`` is a unique bigint, ``group`` is not null. A plain
    ``row_number`` would sort a whole group in one task; here each block is
    numbered alone and moved up by the rows in the blocks before it.

    ``after`` (``group``, ``start``; one row per group) makes a group begin
    behind ``start``. It is joined to the few counts, not to the rows. A number
    beyond the largest bigint is null. ``parts`` is the number of tasks that number the rows.
    """
    block, run = "_block", "_run"
    rows = df.withColumn(block, F.shiftright(order, _BLOCK_BITS))

    counts = rows.groupBy(group, block).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn(run, F.shiftright(block, _RUN_BITS))

    def before(*partition: str, by: str):
        window = Window.partitionBy(*partition).orderBy(by)
        return F.coalesce(
            F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )

    in_run = counts.withColumn("_in_run", before(group, run, by=block))
    runs = counts.groupBy(group, run).agg(F.sum("_n").alias("_n"))
    runs = runs.withColumn("_runs", before(group, by=run)).drop("_n")
    if after is not None:
        started = F.try_add("_runs", F.coalesce("start", F.lit(0)))
        runs = runs.join(after, group, "left").select(group, run, started.alias("_runs"))
    offsets = in_run.join(runs, [group, run]).select(
        group, block, F.try_add("_in_run", "_runs").alias("_before")
    )
    inside = Window.partitionBy(group, block).orderBy(order)
    if parts:
        rows = rows.repartition(parts, group, block)
    return (
        rows.join(offsets, [group, block])
        .withColumn(name, F.try_add("_before", F.row_number().over(inside).cast("long")))
        .drop(block, "_before")
    )
