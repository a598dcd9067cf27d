"""Observations laid out by place and time, so that a filter reads little of them.

Every box is in a cell of a quadtree: of the deepest level whose cells are as large as the
box, the cell with its lower left corner. Cells of a level are numbered along a space-filling curve,
which keeps neighbours together. A table sorted by level and number keeps what lies close in
a few row groups, and the box of a query becomes a few ranges of numbers per level, which Spark
pushes down to the scan, together with the bounds of the stored boxes and times.

A box that overlaps the query's has its corner at most one cell to the left of it and below it, as
a cell is as large as the box. Corners beyond the extent count to the cells at its edge, and so does the
query, so they are found as well. Observations without a readable shape have no box and no cell;
a filter with a box does not keep them.
"""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinflow.functions import wkt
from twinflow.session import staged

LEVELS = 14  # below the whole extent
WORLD = (-180.0, -90.0, 180.0, 90.0)
RANGES = 6  # of a query's box, per level
BOX = ("min_x", "min_y", "max_x", "max_y")
ADDED = ("cell", *BOX, "tstart", "tend")
Box = tuple[float, float, float, float]


def _spread(v: Column) -> Column:
    """Bits 0, 1, 2 and so on to places 0, 2, 4: the binary digits, read as those of base four."""
    return F.conv(F.bin(v), 4, 10).cast("long")


def _step(value: Column, low: float, size: float, level: Column) -> Column:
    cells = F.pow(F.lit(2.0), level)
    at = F.floor((value - low) / size * cells)
    return F.greatest(F.lit(0), F.least(at, cells - 1)).cast("long")


def cell_of(box: Column, extent: Box = WORLD) -> Column:
    """Level and number of a box's cell as one bigint, null without a box."""
    width, height = extent[2] - extent[0], extent[3] - extent[1]

    def deepest(size: float, side: Column) -> Column:
        # a little less, so that rounding never makes a cell smaller than the box
        return F.when(side > 0, F.floor(F.log2(F.lit(size) / side) - 1e-9)).otherwise(LEVELS)

    fitting = F.least(deepest(width, box["max_x"] - box["min_x"]), deepest(height, box["max_y"] - box["min_y"]))
    level = F.greatest(F.lit(0), F.least(fitting, F.lit(LEVELS))).cast("long")

    def numbered(level: Column) -> Column:
        x, y = _step(box["min_x"], extent[0], width, level), _step(box["min_y"], extent[1], height, level)
        return level * (1 << 2 * LEVELS) + _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1))

    number = F.transform(F.array(level), numbered)[0]
    return F.when(box["min_x"].isNotNull() & box["min_y"].isNotNull(), number)


def _covered(level: int, x0: int, x1: int, y0: int, y1: int, most: int) -> list[tuple[int, int]]:
    """Ranges of numbers, ``most`` or fewer, with all cells x0..x1, y0..y1 of a level and maybe more."""
    inside, open_ = [], [(0, 0, 0)]  # quadrants as (depth, x, y)
    while open_ and len(inside) + len(open_) <= 4 * most:
        depth, x, y = open_.pop(0)
        side = 1 << level - depth
        left, low = x * side, y * side
        if left > x1 or left + side <= x0 or low > y1 or low + side <= y0:
            continue
        if left >= x0 and left + side - 1 <= x1 and low >= y0 and low + side - 1 <= y1:
            inside.append((depth, x, y))
        else:
            open_ += [(depth + 1, 2 * x + i, 2 * y + j) for j in (0, 1) for i in (0, 1)]

    def number(x: int, y: int) -> int:
        return sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(LEVELS))

    spans = sorted((number(x, y) * 4 ** (level - d), (number(x, y) + 1) * 4 ** (level - d) - 1) for d, x, y in inside + open_)
    while True:
        joined = spans[:1]
        for low, high in spans[1:]:
            if low <= joined[-1][1] + 1:
                joined[-1] = joined[-1][0], max(joined[-1][1], high)
            else:
                joined.append((low, high))
        if len(joined) <= most:
            return joined
        gap, k = min((joined[i + 1][0] - joined[i][1], i) for i in range(len(joined) - 1))
        spans = [*joined[:k], (joined[k][0], joined[k + 1][1]), *joined[k + 2 :]]


def cell_ranges(bbox: Box, extent: Box = WORLD, most: int = RANGES) -> list[tuple[int, int]]:
    """Ranges of ``cell`` that hold all boxes overlapping ``bbox``."""
    out = []
    for level in range(LEVELS + 1):
        bounds = []
        for axis in (0, 1):
            size, cells = extent[axis + 2] - extent[axis], 1 << level
            side = size / cells
            at = [(bbox[axis] - side - extent[axis]) / size * cells - 1e-6, (bbox[axis + 2] - extent[axis]) / size * cells + 1e-6]
            bounds += [int(max(0, min(cells - 1, v // 1))) for v in at]
        base = level * (1 << 2 * LEVELS)
        out += [(base + a, base + b) for a, b in _covered(level, *bounds, most)]
    return out


def indexed(df: DataFrame, extent: Box = WORLD) -> DataFrame:
    """Adds the cell, the box and the times as columns of their own."""
    # bound step by step: the box names the text's ordinates many times, the cell the box, and each would be the whole
    # text's parsing
    text = F.array(wkt.wkt_of(F.col("geometry.space.shape")))
    place = F.transform(F.transform(text, wkt.bbox), lambda b: F.struct(cell_of(b, extent).alias("cell"), *[b[c].alias(c) for c in BOX]))[0]
    rows = df.drop(*ADDED).withColumn("_place", place)
    rows = rows.withColumns({c: F.col(f"_place.{c}") for c in ("cell", *BOX)} | {c: F.col(f"geometry.time.{c}") for c in ("tstart", "tend")})
    return rows.drop("_place")


def write_indexed(df: DataFrame, path: str, extent: Box = WORLD, mode: str = "errorifexists") -> None:
    """Write observations for ``read_indexed``, sorted by cell and start."""
    # written first: ranges are drawn from a sample, and that reads the rows once more
    rows = staged(indexed(df, extent), "placed").repartitionByRange("cell", "tstart").sortWithinPartitions("cell", "tstart")
    rows.write.mode(mode).parquet(path)


def read_indexed(
    spark: SparkSession,
    path: str,
    urns: Iterable[str] | None = None,
    twins: Iterable[str] | None = None,
    bbox: Box | None = None,
    interval: tuple[int, int] | None = None,
    extent: Box = WORLD,
) -> DataFrame:
    """``filter_observations`` over a table of ``write_indexed``; the same rows, fewer read.

    ``extent`` is the one it was written with.
    """
    rows = spark.read.parquet(path)
    if urns is not None:
        rows = rows.where(F.col("urn").isin(*urns))
    if twins is not None:
        rows = rows.where(F.col("digital_twin").isin(*twins))
    if interval is not None:
        rows = rows.where((F.col("tstart") < interval[1]) & (F.col("tend") > interval[0]))
    if bbox is not None:
        ranges = [F.col("cell").between(a, b) for a, b in cell_ranges(bbox, extent)]
        while len(ranges) > 1:  # in pairs, so that the expression stays flat
            ranges = [reduce(Column.__or__, ranges[i : i + 2]) for i in range(0, len(ranges), 2)]
        rows = rows.where(ranges[0]).where(
            (F.col("min_x") <= bbox[2]) & (F.col("max_x") >= bbox[0]) & (F.col("min_y") <= bbox[3]) & (F.col("max_y") >= bbox[1])
        )
    return rows.drop(*ADDED)
