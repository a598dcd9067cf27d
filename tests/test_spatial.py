import random

import pytest
from pyspark.sql import functions as F

from twinflow.operators import spatial
from twinflow.operators.observations import filter_observations
from twinflow.schemas import GEOMETRY


def polygon(a, b, c, d):
    return f"POLYGON(({a} {b}, {c} {b}, {c} {d}, {a} {d}, {a} {b}))"


@pytest.fixture(scope="module")
def boxes(spark):
    """Boxes of all sizes, points, some beyond the extent, some unreadable, with extra columns of the index's names."""
    rng, rows = random.Random(4), []
    for i in range(3000):
        x, y, size = rng.uniform(-200, 200), rng.uniform(-100, 100), 10 ** rng.uniform(-6, 2.8)
        w, h = (0, 0) if i % 5 == 0 else (size, size * rng.choice([0.01, 1, 1]))
        shape = f"POINT({x} {y})" if w == 0 else polygon(x, y, x + w, y + h)
        shape = [None, "garbage", "POLYGON EMPTY"][i % 3] if i % 50 == 0 else f"EPSG:4326 {shape}"
        rows.append((i, f"u{i % 3}", f"t{i % 4}", shape, i * 10, i * 10 + rng.randint(0, 500)))
    df = spark.createDataFrame(rows, "request_id long, urn string, digital_twin string, shape string, a long, b long")
    space = F.struct("shape", F.lit("1.km").alias("sgrid"), F.lit("EPSG:4326").alias("proj"))
    time = F.struct(F.col("a").alias("tstart"), F.col("b").alias("tend"), F.lit("year").alias("tunit"), F.lit(1).alias("tscope"))
    geometry = F.struct(space.alias("space"), time.alias("time")).cast(GEOMETRY).alias("geometry")
    return df.select("request_id", "urn", "digital_twin", geometry)


def ids(df):
    return sorted(r.request_id for r in df.select("request_id").collect())


def test_index_finds_the_same(spark, boxes, tmp_path):
    path = str(tmp_path / "t")
    spatial.write_indexed(boxes, path)
    rng = random.Random(9)
    queries = [(-180, -90, 180, 90), (-300, -300, 300, 300), (0, 0, 0, 0), (179, 89, 400, 400)]
    for _ in range(6):
        x, y, size = rng.uniform(-190, 190), rng.uniform(-95, 95), 10 ** rng.uniform(-3, 2)
        queries.append((x, y, x + size, y + size))
    for q in queries:
        assert ids(spatial.read_indexed(spark, path, bbox=q)) == ids(filter_observations(boxes, bbox=q))
    how = {"urns": ["u1"], "twins": ["t1", "t2"], "interval": (5000, 9000), "bbox": (-90, -45, 90, 45)}
    found = spatial.read_indexed(spark, path, **how)
    assert ids(found) == ids(filter_observations(boxes, **how)) != []
    assert found.columns == boxes.columns
    assert ids(spatial.read_indexed(spark, path, urns=["u0"])) == ids(filter_observations(boxes, urns=["u0"]))


def test_a_small_box_reads_little(spark, boxes, tmp_path):
    path = str(tmp_path / "t")
    points = boxes.where("request_id % 5 = 0")  # boxes of one size; each size has ranges of its own
    rows = spatial.indexed(points).repartitionByRange(12, "cell", "tstart").sortWithinPartitions("cell", "tstart")
    rows.write.parquet(path)

    def scanned(df):
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().collectLeaves()
        return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.length()))

    spark.conf.set("spark.sql.adaptive.forceApply", "true")  # even without an exchange
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = spatial.read_indexed(spark, path, bbox=(10, 10, 10.5, 10.5))._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(cell," in plan and "LessThanOrEqual(min_x,10.5)" in plan
        few = scanned(spatial.read_indexed(spark, path, bbox=(10, 10, 10.5, 10.5)))
        many = scanned(spatial.read_indexed(spark, path, bbox=(-100, -60, 100, 60)))
        assert 2 * few <= many <= 600
    finally:
        spark.conf.unset("spark.sql.adaptive.forceApply")
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_ranges_hold_the_cells_of_overlapping_boxes(spark):
    rng = random.Random(1)
    for _ in range(300):
        level = rng.randint(0, 6)
        x0, x1 = sorted(rng.randint(0, 2**level - 1) for _ in range(2))
        y0, y1 = sorted(rng.randint(0, 2**level - 1) for _ in range(2))
        spans = spatial._covered(level, x0, x1, y0, y1, 4)
        assert len(spans) <= 4 and all(a <= b for a, b in spans)
        for x in (x0, x1):
            for y in (y0, y1):
                number = sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(level))
                assert any(a <= number <= b for a, b in spans)


def test_rows_are_made_and_parsed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    shape = F.concat(F.lit("EPSG:4326 POINT("), F.col("id").cast("string"), F.lit(" 3)"))
    made = spark.range(50, numPartitions=3).select("id", shape.alias("shape")).mapInPandas(counted, "id long, shape string")
    space, time = F.struct("shape"), F.struct(F.col("id").alias("tstart"), F.col("id").alias("tend"))
    rows = made.select("id", F.struct(space.alias("space"), time.alias("time")).alias("geometry"))
    spatial.write_indexed(rows, str(tmp_path / "once"))
    assert seen.value == 50
    assert spark.read.parquet(str(tmp_path / "once")).where("cell is not null and min_y = 3").count() == 50
    # neither the text's parsing nor the box is repeated in the expression
    plan = spatial.indexed(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= 6 and len(plan) < 60_000
