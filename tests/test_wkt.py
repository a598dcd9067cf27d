import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from twinflow.functions import wkt

LONG = ", ".join(f"{i} {i * i}" for i in range(20000))

GOOD = [
    "POLYGON((0 0, 1 0, 1 1, 0 0))",
    "POLYGON((0 0, 1 0, 1 1, 0.0 0e0))",
    "polygon ((0 0,9 0,9 9,0 0),(1 1,2 1,2 2,1 1))",
    "POINT(1 2)",
    "POINT Z (1 2 3)",
    "POINT(1e3 -2.5E-2)",
    "POINT EMPTY",
    "POLYGON EMPTY",
    "  POINT ( 1 2 ) ",
    "\n POLYGON ((0 0, 1 0,\n 1 1,\n\t0 0))\n",
    "LINESTRING(0 0, 1 1)",
    "LINEARRING(0 0, 1 0, 1 1, 0 0)",
    "MULTIPOINT((1 2), (3 4))",
    "MULTIPOINT(1 2, 3 4)",
    "MULTILINESTRING((0 0, 1 1), (2 2, 3 3))",
    "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))",
    "POLYGON Z((0 0 1, 1 0 2, 1 1 3, 0 0 4))",
    "POLYGON ZM((0 0 1 1, 1 0 2 1, 1 1 3 1, 0 0 4 1))",
    "GEOMETRYCOLLECTION EMPTY",
    "GEOMETRYCOLLECTION(POINT(1 2), LINESTRING(0 0, 1 1))",
    "GEOMETRYCOLLECTION(GEOMETRYCOLLECTION(GEOMETRYCOLLECTION(POINT(1 2))), POLYGON((0 0, 1 0, 1 1, 0 0)))",
    f"POLYGON(({LONG}, 0 0))",
    f"LINESTRING({LONG})",
    f"MULTIPOINT({LONG})",
]
BAD = [
    None,
    "",
    "hello",
    "#",
    "POINT(1)",
    "POINT(1 2",
    "POINT(1 2) x",
    "XPOINT(1 2)",
    "POINT(1 2)POINT(1 2)",
    "POINT Z (1 2)",
    "POINT(a b)",
    "LINESTRING(1 2)",
    "POLYGON((0 0, 1 0, 1 1, 0 1))",
    "POLYGON((0 0, 1 0, 0 0))",
    "POLYGON((0 0, 1 0, 1 1, 0 0)",
    "POLYGON((0 0, 9 0, 9 9, 0 0), (1 1, 2 1, 2 2, 1 2))",
    "MULTILINESTRING(0 0, 1 1)",
    "MULTIPOLYGON(((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 6)))",
    "GEOMETRYCOLLECTION(#)",
    "GEOMETRYCOLLECTION(POLYGON((0 0, 1 0, 1 1, 0 1)))",
    "GEOMETRYCOLLECTION(POINT(1 2)",
    f"POLYGON(({LONG}))",
    f"POLYGON(({LONG}, 0 0)",
]


def test_is_wkt(spark):
    rows = [(t, True) for t in GOOD] + [(t, False) for t in BAD]
    df = spark.createDataFrame(rows, "t string, want boolean")
    wrong = df.where(wkt.is_wkt(F.col("t")) != F.col("want")).select(F.substring("t", 1, 80))
    assert wrong.collect() == []


def test_prefix_is_split_off_again(spark):
    rows = [("EPSG:4326", t) for t in GOOD if t == t.strip()]
    df = spark.createDataFrame(rows, "proj string, t string")
    shape = wkt.prefixed(F.col("proj"), F.col("t"))
    back = df.where((wkt.proj_of(shape) != F.col("proj")) | (wkt.wkt_of(shape) != F.col("t")))
    assert back.count() == 0


def test_text_without_prefix(spark):
    row = spark.range(1).select(
        wkt.proj_of(F.lit("POINT(1 2)")).alias("p"), wkt.wkt_of(F.lit(" POINT(1 2)")).alias("w")
    ).first()
    assert (row.p, row.w) == (None, "POINT(1 2)")


boxes = st.lists(
    st.tuples(*[st.integers(-180_000_000, 180_000_000).map(lambda i: i / 1e6)] * 4),
    min_size=1,
    max_size=40,
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(boxes)
def test_bbox_round_trip(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    text = wkt.bbox_to_wkt(*[F.col(c) for c in "abcd"])
    got = df.select(wkt.is_wkt(text).alias("ok"), wkt.bbox(text).alias("x"), "*").collect()
    for r in got:
        assert r.ok
        want = (min(r.a, r.c), min(r.b, r.d), max(r.a, r.c), max(r.b, r.d))
        assert tuple(r.x) == pytest.approx(want, abs=1e-9)


def test_coords_to_wkt(spark):
    rows = [
        ([(1.0, 2.0)], "POINT(1.0 2.0)"),
        ([(1.0, 2.0), (3.0, 4.0)], "LINESTRING(1.0 2.0, 3.0 4.0)"),
        (
            [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)],
            "POLYGON((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0))",
        ),
        (
            [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)],
            "POLYGON((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0))",
        ),
        (
            [(0.0, 0.0), (1e-7, 0.0), (1e-7, 1e-7)],
            "POLYGON((0.0 0.0, 1.0E-7 0.0, 1.0E-7 1.0E-7, 0.0 0.0))",
        ),
        ([], None),
        (None, None),
    ]
    df = spark.createDataFrame(rows, "c array<struct<x double, y double>>, want string")
    assert df.where(~wkt.coords_to_wkt(F.col("c")).eqNullSafe(F.col("want"))).count() == 0
