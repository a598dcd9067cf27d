import math
import random
from fractions import Fraction

import pandas as pd
from pyspark.sql import functions as F

from twinflow.functions import shapes

SCHEMA = "c array<struct<x double, y double>>, want boolean"


def circle(n, step=1):
    return [(math.cos(2 * math.pi * i * step / n), math.sin(2 * math.pi * i * step / n)) for i in range(n)]


CASES = [
    ([(0, 0)], True),
    ([(0, 0), (1, 1)], True),
    ([(0, 0), (0, 0)], False),
    ([(0, 0), (1, 0), (1, 1), (0, 1)], True),
    ([(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)], True),
    ([(0, 0), (0, 0), (1, 0), (1, 1)], True),
    ([(0, 0), (1, 1), (1, 0), (0, 1)], False),
    ([(0, 0), (1, 0), (2, 0)], False),
    ([(0, 0), (1, 0), (0, 0)], False),
    ([(0, 0), (2, 0), (2, 2), (1, 2), (1, 3), (1, 2), (0, 2)], False),
    ([(0, 0), (2, 0), (1, 1), (2, 2), (0, 2), (1, 1)], False),
    ([(0, 0), (float("nan"), 1), (2, 2)], False),
    ([(0, 0), (1, 1), (2, 0), (1, float("inf"))], False),
    ([], False),
    (None, False),
    *[(circle(n), True) for n in (5, 12, 13, 200, 256, 257, 3000)],
    *[(circle(n, 2), False) for n in (5, 13, 201, 257, 3001)],
]


def as_rows(cases):
    return [([(float(x), float(y)) for x, y in c] if c is not None else None, w) for c, w in cases]


def test_cases(spark):
    df = spark.createDataFrame(as_rows(CASES), SCHEMA)
    got = df.select(shapes.coords_valid(F.col("c")).alias("g"), "want").collect()
    assert [r.g for r in got] == [r.want for r in got]


def simple_by_brute_force(points):
    """Exact, on fractions, over all pairs of segments."""
    ring = [p for i, p in enumerate(points) if i == 0 or p != points[i - 1]]
    if len(ring) > 1 and ring[0] == ring[-1]:
        ring = ring[:-1]
    n = len(ring)
    if n < 3:
        return False
    ring = [(Fraction(x), Fraction(y)) for x, y in ring]

    def turn(a, b, c):
        v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        return (v > 0) - (v < 0)

    def on(a, b, p):
        return turn(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])

    for i in range(n):
        a, b = ring[i], ring[(i + 1) % n]
        c = ring[(i + 2) % n]
        if on(a, b, c) or on(b, c, a):
            return False
        for j in range(i + 2, n):
            if i == 0 and j == n - 1:
                continue
            c, d = ring[j], ring[(j + 1) % n]
            if turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0:
                return False
            if on(a, b, c) or on(a, b, d) or on(c, d, a) or on(c, d, b):
                return False
    return True


def random_rings(count, sizes, grid):
    rng = random.Random(7)
    rings = []
    for _ in range(count):
        n = rng.choice(sizes)
        points = [(rng.randrange(grid), rng.randrange(grid)) for _ in range(n)]
        if rng.random() < 0.7:  # by angle around the middle: often simple
            mx, my = sum(p[0] for p in points) / n, sum(p[1] for p in points) / n
            points.sort(key=lambda p: math.atan2(p[1] - my, p[0] - mx))
        rings.append(points)
    return rings


def test_small_rings_against_brute_force(spark):
    cases = [(r, simple_by_brute_force(r)) for r in random_rings(400, [3, 4, 5, 6, 8, 12], 7)]
    assert 50 < sum(w for _, w in cases) < 350
    df = spark.createDataFrame(as_rows(cases), SCHEMA)
    got = df.select(shapes.coords_valid(F.col("c")).alias("g"), "want", "c").collect()
    assert [r for r in got if r.g != r.want] == []


def test_batched_and_swept_rings_against_brute_force():
    rings = random_rings(60, [3, 5, 13, 20, 40], 60)
    want = [simple_by_brute_force(r) for r in rings]
    xs = pd.Series([[float(x) for x, _ in r] for r in rings])
    ys = pd.Series([[float(y) for _, y in r] for r in rings])
    assert list(shapes.rings_ok(xs, ys)) == want
    for r, w in zip(rings, want):
        x, y = shapes._opened(pd.Series([p[0] for p in r], dtype=float).to_numpy(), pd.Series([p[1] for p in r], dtype=float).to_numpy())
        assert (len(x) >= 3 and shapes._sweep(x, y)) == w
