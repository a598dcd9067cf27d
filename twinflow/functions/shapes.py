"""Validity of coordinate lists (array<struct<x double, y double>>)."""

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors get the helper below with the plan; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rings over this length are swept in x order instead of paired all with all.
_LONG = 256
_PAIRS_AT_ONCE = 1_000_000


def _finite(coords: Column) -> Column:
    def ok(v: Column) -> Column:
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))

    return F.forall(coords, lambda p: ok(p["x"]) & ok(p["y"]))


def _touch(ax, ay, bx, by, cx, cy, dx, dy) -> np.ndarray:
    """Segments ab and cd, whose boxes overlap, share a point."""
    ux, uy, vx, vy = bx - ax, by - ay, dx - cx, dy - cy
    side = np.sign(ux * (cy - ay) - uy * (cx - ax)) * np.sign(ux * (dy - ay) - uy * (dx - ax))
    other = np.sign(vx * (ay - cy) - vy * (ax - cx)) * np.sign(vx * (by - cy) - vy * (bx - cx))
    return (side <= 0) & (other <= 0)


def _spikes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per ring (last axis): some corner folds back over itself."""
    ux, uy = np.roll(x, -1, -1) - x, np.roll(y, -1, -1) - y
    vx, vy = np.roll(ux, -1, -1), np.roll(uy, -1, -1)
    return ((ux * vy - uy * vx == 0) & (ux * vx + uy * vy < 0)).any(axis=-1)


def _all_pairs(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of many rings of one length are simple: rows are rings."""
    rings, n = x.shape
    i, j = np.triu_indices(n, 2)
    apart = ~((i == 0) & (j == n - 1))
    i, j = i[apart], j[apart]
    x2, y2 = np.roll(x, -1, 1), np.roll(y, -1, 1)
    left, right = np.minimum(x, x2), np.maximum(x, x2)
    low, high = np.minimum(y, y2), np.maximum(y, y2)
    good = ~_spikes(x, y)
    step = max(1, _PAIRS_AT_ONCE // max(1, len(i)))
    for s in range(0, rings, step):
        r = slice(s, s + step)
        near = (left[r][:, i] <= right[r][:, j]) & (left[r][:, j] <= right[r][:, i])
        near &= (low[r][:, i] <= high[r][:, j]) & (low[r][:, j] <= high[r][:, i])
        ring, pair = np.nonzero(near)
        ring += s
        first, second = (ring, i[pair]), (ring, j[pair])
        hit = _touch(
            x[first], y[first], x2[first], y2[first], x[second], y[second], x2[second], y2[second]
        )
        good[ring[hit]] = False
    return good


def _sweep(x: np.ndarray, y: np.ndarray) -> bool:
    """The same for one long ring: only segments whose x spans meet are paired."""
    n = len(x)
    if _spikes(x, y):
        return False
    x2, y2 = np.roll(x, -1), np.roll(y, -1)
    order = np.argsort(np.minimum(x, x2), kind="stable")
    ax, ay, bx, by = x[order], y[order], x2[order], y2[order]
    low, high = np.minimum(ay, by), np.maximum(ay, by)
    stop = np.searchsorted(np.minimum(ax, bx), np.maximum(ax, bx), side="right")
    for i in range(n):
        later = slice(i + 1, stop[i])
        near = np.flatnonzero((low[later] <= high[i]) & (high[later] >= low[i])) + i + 1
        gap = np.abs(order[near] - order[i])
        near = near[(gap > 1) & (gap < n - 1)]
        if near.size and _touch(
            ax[i], ay[i], bx[i], by[i], ax[near], ay[near], bx[near], by[near]
        ).any():
            return False
    return True


def _opened(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without repeated neighbours and without the closing point."""
    new = np.ones(len(x), dtype=bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    x, y = x[new], y[new]
    if len(x) > 1 and x[0] == x[-1] and y[0] == y[-1]:
        x, y = x[:-1], y[:-1]
    return x, y


def rings_ok(xs: pd.Series, ys: pd.Series) -> pd.Series:
    """Simple or not, ring by ring; those of one length are tested together."""
    result = np.full(len(xs), None, dtype=object)
    by_length: dict[int, list] = {}
    for k, (x, y) in enumerate(zip(xs, ys)):
        if x is None:
            continue
        x, y = _opened(np.asarray(x, dtype=float), np.asarray(y, dtype=float))
        if len(x) < 3:
            result[k] = False
        elif len(x) > _LONG:
            result[k] = _sweep(x, y)
        else:
            by_length.setdefault(len(x), []).append((k, x, y))
    for rings in by_length.values():
        where, x, y = zip(*rings)
        result[list(where)] = _all_pairs(np.stack(x), np.stack(y))
    return pd.Series(result)


_rings_ok = F.pandas_udf(rings_ok, T.BooleanType())


def coords_valid(coords: Column) -> Column:
    """A point, a line of two different points, or a simple ring.

    Points and lines are native expressions. Rings go to a vectorised helper
    in Arrow batches: the pairwise test as nested higher-order functions is
    interpreted pair by pair and took three times as long on rings of four.
    """
    size = F.size(coords)
    usable = coords.isNotNull() & (size >= 1) & F.coalesce(_finite(coords), F.lit(False))
    ring = F.when(usable & (size > 2), coords)
    shape_ok = (
        F.when(size == 1, F.lit(True))
        .when(size == 2, F.element_at(coords, 1) != F.element_at(coords, 2))
        .otherwise(_rings_ok(ring["x"], ring["y"]))
    )
    return F.when(usable, shape_ok).otherwise(F.lit(False))
