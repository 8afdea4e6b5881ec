"""The nearest node against all pairs, and how much a point meets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellfield.operators import quadtree as T


def frames(spark, asked, nodes):
    points = spark.createDataFrame([(k, None if x is None else float(x), float(y)) for k, (x, y) in enumerate(asked)], "id int, x double, y double")
    return points, spark.createDataFrame([tuple(map(float, n)) for n in nodes], "x double, y double, z double")


def plain(asked, nodes):
    return {k: min(((np.hypot(n[0] - x, n[1] - y), *map(float, n)) for n in nodes))[3] for k, (x, y) in enumerate(asked)}


def check(spark, asked, nodes):
    points, grid = frames(spark, asked, nodes)
    assert {r.id: r.z for r in T.nearest(points, grid).collect()} == plain(asked, nodes)


def crowd(rng, n):
    """A crowd within a ten-millionth of the grid, few nodes far off, and nodes that repeat a place."""
    places = np.vstack([rng.normal([0.3, 0.3], 1e-7, (n, 2)), rng.random((30, 2)) * [5, 1], [[0.3, 0.3]] * 3, [[4, 0.5], [4, 0.5]]])
    return [(x, y, k) for k, (x, y) in enumerate(places)]


def test_crowds_and_far_points(spark):
    rng = np.random.default_rng(2)
    asked = np.vstack([rng.normal([0.3, 0.3], 1e-7, (30, 2)), rng.random((30, 2)) * [5, 1], [[-900, 40], [1e6, 1e6], [0.3, 0.3], [4, 0.5]]])
    check(spark, asked, crowd(rng, 500))


@pytest.mark.parametrize("nodes", [[(1, 1, 7)], [(0, 0, 1), (2, 0, 2)], [(k, 0, k) for k in range(200)], [(0, k % 3, k) for k in range(9)]], ids=["one", "two", "line", "repeats"])
def test_few_nodes_lines_and_ties(spark, nodes):
    check(spark, [(1, 1), (1, 0), (0, 0), (-5, 99), (0.5, 0), (7.5, 3)], nodes)


def test_odd_input(spark):
    points, grid = frames(spark, [(None, 0), (float("nan"), 1), (1, 1)], [(0, 0, 4), (float("nan"), 1, 5)])
    assert [r.z for r in T.nearest(points, grid).orderBy("id").collect()] == [None, None, 4.0]
    assert {r.z for r in T.nearest(points, grid.limit(0)).collect()} == {None}
    assert T.nearest(points.limit(0), grid).count() == 0


def test_points_meet_few_lists(spark, monkeypatch):
    """Far points beside a crowd of 20,000 nodes: a handful of leaves each, of bounded length."""
    rng = np.random.default_rng(5)
    nodes = np.hstack([np.vstack([rng.normal(0, 0.01, (20_000, 2)), rng.random((50, 2)) * 100]), np.arange(20_050)[:, None]])
    asked = np.vstack([rng.random((40, 2)) * 1000 + 500, rng.random((40, 2)) * 100])
    points, grid = frames(spark, asked, nodes)
    tree = T.Quadtree(grid)
    assert all(r[0] <= T.LEAF for leaves in tree.leaves for r in leaves.select(F.size("nodes")).collect())
    assert all(r[0] <= T.SIDE**2 for cells in tree.directory for r in cells.select(F.size("cells")).collect())
    seen, keep = [], T.checkpointed
    monkeypatch.setattr(T, "checkpointed", lambda df: seen.append(keep(df)) or seen[-1])
    got = {r.id: r.z for r in T.nearest(points, grid).collect()}
    assert got == plain(asked, nodes)
    kept = [df.count() for df in seen if "split" in df.columns and "bound" in df.columns]
    assert kept and max(kept) < 12 * len(asked)
