"""Samples of points, lines and polygons: places, centres, and grids with an interval."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wellfield.functions import geometry as G
from wellfield.operators import geology as O
from wellfield.operators import spacing as S

SCHEMA = "id int, kind string, coords array<struct<x: double, y: double>>"
SHAPES = {
    "point": [(3, 4)], "line": [(0, 0), (3, 4), (3, 10), (3, 10), (0, 10)], "polygon": [(0, 0), (6, 0), (6, 2), (2, 2), (2, 8), (0, 8)],
}


def shapes(spark, rows):
    return spark.createDataFrame([(i, k, [tuple(map(float, p)) for p in c] if c is not None else None) for i, k, c in rows], SCHEMA)


def middle(spark, kind, coords):
    row = O.staged(shapes(spark, [(1, kind, coords)])).select(O.centroid().alias("c")).first().c
    return row and (row.x, row.y)


def test_centres(spark):
    """By cutting the L into two rectangles, and a line into its pieces; big coordinates lose nothing."""
    assert middle(spark, "point", SHAPES["point"]) == (3, 4)
    lengths, mids = np.array([5, 6, 0, 3]), np.array([(1.5, 2), (3, 7), (3, 10), (1.5, 10)])
    assert middle(spark, "line", SHAPES["line"]) == pytest.approx(tuple(lengths @ mids / 14))
    want = (np.array([3, 1]) * 12 + np.array([1, 5]) * 12) / 24
    assert middle(spark, "polygon", SHAPES["polygon"]) == pytest.approx(tuple(want))
    assert middle(spark, "polygon", [*SHAPES["polygon"], (0, 0)]) == pytest.approx(tuple(want))  # closed
    assert middle(spark, "polygon", SHAPES["polygon"][::-1]) == pytest.approx(tuple(want))
    assert middle(spark, "polygon", [(x + 5e6, y + 6e6) for x, y in SHAPES["polygon"]]) == pytest.approx((want[0] + 5e6, want[1] + 6e6), abs=1e-6)
    assert middle(spark, "polygon", [(0, 0), (4, 0)]) == (2, 0) and middle(spark, "polygon", [(7, 1)]) == (7, 1)
    assert middle(spark, "line", [(2, 2), (2, 2)]) == (2, 2) and middle(spark, "line", []) is None


def test_places(spark):
    got = {}
    for r in O.places(shapes(spark, [(k, kind, c) for k, (kind, c) in enumerate(SHAPES.items())] + [(8, "line", [(1, 1)]), (9, "line", None)]), line_points=8, polygon_nodes=16).collect():
        got.setdefault(r.id, []).append((r.k, r.x, r.y))
    assert got[0] == [(0, 3, 4)] and 9 not in got
    walked = [(1.2, 1.6), (2.4, 3.2), (3, 5), (3, 7), (3, 9), (2, 10)]
    assert [p[1:] for p in sorted(got[1])] == [pytest.approx(p) for p in [(0, 0), *walked, (0, 10)]]
    assert [p[1:] for p in got[2]] == [(0.75, 1), (0.75, 3), (0.75, 5), (0.75, 7), (2.25, 1), (3.75, 1), (5.25, 1)]
    assert {p[1:] for p in got[8]} == {(1, 1)}
    with pytest.raises(ValueError):
        O.places(shapes(spark, []), strategy="x")


def plane(spark):
    return spark.range(0, 121).select((F.col("id") % 11).cast("double").alias("x"), F.floor(F.col("id") / 11).cast("double").alias("y"), (F.col("id") % 11 * 2 + F.floor(F.col("id") / 11) * 3 + 1).cast("double").alias("z"))


@pytest.mark.parametrize("method", O.METHODS)
def test_sample_on_a_plane(spark, method):
    rows = shapes(spark, [(k, kind, c) for k, (kind, c) in enumerate(SHAPES.items())] + [(5, "point", [(50, 50)]), (6, "line", None)])
    got = {r.id: r for r in O.sample(rows, plane(spark), method=method, step=1.0).collect()}
    assert got[0].mean == 19 and (got[0].n, got[0].n_valid) == (1, 1)
    assert (got[5].n, got[5].n_valid) == (1, 1 if method == "nearest" else 0) and got[6].n == 0 and got[6].centroid_x is None
    if method != "nearest":
        spots = O.places(rows.where("id = 1")).collect()
        z = np.array([2 * p.x + 3 * p.y + 1 for p in spots])
        assert (got[1].mean, got[1].std, got[1].least, got[1].most) == pytest.approx((z.mean(), z.std(), z.min(), z.max()), abs=1e-6)
    centre = {r.id: r for r in O.sample(rows, plane(spark), method=method, step=1.0, strategy="centroid").collect()}
    assert centre[2].n == 1 and (method == "nearest" or centre[2].mean == pytest.approx(2 * 2 + 3 * 3 + 1))


def test_refused(spark):
    two = shapes(spark, [(1, "point", [(1, 1)]), (1, "point", [(2, 2)])])
    with pytest.raises(Exception, match="several geometries"):
        O.sample(two, plane(spark), method="bilinear", step=1.0).collect()
    twice = two.limit(1).union(two.limit(1))
    assert O.sample(twice, plane(spark), method="bilinear", step=1.0).count() == 1
    for bad in ({"method": "x"}, {"method": "bilinear"}):
        with pytest.raises(ValueError):
            O.sample(two, plane(spark), **bad)
    grids = [O.Grid("a", plane(spark), "top"), O.Grid("a", plane(spark), "top", "UPPER")]
    with pytest.raises(ValueError, match="duplicate"):
        O.zone_columns(two.withColumn("interval", F.lit("UPPER")), grids)


def test_update(spark):
    wells = shapes(spark, [(k, "point", [(k, k)]) for k in range(1, 5)]).withColumn("interval", F.when(F.col("id") <= 2, "A").otherwise("B"))
    target = spark.createDataFrame([(k, s, -1.0, -1.0, "kept") for k in range(1, 6) for s in ("X", "Y")], "id int, datasource string, top double, base double, other string")
    grids = [O.Grid("one", plane(spark), "top", "A", "bilinear", 1.0), O.Grid("two", plane(spark), "top", "A", "nearest"), O.Grid("all", plane(spark), "base", None, "bilinear", 1.0)]
    got = {(r.id, r.datasource): (r.top, r.base, r.other) for r in O.update_geology(target, wells, grids, "X").collect()}
    assert len(got) == 10 and all(v == (-1, -1, "kept") for (_, s), v in got.items() if s == "Y")
    assert got[1, "X"] == (12, 6, "kept") and got[3, "X"] == (None, 16, "kept") and got[5, "X"] == (-1, -1, "kept")


def test_mesh_is_what_the_ring_covers(spark):
    """Rings of many sizes, with corners that lie together, lines, a null corner or none at all, against covers() place by place."""
    rng = np.random.default_rng(5)
    rows = [(k, [tuple(p) for p in (rng.integers(0, 9, (n, 2)) * 10.0 + off).tolist()]) for k, (n, off) in enumerate((n, off) for n in (1, 2, 3, 4, 7, 12) for off in (0, 5e6) for _ in range(4))]
    rows += [(90, None), (91, [(1.0, 1.0), None, (9.0, 9.0), (0.0, 7.0)]), (92, [(1.0, None), (5.0, 1.0), (5.0, 6.0)])]
    rings = spark.createDataFrame(rows, "id int, coords array<struct<x: double, y: double>>")
    got = {}
    for r in S.mesh(rings, 36).collect():
        got.setdefault(r.id, []).append((r.k, r.x, r.y))
    assert set(got) == {i for i, _ in rows} and got[90] == [(0, None, None)]
    at = F.explode(F.sequence(F.lit(0), F.lit(35))).alias("k")
    low, high = ({c: f(F.col("coords")[c]) for c in "xy"} for f in (F.array_min, F.array_max))
    spot = {c: low[c] + (high[c] - low[c]) * (n + 0.5) / 6 for c, n in (("x", F.floor(F.col("k") / 6)), ("y", F.col("k") % 6))}
    spots = rings.where("id <> 90").select("*", at).select("*", *(v.alias(c) for c, v in spot.items()))
    want = {}
    for r in spots.where(G.covers(F.col("coords"), F.struct("x", "y"))).orderBy("id", "k").collect():
        want.setdefault(r.id, []).append((r.x, r.y))
    assert len(want) > 20
    means = {i: tuple(pytest.approx(sum(v) / len(v)) for v in zip(*ring)) for i, ring in rows if i < 90} | {91: (None, None), 92: (pytest.approx(11 / 3), None)}
    for i, mean in means.items():
        assert [p[0] for p in got[i]] == list(range(len(got[i]))) and [p[1:] for p in got[i]] == want.get(i, [mean]), i


def test_few_rows_are_dealt_to_many_tasks(spark):
    """Meshes of one file's rings are not one task's work (F18)."""
    rings = shapes(spark, [(k, "polygon", SHAPES["polygon"]) for k in range(200)]).coalesce(1)
    assert S.mesh(rings, 16).select(F.spark_partition_id().alias("p")).distinct().count() > 6


def test_sample_joins_once(spark):
    """A place meets its square's four values at once: one join, which is not a broadcast of the grid (F15)."""
    rows = shapes(spark, [(k, kind, c) for k, (kind, c) in enumerate(SHAPES.items())])
    plan = O.sample(rows, plane(spark), method="bilinear", step=1.0)._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0] and "Window" not in plan and "REPARTITION_BY_NUM" in plan


def test_bilinear_rows(spark):
    """Rows of one id keep their own values; nodes without a value, missing ones and ones that come twice."""
    nodes = spark.createDataFrame([(0.0, 0.0, 1.0), (10.0, 0.0, 3.0), (0.0, 10.0, 5.0), (10.0, 10.0, 7.0), (20.0, 0.0, None), (20.0, 10.0, 9.0), (30.0, 30.0, 4.0), (30.0, 30.0, 6.0)], "x double, y double, z double")
    spots = [(1, 5.0, 5.0, 4.0), (1, 0.0, 5.0, 3.0), (2, 10.0, 2.5, 4.0), (2, 12.0, 10.0, 7.4), (3, 12.0, 5.0, None), (3, 20.0, 0.0, None), (None, 20.0, 10.0, 9.0), (4, 30.0, 30.0, 10.0), (4, 31.0, 30.0, None), (5, None, 5.0, None), (5, -1.0, 5.0, None)]
    points = spark.createDataFrame(spots, "id int, x double, y double, want double")
    got = S.bilinear(points, nodes, 10.0).collect()
    assert len(got) == len(spots) and all(r.z == (pytest.approx(r.want) if r.want is not None else None) for r in got)


@pytest.mark.parametrize("method", O.METHODS)
def test_without_places(spark, method):
    """Geometries of any kind without coordinates come back, with nothing found."""
    rows = shapes(spark, [(1, "point", [(3, 4)]), *((10 * n + k, kind, c) for n, c in ((1, None), (2, [])) for k, kind in enumerate(SHAPES))])
    got = {r.id: r for r in O.sample(rows, plane(spark), method=method, step=1.0).collect()}
    assert len(got) == 7 and got[1].n_valid == 1 and all((r.n, r.n_valid, r.mean, r.centroid_x, r.centroid_y) == (0, 0, None, None, None) for i, r in got.items() if i > 1)


def test_every_grid_is_joined_once(spark):
    """Zone columns take one join a grid, none a broadcast, and places are dealt to many tasks (F16)."""
    wells = shapes(spark, [(k, kind, c) for k, (kind, c) in enumerate(SHAPES.items())]).withColumn("interval", F.lit("A")).coalesce(1)
    grids = [O.Grid("one", plane(spark), "top", "A", "bilinear", 1.0), O.Grid("all", plane(spark), "base", None, "bilinear", 1.0)]
    found = O.zone_columns(wells, grids)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("Join") == text.count("SortMergeJoin") == 2 and text.count("REPARTITION_BY_NUM") == 2
    assert {(r.id, r.top) for r in found.collect()} == {(r.id, r.base) for r in found.collect()}


def test_wells_are_sampled_once(spark):
    """Each interval's wells are sampled once for all their grids, and joined once: two passes here, not one a grid (F16)."""
    price, size = plane(spark), plane(spark).withColumn("z", F.col("z") * 10)
    grids = [O.Grid("a", price, "top", "A", "bilinear", 1.0), O.Grid("b", size, "top", "A", "bilinear", 1.0), O.Grid("c", size, "base", None, "bilinear", 1.0), O.Grid("d", price, "third", None, "bilinear", 1.0)]
    rows = shapes(spark, [(k, kind, SHAPES[kind]) for k, kind in enumerate(["point", "line", "polygon"] * 3)] + [(20, "line", None)])
    wells = rows.withColumn("interval", F.when(F.col("id") % 2 == 0, "A").when(F.col("id") % 3 == 0, "B"))
    found = O.zone_columns(wells, grids)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") == text.count("REPARTITION_BY_NUM") == 2
    want = {r.id: r.mean for r in O.sample(rows, price, method="bilinear", step=1.0).collect()}
    near = lambda v: pytest.approx(v) if v is not None else None
    got = {r.id: (r.top, r.base, r.third) for r in found.collect()}
    assert got == {i: (near(m and 11 * m) if i % 2 == 0 else None, near(m and 10 * m), near(m)) for i, m in want.items()}


def test_wells_of_several_intervals(spark):
    """One geometry under two intervals counts once for a grid of all wells; two geometries only where no grid meets both."""
    one, other, grid = [(3, 4)], [(5, 5)], plane(spark)
    own = [O.Grid(n, grid, n.lower(), n, "bilinear", 1.0) for n in "AB"]
    general = O.Grid("all", grid, "every", None, "bilinear", 1.0)
    wells = lambda *rows: shapes(spark, [(i, "point", c) for i, c, _ in rows]).select("*", F.element_at(F.array(*(F.lit(n) for _, _, n in rows)), F.col("id") % 10 + 1).alias("interval")).withColumn("id", F.floor(F.col("id") / 10))
    same = wells((10, one, "A"), (11, one, "B"), (12, one, None))
    assert [tuple(r) for r in O.zone_columns(same, [*own, general]).select("id", "a", "b", "every").collect()] == [(1, 19, 19, 19)]
    unlike = wells((10, one, "A"), (11, other, "B"), (12, [(9, 9)], "C"))
    assert [tuple(r) for r in O.zone_columns(unlike, own).select("id", "a", "b").collect()] == [(1, 19, 26)]
    many = [O.Grid(n, plane(spark), n.lower(), n, "bilinear", 1.0) for n in "ABDEF"]
    assert [tuple(r) for r in O.zone_columns(unlike, many).select("id", "a", "b", "f").collect()] == [(1, 19, 26, None)]
    for rows, grids in ((unlike, [*own, general]), (wells((10, one, "A"), (11, other, "A")), own)):
        with pytest.raises(Exception, match="several geometries"):
            O.zone_columns(rows, grids).collect()
