"""Linear values between scattered nodes, against a search through all triangles."""

from itertools import combinations

import numpy as np
import pytest

from wellfield.functions import kernels as K
from wellfield.operators import scattered as N


def plain(px, py, nodes):
    """Linear value in the triangle of nodes that holds the point and whose circle holds no other node."""
    for a, b, c in combinations(nodes, 3):
        area = (b[0] - a[0]) * (c[1] - a[1]) - (c[0] - a[0]) * (b[1] - a[1])
        if not area:
            continue
        u = ((px - a[0]) * (c[1] - a[1]) - (c[0] - a[0]) * (py - a[1])) / area
        v = ((b[0] - a[0]) * (py - a[1]) - (px - a[0]) * (b[1] - a[1])) / area
        if u < 0 or v < 0 or u + v > 1:
            continue
        left = np.array([[b[0] - a[0], b[1] - a[1]], [c[0] - a[0], c[1] - a[1]]])
        centre = np.linalg.solve(left, (left**2).sum(axis=1) / 2)
        if all(np.hypot(*(np.array(n[:2]) - a[:2] - centre)) >= np.hypot(*centre) * (1 - 1e-9) for n in nodes):
            return a[2] + u * (b[2] - a[2]) + v * (c[2] - a[2])
    return None


def test_linear_matches_all_triangles(spark):
    rng = np.random.default_rng(3)
    crowd, wide = rng.normal(0.3, 0.01, (20, 2)), rng.random((25, 2)) * [1, 3]
    nodes = [(float(x), float(y), float(np.sin(5 * x) + y * y)) for x, y in np.vstack([crowd, wide])]
    asked = [(k, float(x), float(y)) for k, (x, y) in enumerate(np.vstack([rng.random((40, 2)) * [1.2, 3.2] - 0.1, rng.normal(0.3, 0.008, (15, 2))]))]
    got = {r.id: r.z for r in N.linear(spark.createDataFrame(asked, "id int, x double, y double"), spark.createDataFrame(nodes, "x double, y double, z double")).collect()}
    assert len(got) == len(asked)
    for k, x, y in asked:
        want = plain(x, y, nodes)
        assert (want is None and got[k] is None) or got[k] == pytest.approx(want, abs=1e-9)
    assert sum(z is None for z in got.values()) > 3 and sum(z is not None for z in got.values()) > 30


def test_linear_edges(spark):
    """Nodes, edges and the hull's border count as inside; nodes on one circle give one surface; odd input gives nulls."""
    asked = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.5, 0.0), (3, 1.0, 0.5), (4, 0.25, 0.25), (5, 1.5, 0.5), (6, None, 0.5), (7, 0.5, 0.5)], "id int, x double, y double")
    square = [(0.0, 0.0, 0.0), (1.0, 0.0, 1.0), (0.0, 1.0, 1.0), (1.0, 1.0, 4.0), (1.0, 1.0, 9.0), (None, 0.5, 7.0), (0.5, 0.5, None), (0.5, 0.4, float("nan"))]
    got = {r.id: r.z for r in N.linear(asked, spark.createDataFrame(square, "x double, y double, z double")).collect()}
    assert got == {1: 0.0, 2: 0.5, 3: 2.5, 4: 1.0, 5: None, 6: None, 7: 2.0}
    for few in ([], square[:2], [(0.0, 0.0, 1.0), (1.0, 1.0, 1.0), (2.0, 2.0, 1.0)]):
        assert {r.z for r in N.linear(asked, spark.createDataFrame(few, "x double, y double, z double")).collect()} == {None}
    assert N.linear(asked.limit(0), spark.createDataFrame(square, "x double, y double, z double")).count() == 0


def test_hull():
    assert K.hull(np.array([[0, 0], [2, 0], [1, 0], [2, 2], [1, 1], [0, 2], [0, 0]])).tolist() == [[0, 0], [2, 0], [2, 2], [0, 2]]
    assert K.hull(np.zeros((0, 2))).shape == (0, 2) and len(K.hull(np.array([[1, 1], [1, 1]]))) == 1


def frames(spark, asked, nodes):
    return spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(asked)], "id int, x double, y double"), spark.createDataFrame([tuple(map(float, n)) for n in nodes], "x double, y double, z double")


def test_smooth_reproduces_second_degree(spark):
    """Exactly, wherever the nodes lie, also beside a crowd of them; and at the nodes any values."""
    rng = np.random.default_rng(8)
    places = np.vstack([rng.random((60, 2)) * [3, 2], rng.normal([1, 1], 0.01, (40, 2)), [[0, 0], [3, 0], [0, 2], [3, 2]]])
    f = lambda x, y: 4 - 3 * x + 2 * y + 0.7 * x * x - 1.3 * x * y + 0.4 * y * y
    asked = rng.random((50, 2)) * [3, 2]
    got = {r.id: r.z for r in N.smooth(*frames(spark, asked, [(x, y, f(x, y)) for x, y in places])).collect()}
    assert all(got[k] == pytest.approx(f(x, y), abs=1e-7) for k, (x, y) in enumerate(asked))
    rough = [(x, y, float(rng.normal())) for x, y in places]
    at = {r.id: r.z for r in N.smooth(*frames(spark, places, rough)).collect()}
    assert all(at[k] == pytest.approx(n[2], abs=1e-9) for k, n in enumerate(rough))


def test_smooth_has_no_breaks():
    """Two triangles with a common edge: values and slopes agree on both sides of it, and around each one's centre."""
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b, c, d = np.array([0.0, 0.0]), np.array([1.0, 0.2]), rng.normal([0.4, 1.0], 0.1), rng.normal([0.6, -1.0], 0.1)
        held = dict(zip("abcd", rng.normal(size=(4, 3))))

        def at(p, third, xy):
            corners = np.stack([a, b, xy])
            weights = np.linalg.solve(np.vstack([corners.T, np.ones(3)]), np.append(p, 1.0))
            return N._cubic(p, corners, weights, np.stack([held["a"], held["b"], held[third]]))

        normal, h = np.array([-0.2, 1.0]) / np.hypot(0.2, 1.0), 1e-5
        for share in (0.1, 0.37, 0.5, 0.83):
            p = a + share * (b - a)
            assert at(p, "c", c) == pytest.approx(at(p, "d", d), abs=1e-12)
            up = (at(p + h * normal, "c", c) - at(p, "c", c)) / h
            down = (at(p, "d", d) - at(p - h * normal, "d", d)) / h
            assert up == pytest.approx(down, abs=1e-3)
        centre = (a + b + c) / 3
        slopes = []
        for angle in np.arange(0, 6.3, 0.37):
            step = np.array([np.cos(angle), np.sin(angle)])
            slopes.append((step, (at(centre + h * step, "c", c) - at(centre, "c", c)) / h))
        fit = np.linalg.lstsq(np.array([s for s, _ in slopes]), np.array([v for _, v in slopes]), rcond=None)[0]
        assert all(v == pytest.approx(s @ fit, abs=1e-3) for s, v in slopes)


def test_smooth_edges(spark):
    square = [(0, 0, 0), (1, 0, 1), (0, 1, 1), (1, 1, 2)]
    points, nodes = frames(spark, [(0.5, 0.25), (2, 2), (0, 1)], square)
    assert [r.z for r in N.smooth(points, nodes).orderBy("id").collect()] == [pytest.approx(0.75), None, 1.0]
    assert {r.z for r in N.smooth(points, nodes.limit(0)).collect()} == {None}
    assert {r.z for r in N.smooth(points, frames(spark, [], [(0, 0, 1), (1, 1, 1), (2, 2, 1)])[1]).collect()} == {None}


def test_slopes_take_few_of_many(spark):
    """A crowd of 3,000 nodes beside a few far ones: no list has more than 144."""
    rng = np.random.default_rng(3)
    places = np.vstack([rng.normal(0, 0.001, (3000, 2)), rng.random((40, 2)) * 10])
    seen, keep = [], N._lists
    N._lists = lambda *a: seen.append(keep(*a)) or seen[-1]
    try:
        got = N.slopes(N._known(frames(spark, [], [(x, y, 2 * x - y + x * x) for x, y in places])[1])).collect()
    finally:
        N._lists = keep
    assert len(got) == 3040 and max(r[0] for lists in seen for r in lists.selectExpr("max(size(node_x))").collect()) <= 144
    assert all(r["zx"] == pytest.approx(2 + 2 * r["x"], abs=1e-5) and r["zy"] == pytest.approx(-1, abs=1e-5) for r in got)


def test_hull_runs_on_all_partitions(spark):
    nodes = frames(spark, [], np.random.default_rng(1).random((500, 3)))[1].repartition(7)
    plan = N.hull(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and plan.count("MapInPandas") == 2
    lower = plan[plan.index("Exchange") :]
    assert "SinglePartition" in lower.splitlines()[0] and "MapInPandas" in lower  # corners are found before rows meet


@pytest.mark.parametrize("seed", range(8))
def test_hull_of_random_places(seed):
    rng = np.random.default_rng(seed)
    xy = rng.integers(0, 6, (rng.integers(3, 40), 2)).astype(float) if seed % 2 else rng.normal(size=(200, 2))
    ring = K.hull(xy)
    if len(ring) > 2:
        ahead = np.roll(ring, -1, axis=0)
        side = lambda p: (ahead[:, 0] - ring[:, 0]) * (p[1] - ring[:, 1]) - (ahead[:, 1] - ring[:, 1]) * (p[0] - ring[:, 0])
        assert all((side(p) >= -1e-12).all() for p in xy)
        assert all((side(p) > 1e-12).sum() >= len(ring) - 2 for p in ring)  # corners only, in one turn
        assert {tuple(p) for p in ring} <= {tuple(p) for p in xy}


@pytest.mark.parametrize("seed", range(5))
def test_simplified_lines_stay_near(seed):
    """Places that go lie near the line that stays; a straight line keeps its ends only, a far bend stays."""
    rng = np.random.default_rng(seed)
    xy = np.cumsum(rng.normal(size=(80, 2)), axis=0)
    kept = xy[K.simplified(xy, 0.5)]
    assert 2 < len(kept) < 80 and (kept[0] == xy[0]).all() and (kept[-1] == xy[-1]).all()
    for p in xy:
        gaps = []
        for a, b in zip(kept, kept[1:]):
            t = np.clip((p - a) @ (b - a) / max((b - a) @ (b - a), 1e-30), 0, 1)
            gaps.append(np.hypot(*(p - a - t * (b - a))))
        assert min(gaps) <= 0.5 + 1e-9
    line = np.stack([np.arange(9.0), 2 * np.arange(9.0)], 1)
    assert K.simplified(line, 0.1).sum() == 2
    line[4, 1] += 0.3
    assert K.simplified(line, 0.1)[4]


def test_lines_of_several_parts(spark):
    from wellfield.operators import spacing as S

    point = lambda *p: [(float(x), float(y)) for x, y in p]
    rows = [
        (1, [point((0, 0), (1, 0)), point((0, 0), (5, 0.05), (10, 0)), point((3, 3), (3, 3))]), (2, [point((0, 0), (5, 0.05), (10, 0))]), (3, [point((1, 1), (1, 1))]), (4, []), (5, None),
        (6, [point((0, 0), (2, 0)), point((9, 9), (9, 11))]), (7, [None, point((0, 0), (0, 1))]),
    ]
    frame = spark.createDataFrame(rows, "id int, parts array<array<struct<x: double, y: double>>>")
    got = {r.id: [tuple(c) for c in r.coords] for r in S.single(frame).collect()}
    assert got == {1: [(0, 0), (10, 0)], 2: rows[1][1][0], 6: [(0, 0), (2, 0)], 7: [(0, 0), (0, 1)]}
    assert S.single(frame.limit(0)).count() == 0
    chords = S.prepared(S.single(spark.createDataFrame([(1, [point((0, 0), (0, 10)), point((0, 20), (0, 900))])], frame.schema)), 500.0).first()
    assert chords.b.y == 900 and chords.a.y == pytest.approx(20 + 500 / 3.281, abs=0.01)
