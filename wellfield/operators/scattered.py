"""Values between scattered nodes: each point's Delaunay triangle, found from the nodes around it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..session import checkpointed

#: Shares of a circle's squared radius and of a length that count as nothing.
ON_CIRCLE, ON_LINE = 1e-9, 1e-12
#: The first look takes cells of at most so many nodes; it sets where the search starts, not what it finds.
CELL_NODES = 64


def _weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The origin as a weighted mean of three corners; minus infinity for corners on one line."""
    area = (x[1] - x[0]) * (y[2] - y[0]) - (x[2] - x[0]) * (y[1] - y[0])
    if abs(area) <= ON_LINE * max(np.ptp(x), np.ptp(y)) ** 2:
        return np.full(3, -np.inf)
    return np.array([x[1] * y[2] - x[2] * y[1], x[2] * y[0] - x[0] * y[2], x[0] * y[1] - x[1] * y[0]]) / area


def _around(x: np.ndarray, y: np.ndarray) -> list[int] | None:
    """Any three nodes whose triangle holds the origin: the nearest, and on either side of it the one furthest round."""
    a = int(np.argmin(x * x + y * y))
    turn = np.arctan2(x[a] * y - y[a] * x, x[a] * x + y[a] * y)
    opposite = np.flatnonzero(np.abs(turn) > np.pi - ON_LINE)
    if len(opposite):
        aside = np.flatnonzero(np.abs(np.sin(turn)) > ON_LINE)
        return [a, int(opposite[0]), int(aside[0])] if len(aside) else None
    b, c = int(np.argmax(turn)), int(np.argmin(turn))
    return [a, b, c] if turn[b] > 0 > turn[c] and turn[b] - turn[c] >= np.pi else None


def _circle(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Centre and squared radius of the circle through three corners."""
    (bx, cx), (by, cy) = x[1:] - x[0], y[1:] - y[0]
    twice = 2 * (bx * cy - cx * by)
    b2, c2 = bx * bx + by * by, cx * cx + cy * cy
    ux, uy = (cy * b2 - by * c2) / twice, (bx * c2 - cx * b2) / twice
    return x[0] + ux, y[0] + uy, ux * ux + uy * uy


def triangle_at(px: float, py: float, x: np.ndarray, y: np.ndarray) -> tuple[list[int], np.ndarray, float] | None:
    """Of the Delaunay triangle of nodes that holds a point: its corners, their weights, and how far from the point its
    circle reaches. At a node, that node alone; None outside all triangles.

    From any triangle around the point, the node deepest inside its circle takes one corner's place until no node is
    inside. Of several nodes on the last circle, triangles fan out from the one with the least (x, y), so that all points
    see the same triangles."""
    dx, dy = x - px, y - py
    height, lift = np.inf, dx * dx + dy * dy
    if not lift.min():
        return [int(np.argmin(lift))] * 3, np.array([1.0, 0.0, 0.0]), 0.0
    corners = _around(dx, dy)
    if corners is None:
        return None
    while True:
        weights = _weights(dx[corners], dy[corners])
        if not np.isfinite(weights).all():
            return None
        cx, cy, r2 = _circle(dx[corners], dy[corners])
        depth = r2 - (dx - cx) ** 2 - (dy - cy) ** 2
        deepest, now = int(np.argmax(depth)), float(weights @ lift[corners])
        if depth[deepest] <= ON_CIRCLE * r2 or now >= height:
            break
        height = now
        corners = max(([deepest if k == j else c for j, c in enumerate(corners)] for k in range(3)), key=lambda t: _weights(dx[t], dy[t]).min())
    ring = np.flatnonzero(np.abs(depth) <= ON_CIRCLE * r2)
    if len(ring) > 3:
        ring = ring[np.argsort(np.arctan2(dy[ring] - cy, dx[ring] - cx), kind="stable")]
        ring = np.roll(ring, -int(np.lexsort((y[ring], x[ring]))[0]))
        corners = max(([int(ring[0]), int(b), int(c)] for b, c in zip(ring[1:], ring[2:])), key=lambda t: _weights(dx[t], dy[t]).min())
        weights = _weights(dx[corners], dy[corners])
    return corners, weights, float(np.hypot(cx, cy) + np.sqrt(r2) * (1 + 1e-6))


def _plane(at: np.ndarray, xy: np.ndarray, weights: np.ndarray, values: np.ndarray) -> float:
    """Linear within the triangle."""
    return float(weights @ values[:, 0])


def _cubic(at: np.ndarray, xy: np.ndarray, weights: np.ndarray, values: np.ndarray) -> float:
    """Cubic within each third of the triangle around its centre, by corner values and slopes (rows of z, zx, zy).

    Slopes across an edge run linearly between its ends, so they are the same from the triangle on the other side; within
    the triangle the thirds meet with one slope. A surface of second degree comes out as it is."""
    z, slope, centre = values[:, 0], values[:, 1:], xy.mean(axis=0)
    k = int(np.argmin(weights))
    inward = z + (slope * (centre - xy)).sum(1) / 3  # a third of the way from each corner to the centre
    middle = np.empty(3)  # the inner control value of the third at the edge opposite each corner
    for e in range(3):
        i, j = (e + 1) % 3, (e + 2) % 3
        along = xy[j] - xy[i]
        out, back = z[i] + slope[i] @ along / 3, z[j] - slope[j] @ along / 3
        lean = (centre - (xy[i] + xy[j]) / 2) @ along / (along @ along)
        ends = (inward[i] - (z[i] + out) / 2 - lean * (out - z[i])) + (inward[j] - (z[j] + back) / 2 - lean * (z[j] - back))
        middle[e] = (out + back) / 2 + lean * (back - out) + ends / 2
    near = (inward + middle.sum() - middle) / 3
    i, j = (k + 1) % 3, (k + 2) % 3
    along = xy[j] - xy[i]
    u, v, w = weights[i] - weights[k], weights[j] - weights[k], 3 * weights[k]
    edge = z[i] * u**3 + 3 * (z[i] + slope[i] @ along / 3) * u * u * v + 3 * (z[j] - slope[j] @ along / 3) * u * v * v + z[j] * v**3
    inner = 3 * inward[i] * u * u + 6 * middle[k] * u * v + 3 * inward[j] * v * v
    return float(edge + inner * w + 3 * (near[i] * u + near[j] * v) * w * w + near.mean() * w**3)


def _valued(frames: Iterator[pd.DataFrame], reach: float, all_seen: bool, columns: list[str], surface) -> Iterator[pd.DataFrame]:
    for frame in frames:
        z, done = np.full(len(frame), np.nan), np.zeros(len(frame), bool)
        for k, (px, py, x, y, *values) in enumerate(zip(frame["x"], frame["y"], frame["node_x"], frame["node_y"], *(frame[f"node_{c}"] for c in columns))):
            if x is not None and len(x) > 2 and (found := triangle_at(px, py, x, y)) and (all_seen or found[2] <= reach):
                corners, weights, _ = found
                held = np.stack([v[corners] for v in values], 1)
                at_node = weights[0] == 1.0 and corners[0] == corners[1]
                z[k] = held[0, 0] if at_node else surface(np.array([px, py]), np.stack([x[corners], y[corners]], 1), weights, held)
                done[k] = True
        yield pd.DataFrame({"id": frame["id"], "x": frame["x"], "y": frame["y"], "z": pd.Series(z).astype(object).where(done, None), "done": done | all_seen})


def hull(nodes: DataFrame) -> DataFrame:
    """The edges (x0, y0, x1, y1, upper) of the nodes' convex hull, from left to right, without upright ones;
    none where all nodes lie on one line.

    Every partition keeps the corners of its own hull, batch by batch; these few go to one task, which takes their hull."""

    def corners(frames: Iterator[pd.DataFrame]) -> np.ndarray:
        held = np.zeros((0, 2))
        for frame in frames:
            held = K.hull(np.vstack([held, frame[["x", "y"]].to_numpy(float)]))
        return held

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame(corners(frames), columns=["x", "y"])

    def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ring = corners(frames)
        ring = ring if len(ring) > 2 else ring[:0]
        edges = pd.DataFrame(np.hstack([ring, np.roll(ring, -1, axis=0)]), columns=["x0", "y0", "x1", "y1"])
        back = edges.rename(columns={"x0": "x1", "y0": "y1", "x1": "x0", "y1": "y0"})
        yield pd.concat([edges.assign(upper=False), back.assign(upper=True)]).query("x0 < x1")[["x0", "y0", "x1", "y1", "upper"]]

    return nodes.select("x", "y").mapInPandas(part, "x double, y double").repartition(1).mapInPandas(whole, "x0 double, y0 double, x1 double, y1 double, upper boolean")


def _inside(points: DataFrame, edges: DataFrame, low: float, width: float, slack: float) -> DataFrame:
    """Points on or between the hull's upper and lower edges; each meets the edges of its own upright strip."""
    strip = lambda c: F.floor((F.col(c) - low) / (width / 256)).cast("int")
    spread = edges.withColumn("strip", F.explode(F.sequence(strip("x0"), strip("x1"))))
    line = F.col("y0") + (F.col("x") - F.col("x0")) / (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    met = points.withColumn("strip", strip("x")).join(spread, "strip").where("x between x0 and x1")
    good = F.when(F.col("upper"), F.col("y") <= line + slack).otherwise(F.col("y") >= line - slack)
    held = met.groupBy("id").agg(F.min(good).alias("good"), F.max("upper").alias("above"), F.min("upper").alias("below"))
    return points.join(held.where("good and above and not below").select("id"), "id", "left_semi")


def _known(nodes: DataFrame) -> DataFrame:
    """One row per place of nodes (x, y, z): the least z; nulls and NaN are left out."""
    known = nodes.select("x", "y", "z").where("not isnan(x) and not isnan(y) and not isnan(z)").groupBy("x", "y").agg(F.min("z").alias("z"))
    return checkpointed(known.where("x is not null and y is not null and z is not null"))


def _cell(column: str, size: float):
    return F.floor(F.col(column) / size)


def _extent(known: DataFrame) -> tuple[int, float, float, float, float]:
    return known.agg(F.count("*"), F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()  # five numbers


def _first_reach(known: DataFrame, n: int, area: float) -> float:
    """Cells of this size hold at most CELL_NODES nodes."""
    reach = 2 * np.sqrt(area / n)
    while known.groupBy(_cell("x", reach), _cell("y", reach)).count().agg(F.max("count")).first()[0] > CELL_NODES:
        reach /= 2
    return float(reach)


def _lists(known: DataFrame, wanted: DataFrame, reach: float, columns: list[str]) -> DataFrame:
    """For each cell (cx, cy) of wanted the nodes of its own and the eight cells around, as arrays node_x, node_y and
    one per column."""
    near = F.sequence(F.lit(-1), F.lit(1))
    spread = known.select("x", "y", *columns, F.explode(near).alias("i"), _cell("x", reach).alias("cx"), _cell("y", reach).alias("cy"))
    spread = spread.select("x", "y", *columns, (F.col("cx") + F.col("i")).alias("cx"), F.explode(near).alias("j"), "cy")
    around = spread.select("cx", (F.col("cy") + F.col("j")).alias("cy"), F.struct("x", "y", *columns).alias("node"))
    lists = around.join(wanted.select("cx", "cy").distinct(), ["cx", "cy"], "left_semi").groupBy("cx", "cy").agg(F.collect_list("node").alias("nodes"))
    return lists.select("cx", "cy", *(F.col(f"nodes.{c}").alias(f"node_{c}") for c in ("x", "y", *columns)))


def slopes(known: DataFrame) -> DataFrame:
    """Nodes (x, y, z), places of their own, with the slopes zx, zy of the surface of second degree that passes through a
    node and fits those around best, nearer ones more.

    Around a node are the nodes of its own cell and the eight beside it, from each quarter of a quarter of a cell the
    first by (x, y); so a list has at most 144 nodes however dense they lie. Cells start small, and double for nodes
    with fewer than ENOUGH around. Where the whole grid has fewer than six nodes the surface is a plane; where the nodes
    leave its slope open it is the flattest of those that fit."""
    n, x0, x1, y0, y1 = _extent(known)
    if n < 3 or x0 == x1 or y0 == y1:
        return known.select("*", F.lit(0.0).alias("zx"), F.lit(0.0).alias("zy"))
    diagonal, reach = float(np.hypot(x1 - x0, y1 - y0)), _first_reach(known, n, (x1 - x0) * (y1 - y0))
    left, found = known, None
    while left.limit(1).count():
        last = reach >= diagonal
        fewer = known.groupBy(_cell("x", reach / 4).alias("i"), _cell("y", reach / 4).alias("j")).agg(F.min(F.struct("x", "y", "z")).alias("n")).select("n.*")
        wanted = left.withColumns({"cx": _cell("x", reach), "cy": _cell("y", reach)})
        met = wanted.join(_lists(fewer, wanted, reach, ["z"]), ["cx", "cy"], "left").select("x", "y", "z", "node_x", "node_y", "node_z")
        step = checkpointed(met.mapInPandas(lambda frames, e=last: _sloped(frames, e), "x double, y double, z double, zx double, zy double, done boolean"))
        got = step.where("done").drop("done")
        found = got if found is None else found.unionByName(got)
        left = step.where("not done").select("x", "y", "z")
        reach *= 2
    return found


#: Nodes that a slope needs around its own.
ENOUGH = 10


def _sloped(frames: Iterator[pd.DataFrame], last: bool) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out, done = np.zeros((len(frame), 2)), np.zeros(len(frame), bool)
        for k, (px, py, pz, x, y, z) in enumerate(zip(*(frame[c] for c in ("x", "y", "z", "node_x", "node_y", "node_z")))):
            x, y, z = (np.zeros(0) if v is None else v - p for v, p in ((x, px), (y, py), (z, pz)))
            away = np.hypot(x, y)
            x, y, z, away = (v[away > 0] for v in (x, y, z, away))
            done[k] = last or len(x) >= ENOUGH
            if done[k] and len(x):
                size = away.max()
                x, y, weight = x / size, y / size, 1 / (away / size + 0.05)
                terms = np.stack([x, y, x * x, x * y, y * y], 1)[:, : 5 if len(x) > 4 else 2] * weight[:, None]
                out[k] = np.linalg.lstsq(terms, z * weight, rcond=1e-9)[0][:2] / size
        yield frame[["x", "y", "z"]].assign(zx=out[:, 0], zy=out[:, 1], done=done)


def linear(points: DataFrame, nodes: DataFrame) -> DataFrame:
    """points (id, x, y) with z, linear within the Delaunay triangle of nodes (x, y, z) that holds them; see _searched."""
    return _searched(points, _known(nodes), ["z"], _plane)


def smooth(points: DataFrame, nodes: DataFrame) -> DataFrame:
    """points (id, x, y) with z from a surface through the nodes (x, y, z) whose slope has no breaks: cubic in each third
    of the Delaunay triangle, by values and slopes at its corners (see slopes and _cubic). Null and NaN as in linear()."""
    return _searched(points, checkpointed(slopes(_known(nodes))), ["z", "zx", "zy"], _cubic)


def _searched(points: DataFrame, known: DataFrame, columns: list[str], surface) -> DataFrame:
    """points (id, x, y) with z from the Delaunay triangle of known nodes that holds them.

    Null outside the nodes' hull, for points without a place, and where all nodes lie on one line. Nodes with a null or
    NaN are left out; of several nodes at one place the least z counts. `id` is unique.

    Each point meets the nodes of the cells around its own. A triangle whose circle lies within the reach of that search
    is final, as no other node can lie inside; for the other points the reach doubles, round by round. The first reach
    is so short that no cell holds more than CELL_NODES nodes. A cell's nodes travel once, whatever the number of points
    in it; points beside nodes far denser than those around themselves see all nodes of their last reach."""
    n, x0, x1, y0, y1 = _extent(known)
    empty = points.withColumn("z", F.lit(None).cast("double"))
    if n < 3 or x0 == x1 or y0 == y1:
        return empty
    diagonal, reach = float(np.hypot(x1 - x0, y1 - y0)), _first_reach(known, n, (x1 - x0) * (y1 - y0))
    named = f"id {points.schema['id'].dataType.simpleString()}, x double, y double"
    place = points.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    left, found = checkpointed(_inside(place, hull(known), x0, x1 - x0, ON_CIRCLE * diagonal)), None
    while left.limit(1).count():
        all_seen = reach >= diagonal
        wanted = left.withColumns({"cx": _cell("x", reach), "cy": _cell("y", reach)})
        met = wanted.join(_lists(known, wanted, reach, columns), ["cx", "cy"], "left").select("id", "x", "y", *(f"node_{c}" for c in ("x", "y", *columns)))
        step = checkpointed(met.mapInPandas(lambda frames, r=reach, a=all_seen: _valued(frames, r, a, columns, surface), f"{named}, z double, done boolean"))
        got = step.where("done").select("id", "z")
        found = got if found is None else found.unionByName(got)
        left = step.where("not done").select("id", "x", "y")
        reach *= 2
    return empty if found is None else points.join(found, "id", "left")
