"""Lateral spacing, parent and child wells, and grid samples, as joins on grid cells and windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..functions import kernels as K
from ..session import checkpointed


def _cells(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def within(left: DataFrame, right: DataFrame, reach: float, *, same_id: bool = False) -> DataFrame:
    """Pairs of points (id, x, y) at most `reach` apart: each left point looks into the cells around its own, so no pair
    is compared that is more than two cells apart. A crowded cell is split by adaptive execution like any skewed key."""
    l = left.select(F.col("id").alias("id"), F.col("x").alias("x"), F.col("y").alias("y"))
    near = l.withColumn("cx", F.explode(_cells(F.col("x") - reach, F.col("x") + reach, reach))).withColumn("cy", F.explode(_cells(F.col("y") - reach, F.col("y") + reach, reach)))
    r = right.select(F.col("id").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.floor(F.col("x") / reach).alias("cx"), F.floor(F.col("y") / reach).alias("cy"))
    gap = F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy"))
    pairs = near.join(r, ["cx", "cy"]).where(gap <= reach)
    return pairs.where(F.lit(same_id) | (F.col("id") != F.col("other"))).select("id", "other", gap.alias("distance"))


def prepared(lines: DataFrame, heel_feet: float = 500.0) -> DataFrame:
    """(id, a, b): the chord of each line (id, coords) of two unlike points or more, from where it leaves the disc of
    `heel_feet` around its heel to its toe. Lines of which nothing is left go."""
    coords, reach = F.col("coords"), heel_feet / G.FEET
    cut = lines.where(G.two_points(coords)).select("id", G.first(coords).alias("heel"), G.last(coords).alias("b"), F.inline(F.array(G.leaving(coords, reach))))
    return cut.where("p is not null").select("id", "b", F.inline(F.array(F.struct(G.exit_point(F.col("p"), F.col("q"), F.col("heel"), reach).alias("a"))))).select("id", "a", "b")


def single(lines: DataFrame, tolerance: float = 0.1) -> DataFrame:
    """(id, coords) for lines (id, parts) of one part or several: the longest part, the first of equals. Where there are
    several, places that lie within `tolerance` metres of the line through the others go first, part by part. Lines
    without parts, or with less than two unlike places in the longest, go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kept = [], []
            for k, parts in enumerate(batch.column("parts").to_pylist()):
                shapes = [np.array([(c["x"], c["y"]) for c in part], float).reshape(-1, 2) for part in parts or () if part]
                shapes = [xy[K.simplified(xy, tolerance)] if len(shapes) > 1 and len(xy) > 2 else xy for xy in shapes]
                shapes = [xy for xy in shapes if len(np.unique(xy, axis=0)) > 1]
                if shapes:
                    longest = max(shapes, key=lambda xy: np.hypot(*np.diff(xy, axis=0).T).sum())
                    ids.append(k)
                    kept.append([{"x": x, "y": y} for x, y in longest.tolist()])
            coords = pa.array(kept, pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(ids, pa.int64())), coords], ["id", "coords"])

    return lines.select("id", "parts").mapInArrow(run, f"id {lines.schema['id'].dataType.simpleString()}, coords array<struct<x: double, y: double>>")


def lateral_pairs(laterals: DataFrame, reach: float) -> DataFrame:
    """Pairs (id, other) of two-point laterals of which the other meets the id's flat-ended buffer of `reach` metres.

    Both envelopes go to grid cells. Pairs whose envelopes overlap meet the exact test once, in the cell that holds the
    overlap's lower corner, so no pair is shuffled to be made distinct. In the frame of the id's chord the buffer is a
    rectangle, so clipping the other to it is a slab test in closed form. The clipped ends come along."""
    size = 2 * reach
    edges = lambda pad: [f(F.col("a")[k], F.col("b")[k]) + sign * pad for k in "xy" for f, sign in ((F.least, -1), (F.greatest, 1))]

    def celled(pad: float, names: dict[str, str], mark: str) -> DataFrame:
        boxed = _held(laterals, **{f"{mark}{n}": e for e, n in zip(edges(pad), ("x0", "x1", "y0", "y1"))}).withColumnsRenamed(names)
        return boxed.withColumn("cx", F.explode(_cells(F.col(f"{mark}x0"), F.col(f"{mark}x1"), size))).withColumn("cy", F.explode(_cells(F.col(f"{mark}y0"), F.col(f"{mark}y1"), size)))

    met = celled(reach, {}, "o").join(celled(0.0, {"id": "other", "a": "oa", "b": "ob"}, "p"), ["cx", "cy"])
    overlap = (F.col("ox0") <= F.col("px1")) & (F.col("px0") <= F.col("ox1")) & (F.col("oy0") <= F.col("py1")) & (F.col("py0") <= F.col("oy1"))
    corner = (F.floor(F.greatest("ox0", "px0") / size) == F.col("cx")) & (F.floor(F.greatest("oy0", "py0") / size) == F.col("cy"))
    pairs = met.where((F.col("id") != F.col("other")) & overlap & corner).select("id", "a", "b", "other", "oa", "ob")
    return _clipped(pairs, reach).where("t0 <= t1")


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that later filters and projections read as they are: a generator of one row stands between, so
    the optimizer does not write large expressions out again where they are used."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def _clipped(pairs: DataFrame, reach: float) -> DataFrame:
    """t0, t1: the part of the other lateral (oa, ob) inside the flat buffer of (a, b)."""
    a, b, oa, ob = (F.col(c) for c in ("a", "b", "oa", "ob"))
    span = G.distance(a, b)
    pairs = _held(pairs, span=span, ux=(b["x"] - a["x"]) / F.nullif(span, F.lit(0.0)), uy=(b["y"] - a["y"]) / F.nullif(span, F.lit(0.0)))
    along = lambda p: (p["x"] - a["x"]) * F.col("ux") + (p["y"] - a["y"]) * F.col("uy")
    across = lambda p: (p["y"] - a["y"]) * F.col("ux") - (p["x"] - a["x"]) * F.col("uy")
    pairs = _held(pairs, s0=along(oa), s1=along(ob), c0=across(oa), c1=across(ob))

    def slab(v0: str, v1: str, lo: Column, hi: Column) -> tuple[Column, Column]:
        start, change = F.col(v0), F.col(v1) - F.col(v0)
        x, y = (lo - start) / F.nullif(change, F.lit(0.0)), (hi - start) / F.nullif(change, F.lit(0.0))
        inside = (start >= lo) & (start <= hi)
        return F.when(change == 0, F.when(inside, 0.0).otherwise(2.0)).otherwise(F.least(x, y)), F.when(change == 0, F.when(inside, 1.0).otherwise(-1.0)).otherwise(F.greatest(x, y))

    (l0, l1), (w0, w1) = slab("s0", "s1", F.lit(0.0), F.col("span")), slab("c0", "c1", F.lit(-reach), F.lit(reach))
    pairs = _held(pairs, t0=F.greatest(F.lit(0.0), l0, w0), t1=F.least(F.lit(1.0), l1, w1))
    return pairs.drop("s0", "s1", "c0", "c1", "ux", "uy", "span")


def spacing(pairs: DataFrame, reach: float, *, every: float = 100 / G.FEET, least_feet: float = 100.0) -> DataFrame:
    """Distances in feet between the clipped laterals of each pair, the share of the other that lies in the buffer, and
    the side on which it lies.

    The id's lateral is clipped to the other's buffer and sampled every `every` metres; each sample's distance to the
    clipped other counts if it is `least_feet` or more and within one population deviation of the mean."""
    at = lambda p, q, t: F.struct((p["x"] + (q["x"] - p["x"]) * t).alias("x"), (p["y"] + (q["y"] - p["y"]) * t).alias("y"))
    pairs = pairs.select("id", "other", "a", "b", "oa", "ob", (F.col("t1") - F.col("t0")).alias("fraction"), at(F.col("oa"), F.col("ob"), F.col("t0")).alias("p"), at(F.col("oa"), F.col("ob"), F.col("t1")).alias("q"))
    turned = pairs.select("id", "other", "fraction", "p", "q", F.col("oa").alias("a"), F.col("ob").alias("b"), F.col("a").alias("oa"), F.col("b").alias("ob"))
    own = _clipped(turned, reach).where("t0 <= t1")
    own = own.select("id", "other", "fraction", "p", "q", F.col("oa").alias("a"), F.col("ob").alias("b"), at(F.col("oa"), F.col("ob"), F.col("t0")).alias("u"), at(F.col("oa"), F.col("ob"), F.col("t1")).alias("v"))
    n = F.floor(G.distance(F.col("u"), F.col("v")) / every).cast("int")
    span = F.nullif(G.distance(F.col("u"), F.col("v")), F.lit(0.0))
    spots = own.withColumn("k", F.explode(F.sequence(F.lit(0), n)))
    spot = at(F.col("u"), F.col("v"), F.coalesce(F.col("k") * every / span, F.lit(0.0)))
    spots = spots.withColumn("d", G.to_segment(spot, F.col("p"), F.col("q")) * G.FEET)
    by = Window.partitionBy("id", "other")
    spots = spots.withColumn("mean", F.avg("d").over(by)).withColumn("dev", F.stddev_pop("d").over(by))
    spots = spots.where((F.col("d") >= least_feet) & (F.abs(F.col("d") - F.col("mean")) <= F.col("dev") + 1e-9))
    middle = at(F.col("p"), F.col("q"), F.lit(0.5))
    where = G.side(G.bearing(F.col("a"), F.col("b")), G.bearing(at(F.col("a"), F.col("b"), F.lit(0.5)), middle))
    spots = spots.withColumn("position", where)
    return spots.groupBy("id", "other").agg(F.min("d").alias("min_ft"), F.median("d").alias("median_ft"), F.max("d").alias("max_ft"), F.avg("d").alias("avg_ft"), F.max("fraction").alias("fraction"), F.first("position").alias("position"))


def relation(days: Column, threshold: int) -> Column:
    """Co-completed within the threshold, else parent if the neighbour came later, else child."""
    return F.when(F.abs(days) <= threshold, "Co").when(days < 0, "P").otherwise("C")


def parent_child(pairs: DataFrame, wells: DataFrame, *, threshold: int = 70, scenario: str = "BASE") -> DataFrame:
    """Relationships over time: one row per well, date and scenario.

    pairs: wellid, neighbor, first, neighbor_first (dates), distance, side. Dates are the later of both firsts. On each
    side the nearest neighbour so far counts; both sides are carried forward and joined with a bar. A well without
    neighbours stands alone with S."""
    days = F.date_diff("first", "neighbor_first")
    rows = pairs.select("wellid", "side", "distance", "neighbor", F.greatest("first", "neighbor_first").alias("dt"), relation(days, threshold).alias("rel"))
    so_far = Window.partitionBy("wellid", "side").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    nearest = rows.withColumn("near", F.min("distance").over(so_far)).where("distance = near")
    place = Window.partitionBy("wellid", "side", "dt").orderBy("distance", "neighbor")
    nearest = nearest.withColumn("place", F.row_number().over(place)).where("place = 1")
    wide = nearest.groupBy("wellid", "dt").pivot("side", ["LEFT", "RIGHT"]).agg(F.first("distance").alias("distance"), F.first("rel").alias("rel"))
    carried = Window.partitionBy("wellid").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    for c in ("LEFT_distance", "LEFT_rel", "RIGHT_distance", "RIGHT_rel"):
        wide = wide.withColumn(c, F.last(c, ignorenulls=True).over(carried))
    both = F.concat(F.coalesce("LEFT_rel", F.lit("")), F.lit("|"), F.coalesce("RIGHT_rel", F.lit("")))
    wide = wide.select("wellid", "dt", both.alias("relationship"), F.least("LEFT_distance", "RIGHT_distance").alias("closest"), F.col("LEFT_distance").alias("closest_left"), F.col("RIGHT_distance").alias("closest_right"))
    joined = wells.select("wellid", "first").join(wide, "wellid", "left").where(F.col("dt").isNull() | (F.col("dt") >= F.col("first")))
    return joined.select("wellid", F.coalesce("dt", "first").alias("dt"), F.coalesce("relationship", F.lit("S")).alias("relationship"), "closest", "closest_left", "closest_right", F.lit(scenario).alias("scenario"))


def forward_fill(rows: DataFrame, keys: list[str], order: str, columns: list[str], defaults: dict | None = None) -> DataFrame:
    """Each column's last value so far; a default only where there is none yet."""
    by = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.last(c, ignorenulls=True).over(by) for c in columns}
    return rows.select(*(F.coalesce(filled[c], F.lit((defaults or {}).get(c))).alias(c) if c in filled else F.col(c) for c in rows.columns))


def depth_at(survey: DataFrame, wanted: DataFrame) -> DataFrame:
    """True vertical depth at measured depths (wellid, md): between the stations around it, nothing outside them."""
    by = Window.partitionBy("wellid").orderBy("md_ft")
    spans = survey.select("wellid", F.col("md_ft").alias("lo"), F.col("tvd_ft").alias("z0"), F.lead("md_ft").over(by).alias("hi"), F.lead("tvd_ft").over(by).alias("z1"))
    inside = (F.col("md") >= F.col("lo")) & ((F.col("md") < F.col("hi")) | (F.col("hi").isNull() & (F.col("md") == F.col("lo"))))
    found = wanted.join(spans, "wellid").where(inside)
    z = F.when(F.col("md") == F.col("lo"), F.col("z0")).otherwise(F.col("z0") + (F.col("md") - F.col("lo")) * (F.col("z1") - F.col("z0")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)))
    return wanted.join(found.select("wellid", "md", z.alias("tvd")), ["wellid", "md"], "left")


def _squares(grids: list[DataFrame], step: float) -> DataFrame:
    """(i, j, corners) of each square that has a node of one of the regular grids: the values at its corners 00, 01, 10, 11
    by the first grid, then by the next; null where a node is missing or without a value. Of a node that comes twice both
    values count, as in a join. What all grids have at a node is one row, before it goes to the four squares around."""
    nodes, names = None, [f"z{k}" for k in range(len(grids))]
    for name, grid in zip(names, grids):
        i, j = (F.round(F.col(c) / step).cast("long").alias(n) for c, n in (("x", "i"), ("y", "j")))
        one = grid.select(i, j, F.lit(name).alias("name"), "z")
        nodes = one if nodes is None else nodes.unionByName(one)
    here = lambda name: F.when(F.col("name") == name, F.col("z"))
    whole = lambda name: F.when(F.count(here(name)) == F.count_if(F.col("name") == name), F.sum(here(name)))
    known = nodes.groupBy("i", "j").agg(*(whole(name).alias(name) for name in names))
    shifts = [(a, b) for a in (0, 1) for b in (0, 1)]
    around = F.array(*(F.struct((F.col("i") - a).alias("i"), (F.col("j") - b).alias("j"), F.lit(2 * a + b).alias("c")) for a, b in shifts))
    flat = known.select(F.explode(around).alias("at"), *names).select("at.*", *names)
    corners = (F.max(F.when(F.col("c") == 2 * a + b, F.col(name))) for name in names for a, b in shifts)
    return flat.groupBy("i", "j").agg(F.array(*corners).alias("corners"))


def bilinear(points: DataFrame, grid: DataFrame, step: float) -> DataFrame:
    """points (x, y and others) with z of a regular grid (x, y, z at multiples of `step`). A point outside the grid has no z."""
    return bilinears(points, [grid], step, {"z": 0})


def bilinears(points: DataFrame, grids: list[DataFrame], step: float, wanted: dict[str, int]) -> DataFrame:
    """points (x, y and others) with a column for each of the regular grids wanted, by their places in the list: one join
    on the square that a point lies in, so a point is moved once for all of them. The squares are those of all grids, so
    that Spark makes them once for several frames of points that want different ones."""
    i, j = F.floor(F.col("x") / step), F.floor(F.col("y") / step)
    placed = points.withColumns({"i": i, "j": j})
    fx, fy = F.col("x") / step - F.col("i"), F.col("y") / step - F.col("j")

    def value(grid: int) -> Column:
        z = None
        for a in (0, 1):
            for b in (0, 1):
                w = (fx if a else 1 - fx) * (fy if b else 1 - fy)
                part = F.when(w == 0, 0.0).otherwise(w * F.col("corners")[4 * grid + 2 * a + b])
                z = part if z is None else z + part
        return z

    # By file sizes Spark would take millions of squares for a table to broadcast.
    joined = placed.join(_squares(grids, step).hint("merge"), ["i", "j"], "left")
    return joined.select(*points.columns, *(value(grid).alias(name) for name, grid in wanted.items()))


def along(lines: DataFrame, count: int = 50) -> DataFrame:
    """`count` evenly spaced points on each two-point line (id, a, b)."""
    t = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    spots = lines.select("id", "a", "b", t.alias("k"))
    f = F.col("k") / (count - 1)
    return spots.select("id", "k", *((F.col("a")[c] + (F.col("b")[c] - F.col("a")[c]) * f).alias(c) for c in ("x", "y")))


def mesh_places(ring: Column, nodes: int = 200) -> Column:
    """About `nodes` places of a square mesh over a ring's envelope that the ring covers, or the mean of its corners where
    it covers none of them."""
    side = max(2, round(nodes**0.5))

    @F.arrow_udf("array<struct<x: double, y: double>>")
    def places(rings: pa.Array) -> pa.Array:
        return K.meshes(rings, side)

    return places(ring)


def dealt(geometries: DataFrame) -> DataFrame:
    """geometries (id and others), all of an id in one part, for work on their places. The number of parts is given, as a
    few MB of geometries are minutes of work and GB of places: Spark would join them to fewer tasks than cores."""
    return geometries.repartition(max(3 * geometries.sparkSession.sparkContext.defaultParallelism, 24), "id")


def mesh(polygons: DataFrame, nodes: int = 200) -> DataFrame:
    """(id, k, x, y): the places of mesh_places() for each ring (id, coords)."""
    own = dealt(polygons.select("id", "coords"))
    return own.select("id", F.posexplode(mesh_places(F.col("coords"), nodes)).alias("k", "p")).select("id", "k", "p.x", "p.y")


def sampled(values: DataFrame) -> DataFrame:
    """Per geometry: how many samples (id, k, z and the centre on one row; k null: none), how many with a value, their mean,
    population deviation, least and largest, and the centre."""
    centre = (F.max(c).alias(c) for c in ("centroid_x", "centroid_y"))
    return values.groupBy("id").agg(*centre, F.count("k").alias("n"), F.count("z").alias("n_valid"), F.avg("z").alias("mean"), F.stddev_pop("z").alias("std"), F.min("z").alias("least"), F.max("z").alias("most"))


def resampled(lines: DataFrame, every: float) -> DataFrame:
    """(id, k, x, y) every `every` metres along lines of any number of points (id, coords); two-point lines as they are."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for i, coords in zip(frame["id"], frame["coords"]):
                xy = np.array([(c["x"], c["y"]) for c in coords], float)
                if len(xy) > 2:
                    at = np.append(0, np.cumsum(np.hypot(*np.diff(xy, axis=0).T)))
                    s = np.arange(0, at[-1] + 1e-9, every)
                    xy = np.column_stack([np.interp(s, at, xy[:, 0]), np.interp(s, at, xy[:, 1])])
                out.append(pd.DataFrame({"id": i, "k": np.arange(len(xy)), "x": xy[:, 0], "y": xy[:, 1]}))
            yield pd.concat(out) if out else pd.DataFrame({"id": [], "k": [], "x": [], "y": []})

    return lines.select("id", "coords").mapInPandas(run, f"id {lines.schema['id'].dataType.simpleString()}, k int, x double, y double")


def conformity(polygons: DataFrame) -> DataFrame:
    """(id, conformity): a ring's area over that of its least rotated rectangle."""

    def least_rectangle(xy: np.ndarray) -> float:
        best = np.inf
        for dx, dy in np.diff(np.vstack([xy, xy[:1]]), axis=0):
            norm = np.hypot(dx, dy)
            if norm:
                u = np.array([dx, dy]) / norm
                s, c = xy @ u, xy @ np.array([-u[1], u[0]])
                best = min(best, np.ptp(s) * np.ptp(c))
        return best

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for coords in frame["coords"]:
                xy = np.array([(c["x"], c["y"]) for c in coords], float)
                area = abs(np.dot(xy[:, 0], np.roll(xy[:, 1], -1)) - np.dot(xy[:, 1], np.roll(xy[:, 0], -1))) / 2
                box = least_rectangle(K.hull(xy))
                out.append(area / box if box and np.isfinite(box) else None)
            yield pd.DataFrame({"id": frame["id"], "conformity": out})

    return polygons.select("id", "coords").mapInPandas(run, f"id {polygons.schema['id'].dataType.simpleString()}, conformity double")
