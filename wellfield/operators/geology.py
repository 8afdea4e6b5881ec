"""Grid values along and inside geometries of any kind, and zone columns from several grids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .quadtree import nearest
from .scattered import linear, smooth
from .spacing import bilinear, bilinears, dealt, mesh_places, sampled
from .upsert import update_from

METHODS = ("bilinear", "nearest", "linear", "cubic")


def _segments(coords: Column, closed: bool = False) -> Column:
    """(a, b, length) of each piece between neighbours, relative to the first place; of a ring the closing one, too."""
    origin, n = coords[0], F.size(coords)
    moved = lambda p: F.struct((p["x"] - origin["x"]).alias("x"), (p["y"] - origin["y"]).alias("y"))
    ends = F.concat(coords, F.array(origin)) if closed else coords
    pairs = F.arrays_zip(F.slice(ends, 1, n if closed else F.greatest(n - 1, F.lit(0))).alias("a"), F.slice(ends, 2, F.greatest(n, F.lit(1))).alias("b"))
    return F.transform(F.filter(pairs, lambda s: s["a"].isNotNull() & s["b"].isNotNull()), lambda s: F.struct(moved(s["a"]).alias("a"), moved(s["b"]).alias("b"), F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]).alias("length")))


def staged(geometries: DataFrame) -> DataFrame:
    """geometries (id, kind, coords) with `pieces` of a line or polygon, `ring` of a polygon, and the lengths `ends` up to
    each place of a line: columns of their own, so that each is worked out once a row."""
    coords, line, polygon = F.col("coords"), F.col("kind") != "point", F.col("kind") == "polygon"
    own = geometries.withColumns({"pieces": F.when(line, _segments(coords)), "ring": F.when(polygon, _segments(coords, closed=True))})
    ends = F.aggregate("pieces", F.array(F.lit(0.0)), lambda so_far, s: F.concat(so_far, F.array(F.element_at(so_far, -1) + s["length"])))
    return own.withColumn("ends", F.when(F.col("kind") == "line", ends))


def centroid() -> Column:
    """The centre (x, y) of a staged geometry: of a line by the lengths of its pieces, of a polygon by its area. A polygon
    without area counts as a line, a line without length as its first place; null without coordinates."""
    coords = F.col("coords")

    def weighed(segments: Column, weight, share: float) -> Column:
        """Sums of a + b times weight, over `share` times the weights."""
        add = lambda t, s: F.struct((t["n"] + weight(s)).alias("n"), (t["x"] + (s["a"]["x"] + s["b"]["x"]) * weight(s)).alias("x"), (t["y"] + (s["a"]["y"] + s["b"]["y"]) * weight(s)).alias("y"))
        at = lambda t, c: coords[0][c] + t[c] / (t["n"] * share)
        zero = F.struct(*(F.lit(0.0).alias(c) for c in ("n", "x", "y")))
        return F.aggregate(segments, zero, add, lambda t: F.when(t["n"] != 0, F.struct(at(t, "x").alias("x"), at(t, "y").alias("y"))))

    first = F.when(F.size(coords) > 0, F.struct(coords[0]["x"].alias("x"), coords[0]["y"].alias("y")))
    by_area = weighed(F.col("ring"), lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"], 3.0)
    return F.coalesce(by_area, weighed(F.col("pieces"), lambda s: s["length"], 2.0), first)


def _along(count: int) -> Column:
    """`count` places at even steps along a staged line of any number of places."""
    coords, pieces, ends = F.col("coords"), F.col("pieces"), F.col("ends")

    def place(k: Column) -> Column:
        gone = F.element_at(ends, -1) * k / max(count - 1, 1)
        found = F.struct(gone.alias("gone"), F.least(F.size(F.filter(ends, lambda e: e <= gone)), F.size(pieces)).alias("at"))
        return F.element_at(F.transform(F.array(found), lambda f: on(f["gone"], F.element_at(pieces, f["at"]), F.element_at(ends, f["at"]))), 1)

    def on(gone: Column, piece: Column, start: Column) -> Column:
        share = F.coalesce((gone - start) / F.nullif(piece["length"], F.lit(0.0)), F.lit(0.0))
        at = lambda c: coords[0][c] + piece["a"][c] + (piece["b"][c] - piece["a"][c]) * share
        return F.struct(at("x").alias("x"), at("y").alias("y"))

    return F.when(F.size(pieces) > 0, F.transform(F.sequence(F.lit(0), F.lit(count - 1)), place)).otherwise(F.array_repeat(coords[0], count))


def _placed(geometries: DataFrame, *, strategy: str = "across", line_points: int = 50, polygon_nodes: int = 200) -> DataFrame:
    """The rows of places() and what else geometries have, with each geometry's centre on its first; a row of nulls for one
    without coordinates."""
    if strategy not in ("across", "centroid"):
        raise ValueError(f"unknown strategy: {strategy}")
    kind, middle = F.col("kind"), centroid()
    spots = F.array(middle)
    if strategy == "across":
        spots = F.when(kind == "line", _along(line_points)).when(kind == "polygon", mesh_places(F.when(kind == "polygon", F.col("coords")), polygon_nodes)).otherwise(spots)
    others = [c for c in geometries.columns if c not in ("id", "kind", "coords")]
    own = staged(geometries.select("id", "kind", F.when(F.size("coords") > 0, F.col("coords")).alias("coords"), *others))
    found = own.select("id", *others, middle.alias("centre"), F.posexplode_outer(F.when(F.col("coords").isNotNull(), spots)).alias("k", "p"))
    return found.select("id", *others, "k", "p.x", "p.y", *(F.when(F.col("k") == 0, F.col(f"centre.{c}")).alias(f"centroid_{c}") for c in "xy"))


def places(geometries: DataFrame, **how) -> DataFrame:
    """(id, k, x, y) where geometries (id, kind, coords) are sampled: a point at itself, a line at line_points (50) even
    steps, a polygon at the places of a mesh of about polygon_nodes (200) that it covers; all at their centre where
    strategy is `centroid`, not `across`."""
    return _placed(geometries.where(F.size("coords") > 0), **how).select("id", "k", "x", "y")


def _checked(method: str, step: float | None) -> None:
    if method not in METHODS:
        raise ValueError(f"unknown method: {method}")
    if method == "bilinear" and not step:
        raise ValueError("a bilinear grid needs its step")


def _ends(name: str, whose: Column) -> list[Column]:
    """Aggregates least`name` and most`name` of a group's geometries where `whose` holds: alike, if there is only one."""
    return [f(F.when(whose, F.struct("kind", "coords"))).alias(f"{n}{name}") for n, f in (("least", F.min), ("most", F.max))]


def _kind(name: str, *more: str) -> Column:
    """The kind of the one geometry of that name; an error where it, or those of the names `more`, are several."""
    alike = F.lit(True)
    for n in (name, *more):
        alike = alike & F.col(f"least{n}").eqNullSafe(F.col(f"most{n}"))
    again = F.raise_error(F.concat(F.lit("several geometries for "), F.col("id").cast("string")))
    return F.when(alike, F.col(f"least{name}.kind")).otherwise(again)


def _scattered(spots: DataFrame, nodes: DataFrame, method: str) -> DataFrame:
    """Rows of _placed() with z from nodes anywhere."""
    keyed = spots.withColumn("owner", F.col("id")).withColumn("id", F.struct("id", "k"))
    return {"nearest": nearest, "linear": linear, "cubic": smooth}[method](keyed, nodes).withColumn("id", F.col("owner"))


def sample(geometries: DataFrame, grid: DataFrame, *, method: str = "linear", step: float | None = None, **how) -> DataFrame:
    """One row per geometry (id, kind: point, line or polygon, coords): id, method, centroid_x, centroid_y, n, n_valid, mean,
    std, least, most of the grid's (x, y, z) values at its places (see places()).

    method: `bilinear` on a regular grid of that step; `nearest`, `linear`, `cubic` on nodes anywhere. Places off the grid
    have no value (the nearest node always has one). Geometries without coordinates have no places and no centre. Rows
    that repeat are one; an id with two geometries is an error, raised when the result is computed."""
    _checked(method, step)
    both = dealt(geometries).groupBy("id").agg(*_ends("", F.lit(True)))
    spots = _placed(both.select("id", _kind("").alias("kind"), "least.coords"), **how)
    values = bilinear(spots, grid, step) if method == "bilinear" else _scattered(spots, grid, method)
    return sampled(values).withColumn("method", F.lit(method)).select("id", "method", "centroid_x", "centroid_y", "n", "n_valid", "mean", "std", "least", "most")


@dataclass(frozen=True)
class Grid:
    """One grid, the interval of the wells that it is for (None: all), and the column that takes its values."""

    name: str
    nodes: DataFrame
    column: str
    interval: str | None = None
    method: str = "linear"
    step: float | None = None


def _means(geometries: DataFrame, grids: list[Grid], regular: dict[float, list[DataFrame]], **how) -> list[tuple[list[Grid], DataFrame]]:
    """Parts of the grids, and (id, for_all, m0, m1, ...) for each: the means that its grids have at geometries (id, for_all,
    kind, coords). Regular grids of one step are one part, which places meet at once. `regular` has the nodes of all grids by
    step: parts that want half of them or more share their squares, others make their own."""
    spots = _placed(geometries, **how)
    parts: dict = {}
    for k, g in enumerate(grids):
        parts.setdefault(("step", g.step) if g.method == "bilinear" else ("grid", k), []).append(g)
    found = []
    for (kind, _), part in parts.items():
        if kind == "step":
            nodes, own = regular[part[0].step], list({id(g.nodes): g.nodes for g in part}.values())
            nodes = nodes if 2 * len(own) >= len(nodes) else own
            at = [next(k for k, n in enumerate(nodes) if n is g.nodes) for g in part]
            values = bilinears(spots, nodes, part[0].step, {f"z{k}": k for k in sorted(set(at))})
        else:
            at, values = [0], _scattered(spots, part[0].nodes, part[0].method).withColumnRenamed("z", "z0")
        means = values.groupBy("id", "for_all").agg(*(F.avg(f"z{k}").alias(f"z{k}") for k in sorted(set(at))))
        found.append((part, means.select("id", "for_all", *(F.col(f"z{k}").alias(f"m{n}") for n, k in enumerate(at)))))
    return found


def zone_columns(wells: DataFrame, grids: list[Grid], **how) -> DataFrame:
    """id and a column per destination of the grids: the sum of the means that the grids of that destination have at each
    of wells (id, interval, kind, coords). ValueError for two grids of one name and destination, which would count twice.

    The wells of each interval are sampled once, for its own grids and for those of all wells; other wells for the latter. A
    well of several intervals takes the grids of all wells with the first. Two geometries that one grid would sample for
    an id are an error, raised when the result is computed."""
    named = [(g.name, g.column) for g in grids]
    if len(set(named)) < len(named):
        raise ValueError(f"duplicate grids: {sorted(named)}")
    for g in grids:
        _checked(g.method, g.step)
    intervals, general = sorted({g.interval for g in grids if g.interval is not None}), [g for g in grids if g.interval is None]
    own = {str(k): F.col("interval") == name for k, name in enumerate(intervals)} | ({"_all": F.lit(True)} if general else {})
    held = (wells if general else wells.where(F.col("interval").isin(intervals))).select("id", "interval", "kind", "coords")
    held = dealt(held).groupBy("id").agg(*(end for name, whose in own.items() for end in _ends(name, whose)))
    regular: dict = {}
    for g in grids:
        if g.method == "bilinear" and not any(g.nodes is n for n in regular.setdefault(g.step, [])):
            regular[g.step].append(g.nodes)
    found, before = None, F.lit(False)
    for name in own:
        theirs = general if name == "_all" else [g for g in grids if g.interval == intervals[int(name)]]
        there = ~before if name == "_all" else F.col(f"least{name}").isNotNull()
        for_all = F.lit(bool(general)) & ~before
        part = held.where(there).select("id", for_all.alias("for_all"), _kind(name, *(["_all"] if general else [])).alias("kind"), f"least{name}.coords")
        before = before | there
        for these, means in _means(part, theirs if name == "_all" else theirs + general, regular, **how):
            pairs = (F.struct(F.lit(g.column).alias("column"), F.col(f"m{k}").alias("mean")) for k, g in enumerate(these))
            taken = F.array(*(pair if g.interval is not None else F.when(F.col("for_all"), pair) for g, pair in zip(these, pairs)))
            one = means.select("id", F.inline(F.array_compact(taken)))
            found = one if found is None else found.unionByName(one)
    return found.groupBy("id").pivot("column", sorted({g.column for g in grids})).agg(F.sum("mean"))


def update_geology(target: DataFrame, wells: DataFrame, grids: list[Grid], source: str, **how) -> DataFrame:
    """target (id, datasource and others) with the grids' columns set on the rows of that datasource; other rows, and
    wells outside all intervals, stay as they are."""
    return update_from(target, zone_columns(wells, grids, **how).withColumn("datasource", F.lit(source)), ["id", "datasource"])
