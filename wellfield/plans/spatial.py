"""Queries over geometry, grids, lateral spacing and well relationships."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as G
from ..operators import geology as O
from ..operators import scattered as N
from ..operators import spacing as S
from ..operators.quadtree import nearest
from ..session import shared_dir
from ..sources import fixtures as X
from ..sources.tables import read_grid

W = f"with {X.SQL}"
FT = 3.281


def wells(spark, d):
    return X.well_header(spark, d)


def laterals(spark, d):
    """Two-point laterals that run north, some of them slanted to the east."""
    top = F.col("y0") + 160 + F.col("laterallength_ft") / FT
    a, b = G.point(F.col("x0"), F.col("y0") + 160), G.point(F.col("x0") + F.when(X.well() % 6 == 0, 150).otherwise(0), top)
    return wells(spark, d).where("trajectory = 'HORIZONTAL'").select(X.well().alias("id"), a.alias("a"), b.alias("b"))


def lines(spark, d):
    """The laterals as lines: a bend near the heel for some, one point twice for others."""
    bent = F.array("a", G.point(F.col("a")["x"] - 40, F.col("a")["y"] + 30), "b")
    coords = F.when(F.col("id") % 5 == 0, bent).when(F.col("id") % 7 == 0, F.array("a", "a", "b")).otherwise(F.array("a", "b"))
    return laterals(spark, d).select("id", coords.alias("coords"))


def g1_wkt(spark, d):
    text = F.concat(F.lit("LINESTRING ("), F.col("x0").cast("long"), F.lit(" "), F.col("y0").cast("long"), F.lit(", "), X.well(), F.lit(" -12.5)"))
    coords = G.from_wkt(F.when(X.well() % 5 == 0, "EMPTY").otherwise(text))
    return wells(spark, d).select("wellid", coords).toDF("wellid", "c").select("wellid", G.first(F.col("c"))["x"].alias("x"), G.last(F.col("c"))["y"].alias("y"))


def g2_reproject(spark, d):
    degrees = G.unproject(F.col("x0"), F.col("y0") + 1000000)
    rows = wells(spark, d).select("wellid", "x0", (F.col("y0") + 1000000).alias("y1"), degrees.alias("p"))
    back = G.project(F.col("p.x"), F.col("p.y"))
    return rows.select("wellid", F.round(back["x"], 2).alias("x"), F.round(back["y"], 2).alias("y"))


def g5_endpoints(spark, d):
    return laterals(spark, d).select("id", F.array("a", "b").alias("c")).select("id", G.first(F.col("c"))["y"].alias("first_y"), F.round(G.last(F.col("c"))["y"], 4).alias("last_y"))


def g6_longest(spark, d):
    short, long = F.array(G.point(X.well(), X.well()), G.point(X.well() + 3, X.well() + 4)), F.array(G.point(X.well(), X.well()), G.point(X.well() + 3, X.well() + 4), G.point(X.well() + 3, X.well() + 4 + X.well() % 9))
    return wells(spark, d).select("wellid", F.round(G.length(G.longest(F.array(short, long))), 4).alias("length"))


def g7_azimuth(spark, d):
    a, b = G.point(F.lit(0.0), F.lit(0.0)), G.point((X.well() * 37) % 21 - 10, (X.well() * 53) % 23 - 11)
    return wells(spark, d).select("wellid", F.round(G.bearing(a, b), 4).alias("bearing"), F.round(G.math_angle(a, b), 4).alias("angle"))


def g8_side(spark, d):
    return wells(spark, d).select("wellid", G.side(((X.well() * 45) % 360).cast("double"), ((X.well() * 90) % 360).cast("double")).alias("side"))


def g12_vertical_distance(spark, d):
    points = wells(spark, d).select(X.well().alias("id"), F.col("x0").alias("x"), F.col("y0").alias("y"))
    return S.within(points, points, 1609.0).select("id", "other", F.round(F.col("distance") * FT, 4).alias("feet"))


jn17_distance_join = g12_vertical_distance


def survey(spark, d):
    return wells(spark, d).withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(20)))).select("wellid", (F.col("s") * 500).cast("double").alias("md_ft"), F.round(F.lit(6000.0) * (1 - F.exp(-F.col("s") / (5 + X.well() % 4))), 4).alias("tvd_ft"))


def g16_tvd(spark, d):
    wanted = wells(spark, d).select("wellid", ((X.well() * 131) % 11500).cast("double").alias("md"))
    return S.depth_at(survey(spark, d), wanted).select("wellid", "md", F.round("tvd", 4).alias("tvd"))


def g17_units(spark, d):
    return wells(spark, d).select("wellid", F.round(F.col("x0") * F.when(X.well() % 2 == 0, G.SURVEY_FOOT).otherwise(1.0), 4).alias("x"))


def g19_covers(spark, d):
    ring = F.array(*(G.point(F.lit(x), F.lit(y)) for x, y in ((0, 0), (10, 0), (10, 10), (5, 4), (0, 10))))
    return wells(spark, d).select("wellid", G.covers(ring, G.point(X.well() % 13 - 1, (X.well() * 7) % 12)).alias("inside"))


def grid(spark):
    axis = spark.range(0, 41)
    cells = axis.select(F.col("id").alias("i")).crossJoin(F.broadcast(axis.select(F.col("id").alias("j"))))
    x, y = (F.col("i") * 100).cast("double"), (F.col("j") * 100).cast("double")
    return cells.select(x.alias("x"), y.alias("y"), (x * 2 - y * 3 + x * y / 1000 + 50).alias("z"))


def spots(spark, d):
    return wells(spark, d).select(X.well().alias("id"), ((X.well() * 733) % 4200).cast("double").alias("x"), ((X.well() * 377) % 4050 + 0.5).cast("double").alias("y"))


def g20_bilinear(spark, d):
    return S.bilinear(spots(spark, d), grid(spark), 100.0).select("id", F.round("z", 4).alias("z"))


def g20_nearest(spark, d):
    return nearest(spots(spark, d), grid(spark)).select("id", "z")


def scattered(spark):
    """The grid's nodes, each but those on its border moved aside by up to 45, with values on a plane."""
    aside = lambda a, b: F.when((F.col("x") % 4000 == 0) | (F.col("y") % 4000 == 0), 0).otherwise((F.col("x") * a + F.col("y") * b) / 100 % 91 - 45)
    moved = grid(spark).select((F.col("x") + aside(37, 53)).alias("x"), (F.col("y") + aside(71, 29)).alias("y"))
    return moved.withColumn("z", F.col("x") * 2 - F.col("y") * 3 + 50)


def g20_linear(spark, d):
    return N.linear(spots(spark, d), scattered(spark)).select("id", F.round("z", 4).alias("z"))


def g20_smooth(spark, d):
    """On nodes whose values are of second degree, which the smooth surface gives back as they are."""
    nodes = scattered(spark).withColumn("z", F.col("x") * 2 - F.col("y") * 3 + F.col("x") * F.col("y") / 1000 - F.col("y") * F.col("y") / 2000 + 50)
    return N.smooth(spots(spark, d), nodes).select("id", F.round("z", 3).alias("z"))


def parts_grid(spark, d, value="p_retailprice"):
    """A regular grid of which every part is a node, fifty to a row."""
    n = F.col("p_partkey")
    return spark.read.parquet(f"{d}/part.parquet").select((n % 50 * 100).cast("double").alias("x"), (F.floor(n / 50) * 100).cast("double").alias("y"), F.col(value).cast("double").alias("z"))


def src7_grid(spark, d):
    """The parts' grid, written as a delimited file and read from there."""
    path = f"{shared_dir(spark)}/grid-{uuid.uuid4().hex[:12]}"
    parts_grid(spark, d).write.option("sep", ";").csv(path)
    return read_grid(spark, path, ";")


def geometries(spark, d):
    """Points, lines with a bend, and rectangles."""
    x, y = (X.well() * 31 % 1500).cast("double"), (X.well() * 17 % 2500).cast("double")
    line = [(x, y), (x + 900, y), (x + 900, y + 600)]
    box = [(x, y), (x + 700, y), (x + 700, y + 1400), (x, y + 1400)]
    make = lambda p: F.array(*(G.point(*v) for v in p))
    kind = F.element_at(F.array(*map(F.lit, ("point", "line", "polygon"))), (X.well() % 3 + 1).cast("int"))
    coords = F.when(X.well() % 3 == 0, make([(x, y)])).when(X.well() % 3 == 1, make(line)).otherwise(make(box))
    return wells(spark, d).select(X.well().alias("id"), F.when(X.well() % 2 == 0, "UPPER").otherwise("LOWER").alias("interval"), kind.alias("kind"), coords.alias("coords"))


def g21_sample(spark, d):
    found = O.sample(geometries(spark, d), parts_grid(spark, d), method="bilinear", step=100.0)
    return found.select("id", "n", "n_valid", *(F.round(c, 4).alias(c) for c in ("centroid_x", "centroid_y", "mean", "std", "least", "most")))


def g21_centres(spark, d):
    """At the centres alone, by the nearest node."""
    return O.sample(geometries(spark, d), parts_grid(spark, d), method="nearest", strategy="centroid").select("id", "n", F.round("mean", 4).alias("mean"))


def g22_update_geology(spark, d):
    """Two grids for one column, of different intervals, and one for all wells, written back to the wells' own rows."""
    own = wells(spark, d).select(X.well().alias("id"), F.when(X.well() % 5 == 0, "OTHER").otherwise("GRIDS").alias("datasource"), F.lit(1.0).alias("top"), F.lit(2.0).alias("base"))
    price, size = parts_grid(spark, d), parts_grid(spark, d, "p_size")
    grids = [O.Grid("upper", price, "top", "UPPER", "bilinear", 100.0), O.Grid("upper again", size, "top", "UPPER", "bilinear", 100.0), O.Grid("all", size, "base", None, "bilinear", 100.0)]
    updated = O.update_geology(own, geometries(spark, d), grids, "GRIDS")
    return updated.select("id", "datasource", F.round("top", 4).alias("top"), F.round("base", 4).alias("base"))


def snk6_bounds(spark, d):
    return wells(spark, d).agg(F.min("y0").alias("min_y"), F.max("y0").alias("max_y"), F.min("x0").alias("min_x"), F.max("x0").alias("max_x"))


def pairs(spark, d):
    w = wells(spark, d).where("trajectory = 'HORIZONTAL'").select("wellid", "x0", "y0", "firstproddate")
    other = w.select(X.well().alias("neighbor"), F.col("x0").alias("ox"), "y0", F.col("firstproddate").alias("neighbor_first"))
    joined = w.join(other, "y0").where((X.well() != F.col("neighbor")) & (F.abs(F.col("x0") - F.col("ox")) <= 1609))
    return joined.select("wellid", "neighbor", F.col("firstproddate").alias("first"), "neighbor_first", (F.abs(F.col("x0") - F.col("ox")) * FT).alias("distance"), F.when(F.col("ox") > F.col("x0"), "RIGHT").otherwise("LEFT").alias("side"))


def jn16_spatial_join(spark, d):
    return S.lateral_pairs(S.prepared(lines(spark, d)), 500.0).select("id", "other")


def g10_neighbours(spark, d):
    found = S.lateral_pairs(S.prepared(lines(spark, d)), 500.0)
    return found.groupBy("id").agg(F.count("*").alias("n"), F.min("other").alias("least"), F.max("other").alias("most"))


def g11_distances(spark, d):
    found = S.spacing(S.lateral_pairs(S.prepared(lines(spark, d)), 500.0), 500.0)
    return found.select("id", "other", "position", *(F.round(c, 3).alias(c) for c in ("min_ft", "median_ft", "max_ft", "avg_ft", "fraction")))


def g9_buffers(spark, d):
    """Each lateral's flat buffer is a rectangle on its chord beyond the heel's disc."""
    ring, area = G.flat_buffer(F.col("a"), F.col("b"), 500.0), 2 * 500.0 * G.distance(F.col("a"), F.col("b"))
    corner = lambda k, c: F.round(F.element_at("ring", k)[c], 3).alias(f"{c}{k}")
    return S.prepared(lines(spark, d)).select("id", area.alias("area"), ring.alias("ring")).select("id", F.round("area", 2).alias("area"), corner(1, "x"), corner(1, "y"), corner(3, "x"), corner(3, "y"))


def g9_parts(spark, d):
    """Laterals in two parts, the longer of which has a place that is hardly off its line."""
    mix = lambda f, off: G.point(F.col("a")["x"] + (F.col("b")["x"] - F.col("a")["x"]) * f + off, F.col("a")["y"] + (F.col("b")["y"] - F.col("a")["y"]) * f)
    parts = F.array(F.array("a", mix(0.2, 0.0)), F.array(mix(0.25, 0.0), mix(0.5, 0.05), mix(0.75, 0.0), "b"))
    found = S.single(laterals(spark, d).select("id", parts.alias("parts")))
    end = lambda p, c: F.round(p(F.col("coords"))[c], 3)
    return found.select("id", F.size("coords").alias("n"), end(G.first, "x").alias("ax"), end(G.first, "y").alias("ay"), end(G.last, "x").alias("bx"), end(G.last, "y").alias("by"))


def g3_resample(spark, d):
    bent = F.array(G.point(X.well(), X.well()), G.point(X.well() + 100, X.well()), G.point(X.well() + 100, X.well() + 95))
    straight = F.array(G.point(X.well(), X.well()), G.point(X.well() + 1, X.well()))
    lines = wells(spark, d).select(X.well().alias("id"), F.when(X.well() % 3 == 0, straight).otherwise(bent).alias("coords"))
    return S.resampled(lines, 100 / FT).groupBy("id").agg(F.count("*").alias("n"), F.round(F.max("x"), 4).alias("x"), F.round(F.max("y"), 4).alias("y"))


def g4_conformity(spark, d):
    ring = F.array(G.point(F.lit(0), F.lit(0)), G.point(X.well() % 7 + 1, F.lit(0)), G.point(X.well() % 7 + 1, X.well() % 5 + 1), G.point(F.lit(0), X.well() % 3 + 1))
    return S.conformity(wells(spark, d).select(X.well().alias("id"), ring.alias("coords"))).select("id", F.round("conformity", 4).alias("conformity"))


def g18_mesh(spark, d):
    ring = F.array(G.point(F.lit(0), F.lit(0)), G.point(X.well() % 7 + 1, F.lit(0)), G.point(F.lit(0), X.well() % 5 + 1))
    return S.mesh(wells(spark, d).select(X.well().alias("id"), ring.alias("coords"))).groupBy("id").agg(F.count("*").alias("n"), F.round(F.avg("x"), 4).alias("x"), F.round(F.avg("y"), 4).alias("y"))


def g13_relation(spark, d):
    return pairs(spark, d).select("wellid", "neighbor", S.relation(F.date_diff("first", "neighbor_first"), 70).alias("relation"))


def g14_running_nearest(spark, d):
    return w14_running_least(spark, d).where("distance = nearest").select("wellid", "neighbor")


def w14_running_least(spark, d):
    by = Window.partitionBy("wellid").orderBy("dt", "neighbor").rowsBetween(Window.unboundedPreceding, 0)
    rows = pairs(spark, d).withColumn("dt", F.greatest("first", "neighbor_first"))
    return rows.select("wellid", "neighbor", "distance", F.min("distance").over(by).alias("nearest"))


def w15_forward_fill(spark, d):
    rows = survey(spark, d).select("wellid", "md_ft", F.when((F.col("md_ft") + X.well() * 500) % 1500 == 0, F.col("tvd_ft")).alias("v"))
    return S.forward_fill(rows, ["wellid"], "md_ft", ["v"], {"v": -1.0})


def ag4_pivot_pairs(spark, d):
    by = Window.partitionBy("wellid", "side").orderBy("distance", "neighbor")
    near = pairs(spark, d).withColumn("p", F.row_number().over(by)).where("p = 1").withColumn("rel", S.relation(F.date_diff("first", "neighbor_first"), 70))
    wide = near.groupBy("wellid").pivot("side", ["LEFT", "RIGHT"]).agg(F.first("distance").alias("d"), F.first("rel").alias("r"))
    return wide.select("wellid", *(F.col(c) if c.endswith("r") else F.round(c, 4).alias(c) for c in ("LEFT_d", "LEFT_r", "RIGHT_d", "RIGHT_r")))


def jn5_outer_merge(spark, d):
    events = pairs(spark, d).select("wellid", "neighbor")
    merged = wells(spark, d).select("wellid", "basin").join(events, "wellid", "full")
    return merged.select("wellid", "basin", F.when(F.col("neighbor").isNull(), "left_only").otherwise("both").alias("found")).distinct()


def g15_parent_child(spark, d):
    own = wells(spark, d).select("wellid", F.col("firstproddate").alias("first"))
    out = S.parent_child(pairs(spark, d), own)
    return out.select("wellid", "dt", "relationship", *(F.round(c, 4).alias(c) for c in ("closest", "closest_left", "closest_right")), "scenario")


QUERIES = {f.__name__: f for f in (
    g1_wkt, g2_reproject, g3_resample, g4_conformity, g5_endpoints, g6_longest, g7_azimuth, g8_side, g9_buffers, g9_parts, g10_neighbours, g11_distances, g12_vertical_distance, g13_relation, g14_running_nearest, g15_parent_child, g16_tvd,
    g17_units, g18_mesh, g19_covers, g20_bilinear, g20_linear, g20_nearest, g20_smooth, g21_sample, g21_centres, g22_update_geology, src7_grid, snk6_bounds, jn16_spatial_join, w14_running_least, w15_forward_fill, ag4_pivot_pairs, jn5_outer_merge,
)} | {"jn17_distance_join": jn17_distance_join}

_PAIRS = f"""{W}, h as (select * from well_header where trajectory = 'HORIZONTAL'),
  pr as (select a.wellid, b.wellid as neighbor, a.firstproddate as first, b.firstproddate as nf, abs(a.x0 - b.x0) * 3.281::double as distance, case when b.x0 > a.x0 then 'RIGHT' else 'LEFT' end as side,
    case when abs(a.firstproddate - b.firstproddate) <= 70 then 'Co' when a.firstproddate < b.firstproddate then 'P' else 'C' end as rel, greatest(a.firstproddate, b.firstproddate) as dt
    from h a join h b on a.y0 = b.y0 and a.wellid <> b.wellid and abs(a.x0 - b.x0) <= 1609)"""
_LAT = f"{W}, lt as (select wellid as id, x0 as ax, y0 + 160 as ay, x0 + case when wellid % 6 = 0 then 150 else 0 end as bx, y0 + 160 + laterallength_ft / 3.281::double as by_ from well_header where trajectory = 'HORIZONTAL')"
#: Liang-Barsky clipping of the other lateral in the chord's frame, all pairs.
_CUT = f"""{_LAT}, h0 as (select *, 500 / 3.281::double as r, case when id % 5 = 0 then ax - 40 else ax end as sx, case when id % 5 = 0 then ay + 30 else ay end as sy from lt),
  h1 as (select *, bx - sx as ex, by_ - sy as ey, sx - ax as ox, sy - ay as oy from h0 where (bx - ax) ** 2 + (by_ - ay) ** 2 > r ** 2),
  h2 as (select *, (sqrt((ex * ox + ey * oy) ** 2 - (ex ** 2 + ey ** 2) * (ox ** 2 + oy ** 2 - r ** 2)) - (ex * ox + ey * oy)) / (ex ** 2 + ey ** 2) as tt from h1),
  lc as (select id, sx + ex * tt as ax, sy + ey * tt as ay, bx, by_ from h2)"""
_CLIP = f"""{_CUT}, c as (select a.id, b.id as other, sqrt((a.bx - a.ax) ** 2 + (a.by_ - a.ay) ** 2) as l, a.ax, a.ay, (a.bx - a.ax) as dx, (a.by_ - a.ay) as dy, b.ax as px, b.ay as py, b.bx as qx, b.by_ as qy from lc a, lc b where a.id <> b.id),
  f as (select *, ((px - ax) * dx + (py - ay) * dy) / l as s0, ((qx - ax) * dx + (qy - ay) * dy) / l as s1, ((py - ay) * dx - (px - ax) * dy) / l as c0, ((qy - ay) * dx - (qx - ax) * dy) / l as c1 from c),
  g as (select id, other, greatest(0, case when s1 = s0 then if(s0 between 0 and l, 0, 2) else least(-s0 / (s1 - s0), (l - s0) / (s1 - s0)) end, case when c1 = c0 then if(abs(c0) <= 500, 0, 2) else least((-500 - c0) / (c1 - c0), (500 - c0) / (c1 - c0)) end) as t0,
    least(1, case when s1 = s0 then if(s0 between 0 and l, 1, -1) else greatest(-s0 / (s1 - s0), (l - s0) / (s1 - s0)) end, case when c1 = c0 then if(abs(c0) <= 500, 1, -1) else greatest((-500 - c0) / (c1 - c0), (500 - c0) / (c1 - c0)) end) as t1 from f)"""
_NEAR = f"{W} select a.wellid as id, b.wellid as other, round(sqrt((a.x0 - b.x0) ** 2 + (a.y0 - b.y0) ** 2) * 3.281::double, 4) as feet from well_header a join well_header b on a.wellid <> b.wellid and sqrt((a.x0 - b.x0) ** 2 + (a.y0 - b.y0) ** 2) <= 1609"
_SPOTS = f"{W}, sp as (select wellid as id, ((wellid * 733) % 4200)::double as x, ((wellid * 377) % 4050 + 0.5)::double as y from well_header)"
#: Where geometries are sampled, and the values there of the grids that parts make.
_SAMPLE = f"""{W}, g as (select wellid as id, wellid % 3 as kind, ((wellid * 31) % 1500)::double as x, ((wellid * 17) % 2500)::double as y from well_header),
  pts as (select id, 0 as k, x, y from g where kind = 0
    union all select id, n, x + least(1500 * n / 49, 900), y + greatest(1500 * n / 49 - 900, 0) from g, (select unnest(generate_series(0, 49)) as n) where kind = 1
    union all select id, i * 14 + j, x + 700 * (i + 0.5::double) / 14, y + 1400 * (j + 0.5::double) / 14 from g, (select unnest(generate_series(0, 13)) as i), (select unnest(generate_series(0, 13)) as j) where kind = 2),
  centre as (select id, case kind when 0 then x when 1 then (900 * (x + 450) + 600 * (x + 900)) / 1500 else x + 350 end as cx, case kind when 0 then y when 1 then (900 * y + 600 * (y + 300)) / 1500 else y + 700 end as cy from g),
  node as (select p_partkey % 50 as i, p_partkey // 50 as j, p_retailprice::double as price, p_size::double as size from part),
  low as (select id, k, floor(x / 100)::int as i, floor(y / 100)::int as j, x / 100 - floor(x / 100) as fx, y / 100 - floor(y / 100) as fy from pts),
  near as (select id, k, i + a as i, j + b as j, (case a when 1 then fx else 1 - fx end) * (case b when 1 then fy else 1 - fy end) as w from low, (values (0, 0), (0, 1), (1, 0), (1, 1)) v(a, b)),
  z as (select id, k, case when count(price) = count(*) then sum(w * price) end as price, case when count(size) = count(*) then sum(w * size) end as size from near left join node using (i, j) where w > 0 group by 1, 2)"""
_SURVEY = f"{W}, sv as (select wellid, s * 500.0::double as md, round(6000 * (1 - exp(-s / (5 + wellid % 4))), 4) as z from well_header, (select unnest(generate_series(0, 20)) as s))"
ORACLES = {
    "g1_wkt": f"{W} select wellid, case when wellid % 5 <> 0 then x0 end as x, case when wellid % 5 <> 0 then -12.5::double end as y from well_header",
    "g2_reproject": f"{W} select wellid, x0 as x, y0 + 1000000 as y from well_header",
    "g3_resample": f"{W} select wellid as id, case when wellid % 3 = 0 then 2 else floor(195 / (100 / 3.281::double)) + 1 end::bigint as n, round(wellid + case when wellid % 3 = 0 then 1 else 100 end, 4)::double as x, round(wellid + case when wellid % 3 = 0 then 0 else floor(195 / (100 / 3.281::double)) * 100 / 3.281::double - 100 end, 4) as y from well_header",
    "g4_conformity": f"""{W}, p as (select wellid as id, (wellid % 7 + 1)::double as w, (wellid % 5 + 1)::double as h, (wellid % 3 + 1)::double as k from well_header), u as (select *, -w / sqrt(w * w + (k - h) ** 2) as ux, (k - h) / sqrt(w * w + (k - h) ** 2) as uy from p),
      r as (select *, (greatest(0, w * ux, w * ux + h * uy, k * uy) - least(0, w * ux, w * ux + h * uy, k * uy)) * (greatest(0, -w * uy, -w * uy + h * ux, k * ux) - least(0, -w * uy, -w * uy + h * ux, k * ux)) as slanted from u)
      select id, round(w * (h + k) / 2 / least(w * greatest(h, k), slanted), 4) as conformity from r""",
    "g18_mesh": f"""{W}, m as (select wellid as id, (wellid % 7 + 1) * (i + 0.5::double) / 14 as x, (wellid % 5 + 1) * (j + 0.5::double) / 14 as y from well_header, (select unnest(generate_series(0, 13)) as i), (select unnest(generate_series(0, 13)) as j) where i + j <= 13)
      select id, count(*) as n, round(avg(x), 4) as x, round(avg(y), 4) as y from m group by 1""",
    "g5_endpoints": f"{_LAT} select id, ay as first_y, round(by_, 4) as last_y from lt",
    "g6_longest": f"{W} select wellid, (5 + wellid % 9)::double as length from well_header",
    "g7_azimuth": f"{W}, v as (select wellid, (wellid * 37) % 21 - 10 as dx, (wellid * 53) % 23 - 11 as dy from well_header) select wellid, round(case when dx = 0 and dy = 0 then 0 else (degrees(atan2(dx, dy)) + 360) % 360 end, 4) as bearing, round(case when dx = 0 and dy = 0 then 0 else (degrees(atan2(dy, dx)) + 360) % 360 end, 4) as angle from v",
    "g8_side": f"{W} select wellid, case (wellid * 90 - wellid * 45 + 36000000) % 360 when 0 then 'IN-LINE' when 180 then 'IN-LINE' when 45 then 'RIGHT' when 90 then 'RIGHT' when 135 then 'RIGHT' else 'LEFT' end as side from well_header",
    "g9_parts": f"""{W}, la as (select wellid as id, x0 as ax, y0 + 160 as ay, x0 + case when wellid % 6 = 0 then 150 else 0 end as bx, y0 + 160 + laterallength_ft / 3.281 as by_ from well_header where trajectory = 'HORIZONTAL')
      select id, 2::int as n, round(ax + (bx - ax) * 0.25, 3) as ax, round(ay + (by_ - ay) * 0.25, 3) as ay, round(bx, 3) as bx, round(by_, 3) as by from la""",
    "g9_buffers": f"""{_CUT}, l as (select *, sqrt((bx - ax) ** 2 + (by_ - ay) ** 2) as l from lc)
      select id, round(1000 * l, 2) as area, round(ax + (by_ - ay) / l * 500, 3) as x1, round(ay - (bx - ax) / l * 500, 3) as y1, round(bx - (by_ - ay) / l * 500, 3) as x3, round(by_ + (bx - ax) / l * 500, 3) as y3 from l""",
    "g10_neighbours": f"{_CLIP} select id, count(*) as n, min(other) as least, max(other) as most from g where t0 <= t1 group by 1",
    "g12_vertical_distance": _NEAR,
    "jn17_distance_join": _NEAR,
    "g13_relation": f"{_PAIRS} select wellid, neighbor, rel as relation from pr",
    "g14_running_nearest": f"{_PAIRS} select a.wellid, a.neighbor from pr a where a.distance <= (select min(distance) from pr b where b.wellid = a.wellid and (b.dt < a.dt or (b.dt = a.dt and b.neighbor <= a.neighbor)))",
    "g15_parent_child": f"""{_PAIRS}, n as (select *, min(distance) over (partition by wellid, side order by dt) as peers from pr),
      r as (select * from (select a.*, (select min(distance) from pr b where b.wellid = a.wellid and b.side = a.side and b.dt <= a.dt) as near from pr a) where distance = near qualify row_number() over (partition by wellid, side, dt order by distance, neighbor) = 1),
      dts as (select distinct wellid, dt from r),
      w as (select wellid, dt, (select arg_max(distance, dt) from r where r.wellid = d.wellid and r.dt <= d.dt and side = 'LEFT') as ld, (select arg_max(rel, dt) from r where r.wellid = d.wellid and r.dt <= d.dt and side = 'LEFT') as lr,
        (select arg_max(distance, dt) from r where r.wellid = d.wellid and r.dt <= d.dt and side = 'RIGHT') as rd, (select arg_max(rel, dt) from r where r.wellid = d.wellid and r.dt <= d.dt and side = 'RIGHT') as rr from dts d)
      select h.wellid, coalesce(w.dt, h.firstproddate) as dt, case when w.dt is null then 'S' else coalesce(lr, '') || '|' || coalesce(rr, '') end as relationship, round(least(ld, rd), 4) as closest, round(ld, 4) as closest_left, round(rd, 4) as closest_right, 'BASE' as scenario
      from well_header h left join w on w.wellid = h.wellid""",
    "g16_tvd": f"""{_SURVEY}, q as (select wellid, ((wellid * 131) % 11500)::double as md from well_header), lo as (select q.wellid, q.md, max(sv.md) as m0 from q join sv on sv.wellid = q.wellid and sv.md <= q.md group by 1, 2)
      select lo.wellid, lo.md, round(case when lo.md = m0 then a.z when b.md is not null then a.z + (lo.md - m0) / 500 * (b.z - a.z) end, 4) as tvd from lo join sv a on a.wellid = lo.wellid and a.md = m0 left join sv b on b.wellid = lo.wellid and b.md = m0 + 500""",
    "g17_units": f"{W} select wellid, round(case when wellid % 2 = 0 then x0 * 0.3048006096012192::double else x0 end, 4) as x from well_header",
    "g19_covers": f"""{W}, p as (select wellid, wellid % 13 - 1 as x, (wellid * 7) % 12 as y from well_header)
      select wellid, x between 0 and 10 and y between 0 and 10 and (case when x <= 5 then y <= 10 - 1.2::double * x + 1e-9 else y <= 4 + 1.2::double * (x - 5) + 1e-9 end) as inside from p""",
    "g20_bilinear": f"{_SPOTS} select id, case when x <= 4000 and y <= 4000 then round(x * 2 - y * 3 + x * y / 1000 + 50, 4) end as z from sp",
    "g20_smooth": f"{_SPOTS} select id, case when x <= 4000 and y <= 4000 then round(x * 2 - y * 3 + x * y / 1000 - y * y / 2000 + 50, 3) end as z from sp",
    "g20_linear": f"{_SPOTS} select id, case when x <= 4000 and y <= 4000 then round(x * 2 - y * 3 + 50, 4) end as z from sp",
    "g20_nearest": f"""{_SPOTS}, gr as (select i * 100.0::double as gx, j * 100.0::double as gy from (select unnest(generate_series(0, 40)) as i), (select unnest(generate_series(0, 40)) as j)),
      n as (select id, gx, gy from sp join gr on sqrt((x - gx) ** 2 + (y - gy) ** 2) < 1e9 qualify row_number() over (partition by id order by sqrt((x - gx) ** 2 + (y - gy) ** 2), gx, gy) = 1)
      select id, gx * 2 - gy * 3 + gx * gy / 1000 + 50 as z from sp left join n using (id)""",
    "g21_sample": f"{_SAMPLE} select id, any_value(round(cx, 4)) as centroid_x, any_value(round(cy, 4)) as centroid_y, count(*) as n, count(price) as n_valid, round(avg(price), 4) as mean, round(stddev_pop(price), 4) as std, round(min(price), 4) as least, round(max(price), 4) as most from z join centre using (id) group by 1",
    "g21_centres": f"{_SAMPLE}, d as (select id, price, power(i * 100 - cx, 2) + power(j * 100 - cy, 2) as gap, i, j from centre, node) select id, 1::bigint as n, round(price, 4) as mean from d qualify row_number() over (partition by id order by gap, i, j) = 1",
    "g22_update_geology": f"""{_SAMPLE}, m as (select id, avg(price) as price, avg(size) as size from z group by 1)
      select wellid as id, case when wellid % 5 = 0 then 'OTHER' else 'GRIDS' end as datasource, round(case when wellid % 5 = 0 then 1 when wellid % 2 = 0 then price + size end, 4) as top, round(case when wellid % 5 = 0 then 2 else size end, 4) as base from well_header join m on id = wellid""",
    "src7_grid": "select (p_partkey % 50 * 100)::double as x, (p_partkey // 50 * 100)::double as y, p_retailprice::double as z from part",
    "snk6_bounds": f"{W} select min(y0) as min_y, max(y0) as max_y, min(x0) as min_x, max(x0) as max_x from well_header",
    "jn16_spatial_join": f"{_CLIP} select id, other from g where t0 <= t1",
    "w14_running_least": f"{_PAIRS} select a.wellid, a.neighbor, a.distance, (select min(distance) from pr b where b.wellid = a.wellid and (b.dt < a.dt or (b.dt = a.dt and b.neighbor <= a.neighbor))) as nearest from pr a",
    "w15_forward_fill": f"{_SURVEY}, v as (select wellid, md, case when (md + wellid * 500) % 1500 = 0 then z end as v from sv) select wellid, md as md_ft, coalesce(last_value(v ignore nulls) over (partition by wellid order by md), -1) as v from v",
    "ag4_pivot_pairs": f"""{_PAIRS}, n as (select * from pr qualify row_number() over (partition by wellid, side order by distance, neighbor) = 1)
      select wellid, round(max(distance) filter (side = 'LEFT'), 4) as LEFT_d, max(rel) filter (side = 'LEFT') as LEFT_r, round(max(distance) filter (side = 'RIGHT'), 4) as RIGHT_d, max(rel) filter (side = 'RIGHT') as RIGHT_r from n group by 1""",
    "jn5_outer_merge": f"{_PAIRS} select w.wellid, basin, case when exists (select 1 from pr where pr.wellid = w.wellid) then 'both' else 'left_only' end as found from well_header w",
}
