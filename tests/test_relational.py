"""Upserts, headers, relationships, geometry, tables and streams on small cases, and every query against its SQL."""

import os
from itertools import groupby

import duckdb
import pytest
from pyspark.sql import functions as F

from wellfield.functions import fluids as L
from wellfield.functions import geometry as G
from wellfield.operators import header as H
from wellfield.operators import spacing as S
from wellfield.operators import upsert as U
from wellfield.plans import registry
from wellfield.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"create view {file.split('.')[0]} as select * from '{SF}/{file}'")
    return con


def canon(rows):
    return sorted((tuple(round(float(v), 6) if isinstance(v, float) else str(v) for v in row) for row in rows), key=str)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_its_sql(spark, oracle, name):
    got = registry.queries()[name](spark, SF)
    result = oracle.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert canon(tuple(r[c] for c in columns) for r in got.collect()) == canon(result.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_runs(spark, name):
    got = registry.queries()[name](spark, SF)
    rows = got.collect()
    assert rows and any(v is not None for r in rows for v in r)


def plain_value(t, i, price, rate, ratio):
    """One well's months, one after another."""
    t, full = t.sort_values("month").to_dict("records"), i["wi"] == 0 or i["nri"] / i["wi"] > 1 - i["roy"]
    first = min((m["month"] for m in t if m["oil"] + m["gas"] > 0), default=float("inf"))

    def op(m, wi, nri):
        produced, invested = i["weight"] * i["prod_wt"], i["weight"] * i["inv_wt"]
        oil = m["oil"] * nri * produced * (price + i["paj_oil"])
        gas = m["gas"] * nri * i["shrink"] * produced * i["btu"] * (price / ratio + i["paj_gas"])
        ngl = i["ngl_yield"] * m["gas"] * nri * produced * price * i["paj_ngl"]
        tax = oil * i["stx_oil"] + gas * i["stx_gas"] + ngl * i["stx_ngl"] + (oil + gas + ngl) * i["adval"]
        cost = wi * invested * (i["prod_wt"] * (m["oil"] * i["opc_oil"] + m["gas"] * i["shrink"] * i["opc_gas"] + m["water"] * i["opc_wtr"]) + i["opc_fix"])
        return oil + gas + ngl - tax - (cost if m["month"] >= first else 0)

    so_far, best, life = 0.0, -float("inf"), 0
    for k, m in enumerate(t):
        so_far += op(m, 1.0, 1 - i["roy"]) if full else op(m, i["wi"], i["nri"])
        if so_far > best:
            best, life = so_far, k
    end, total = min(life + int(i["eloss"]), len(t)) - 1, 0.0
    for m in t:
        if m["month"] <= end:
            net = op(m, i["wi"], i["nri"]) - (i["capex"] * i["weight"] * i["inv_wt"] * i["wi"] if m["month"] == first else 0) - (i["aban"] * i["weight"] * i["inv_wt"] * i["wi"] if m["month"] == end else 0)
            total += net / (1 + rate) ** ((m["month"] + 0.5) / 12)
    return total


def test_breakeven_is_where_the_value_turns(spark):
    """At a cent more the value is positive, at a cent less it is not; a null price has a value of one sign only."""
    import pandas as pd

    from wellfield.plans import economics as P

    price = {r.uid: r.price for r in registry.queries()["e8_breakeven"](spark, SF).collect()}
    months = P.volumes(spark, SF).toPandas().sort_values("month").astype(float)
    inputs = {r.uid: r.asDict() for r in P.inputs(spark, SF).collect()}
    assert len(price) == months["uid"].nunique() and sum(p is not None for p in price.values()) > len(price) / 2
    for uid, table in months.groupby("uid"):
        value = lambda p: plain_value(pd.DataFrame(table), inputs[int(uid)], p, 0.1, 20.0) > 0  # noqa: B023, E731
        p = price[int(uid)]
        assert (value(-1e9), value(1e9)) in ((True, True), (False, False)) if p is None else (value(p + 0.01), value(p - 0.01)) == (True, False)


def test_roots_of_many_functions():
    """Each bracket grows on its own; no root where a function never changes its sign."""
    import numpy as np

    from wellfield.operators.economics import _roots

    at = np.array([0.3, -7.25, 1e6, 49.0])
    assert _roots(lambda x: at - x, 4, 0.0, 1.0) == pytest.approx(at, rel=1e-14)
    both = _roots(lambda x: np.array([1.0, -1.0, 5.0 - x[2]]), 3, 0.0, 1.0)
    assert np.isnan(both[:2]).all() and both[2] == pytest.approx(5)


def test_merge_refuses_two_rows_for_one_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        U.merge(target, source, ["k"]).collect()
    assert U.merge(target, U.latest_wins(source, ["k"], "v"), ["k"]).first().v == "c"


def test_merge_twice_is_merge_once(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 0)], "k int, v string, w int")
    source = spark.createDataFrame([(2, None, 9), (3, "c", 3), (None, "m", 5)], "k int, v string, w int")
    once = U.merge(target, source, ["k"], coalesce_old=["v"], keep_old=["w"])
    assert sorted(map(str, once.collect())) == sorted(map(str, [*target.where("k = 1").collect(), *spark.createDataFrame([(2, "b", 2), (3, "c", 3), (None, "n", 0), (None, "m", 5)], target.schema).collect()]))
    keyed = U.merge(target.where("k is not null"), source.where("k is not null"), ["k"])
    assert sorted(keyed.collect()) == sorted(U.merge(keyed, source.where("k is not null"), ["k"]).collect())


def test_newer_wins_in_any_order(spark):
    row = lambda v, t: spark.createDataFrame([(1, v, t)], "k int, v string, t int")
    assert U.merge(U.merge(row("a", 1), row("b", 3), ["k"], only_newer="t"), row("c", 2), ["k"], only_newer="t").first().v == "b"
    assert U.merge(U.merge(row("a", 1), row("c", 2), ["k"], only_newer="t"), row("b", 3), ["k"], only_newer="t").first().v == "b"


def test_update_needs_its_keys(spark):
    with pytest.raises(ValueError):
        U.update_from(spark.range(1), spark.range(1).toDF("x"), ["id"])


@pytest.mark.parametrize("feet, bin_", [(None, "SHORT"), (4499.0, "SHORT"), (4500.0, "5K"), (5499.5, "LONG"), (8500.0, "10K"), (11001.0, "LONG")])
def test_length_bins(spark, feet, bin_):
    assert spark.createDataFrame([(feet,)], "f double").select(H.length_bin(F.col("f"))).first()[0] == bin_


@pytest.mark.parametrize("text, api", [("42-123-45678-01", "4212345678"), ("5-123-45678", "0512345678"), ("", None), (None, None)])
def test_api_numbers(spark, text, api):
    if text == "5-123-45678":
        text = "5-123-45-678"
    assert spark.createDataFrame([(text,)], "t string").select(H.clean_api(F.col("t"))).first()[0] == api


@pytest.mark.parametrize("reference, other, side", [(0, 90, "RIGHT"), (0, 270, "LEFT"), (0, 180, "IN-LINE"), (90, 0, "LEFT")])
def test_sides(spark, reference, other, side):
    assert spark.range(1).select(G.side(F.lit(float(reference)), F.lit(float(other)))).first()[0] == side


def test_relations_and_lone_wells(spark):
    got = spark.createDataFrame([(70,), (-70,), (71,), (-71,)], "d int").select(S.relation(F.col("d"), 70)).collect()
    assert [r[0] for r in got] == ["Co", "Co", "C", "P"]
    wells = spark.sql("select 1 as wellid, date '2020-01-01' as first union all select 2, date '2019-01-01'")
    pairs = spark.sql("select 1 as wellid, 2 as neighbor, date '2020-01-01' as first, date '2019-06-15' as neighbor_first, 500.0D as distance, 'LEFT' as side")
    rows = {r.wellid: r for r in S.parent_child(pairs, wells).collect()}
    assert rows[1].relationship == "C|" and rows[2].relationship == "S" and rows[2].closest is None


def test_grid_round_trip(spark):
    rows = spark.createDataFrame([(-102.5, 31.5), (-97.0, 28.0), (-100.0, 18.0)], "lon double, lat double").withColumn("p", G.project(F.col("lon"), F.col("lat")))
    back = rows.withColumn("d", G.unproject(F.col("p.x"), F.col("p.y"))).collect()
    assert all(abs(r.d.x - r.lon) < 1e-9 and abs(r.d.y - r.lat) < 1e-9 for r in back)
    assert abs(back[2].p.x - 1500000) < 1e-6 and abs(back[2].p.y - 6000000) < 1e-6


def test_every_grid_point_comes_back(spark):
    """Also beside a pole, at the apex of the cone and off the ellipsoid, where latitudes are formal ones beyond 90."""
    rows = spark.range(0, 400_000, 7).select((1500000.0 + F.col("id") % 10 * 300).alias("x"), (7000000.0 + F.floor(F.col("id") / 10) * 2500).cast("double").alias("y"))
    back = rows.withColumn("d", G.unproject(F.col("x"), F.col("y"))).withColumn("p", G.project(F.col("d.x"), F.col("d.y")))
    away = back.where("round(p.x, 2) <> x or round(p.y, 2) <> y or p.x is null or isnan(p.x) or isnan(p.y)")
    assert away.count() == 0
    lowest, highest = back.agg(F.min("d.y"), F.max("d.y")).first()
    assert lowest < -90 and highest > 90


def test_days_of_a_month_are_counted_in_one_aggregate(spark):
    """Distinct dates took a shuffle and two aggregates of their own."""
    from wellfield.sources import fixtures as X

    got = X.production(spark, SF)
    assert got._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") == 2
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    want = lines.groupBy("l_suppkey", F.last_day(F.col("l_shipdate").cast("date")), "l_returnflag", "l_linestatus").agg(F.count_distinct(F.col("l_shipdate").cast("date")).alias("n"))
    assert got.agg(F.sum("producingdays"), F.max("producingdays"), F.count("*")).first() == want.agg(F.sum("n"), F.max("n"), F.count("*")).first()
    assert dict(got.dtypes)["producingdays"] == "bigint"


def test_wkt(spark):
    row = spark.createDataFrame([("POINT (1 -2.5)",), ("LINESTRING (0 0, 3 4)",), ("nothing",)], "t string").select(G.from_wkt(F.col("t")).alias("c")).collect()
    assert [len(r.c or []) for r in row] == [1, 2, 0]


def test_clipped_laterals(spark):
    point = lambda x, y: (float(x), float(y))
    rows = spark.createDataFrame([(1, point(0, 0), point(0, 1000)), (2, point(300, -500), point(300, 1500)), (3, point(900, 0), point(900, 1000))], "id int, a struct<x: double, y: double>, b struct<x: double, y: double>")
    pairs = S.lateral_pairs(rows, 400.0)
    assert sorted((r.id, r.other) for r in pairs.collect()) == [(1, 2), (2, 1)]
    got = {(r.id, r.other): r for r in S.spacing(pairs, 400.0).collect()}
    assert got[1, 2].fraction == pytest.approx(0.5) and got[1, 2].min_ft == pytest.approx(300 * 3.281) and got[1, 2].position == "RIGHT" and got[2, 1].position == "LEFT"


def test_tables(spark, tmp_path):
    from pyspark.sql import types as T

    schema = tables.schema_of({"a": "float64", "b": "int32", "c": "object"}, {"b": T.LongType()})
    assert schema.simpleString() == "struct<a:double,b:bigint,c:string>"
    with pytest.raises(ValueError):
        tables.schema_of({"a": "complex"})
    df = spark.createDataFrame([(float("nan"), 1, "x", 5)], "a double, b int, c string, extra int")
    tables.append(df, str(tmp_path / "t"), schema)
    tables.append(df, str(tmp_path / "t"), schema)
    assert [r.a for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [None, None]
    tables.reload(df, str(tmp_path / "t2"), by=("c",))
    (tmp_path / "grid.csv").write_text("1;2;3\n4;5;6\n")
    assert tables.read_grid(spark, str(tmp_path / "grid.csv"), ";").agg(F.sum("z")).first()[0] == 9.0
    assert tables.read_query(spark, "select :x + 1 as y", x=2).first().y == 3
    with pytest.raises(Exception, match="measure"):
        tables.checked(spark.sql("select 'BAD' as measure")).collect()
    settings = tables.Settings()
    assert settings.get("geology")["samples"] == 50
    for section, name, error in (("none", "default", KeyError), ("geology", "none", KeyError)):
        with pytest.raises(error):
            settings.get(section, name)


def test_geometry_on_lines(spark):
    rows = spark.sql("select 1 as id, array(named_struct('x', 0.0D, 'y', 0.0D), named_struct('x', 10.0D, 'y', 0.0D), named_struct('x', 10.0D, 'y', 10.0D)) as coords")
    assert S.resampled(rows, 5.0).count() == 5
    square = spark.sql("select 1 as id, array(named_struct('x', 0.0D, 'y', 0.0D), named_struct('x', 4.0D, 'y', 4.0D), named_struct('x', 0.0D, 'y', 8.0D), named_struct('x', -4.0D, 'y', 4.0D)) as coords")
    assert S.conformity(square).first().conformity == pytest.approx(1.0)


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_rows_with_null_keys_are_spread(spark):
    """They never match, and however many there are, no task gets them all."""
    source = spark.range(100_000).selectExpr("cast(null as long) as k", "id as v", "1 as w")
    target = spark.createDataFrame([(1, 5, 5), (None, 6, 6)], "k long, v long, w int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = U.merge(target, source.unionByName(spark.createDataFrame([(1, 7, 7), (2, 8, 8)], source.schema)), ["k"])
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 100_003 and max(sizes) < 40_000
    assert sorted(map(tuple, out.where("k is not null").collect())) == [(1, 7, 7), (2, 8, 8)]


def test_pseudo_pressure_halves_outside_of_interpreted_functions(spark):
    """Nested higher-order functions cost milliseconds a row; the roots are those of z_factor."""
    rows = spark.range(300).select("id", *((F.col("id") % n * k + a).cast("double").alias(c) for c, n, k, a in (("p", 250, 12, 300), ("t", 150, 1, 100), ("sg", 30, 0.01, 0.6), ("co2", 3, 0.01, 0), ("h2s", 2, 0.005, 0))))
    plan = L.pseudo_pressure(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "_z_factors" in plan and "sequence(" not in plan and plan.count("aggregate(") == 1
    parts = [F.col(c) for c in ("p", "t", "sg", "co2", "h2s")]
    tr = (parts[1] + L.RANKINE) / L.critical_temperature(*parts[2:])
    k = 0.27 * (parts[0] / L.critical_pressure(*parts[2:])) / tr
    both = rows.withColumn("z", L.z_factor(*parts)).withColumn("fast", L._z_factors(*L._state(tr), F.array(k, F.lit(None).cast("double"))))
    assert all(abs(r.z - r.fast[0]) < 1e-12 and r.fast[1] is None for r in both.collect())


def test_pseudo_pressure_is_the_integral(spark):
    """Against trapezoids over 4,000 pressures; rows that repeat stay apart."""
    rows = spark.createDataFrame([(1, 3000.0, 150.0, 0.7, 0.01, 0.0), (1, 3000.0, 150.0, 0.7, 0.01, 0.0), (2, 900.0, 90.0, 0.65, 0.0, 0.02)], "id int, p double, t double, sg double, co2 double, h2s double")
    got = {}
    for r in L.pseudo_pressure(rows).collect():
        got.setdefault(r["id"], []).append(r["m"])
    assert len(got[1]) == 2 and got[1][0] == got[1][1]
    steps = rows.distinct().withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(4000)))).withColumn("at", F.col("p") * F.col("n") / 4000)
    z = L.z_factor(F.col("at"), F.col("t"), F.col("sg"), F.col("co2"), F.col("h2s"))
    curve = steps.withColumn("z", z).withColumn("f", F.col("at") / (L.gas_viscosity(F.col("at"), F.col("t"), F.col("sg"), F.col("z")) * F.col("z")))
    for key, rows_ in groupby(curve.orderBy("id", "at").collect(), key=lambda r: r["id"]):
        own = list(rows_)
        area = sum((a["f"] + b["f"]) / 2 * (b["at"] - a["at"]) for a, b in zip(own, own[1:])) + own[0]["f"] * own[0]["at"] / 2
        assert got[key][0] == pytest.approx(area, rel=1e-5)
    assert "Exchange" not in L.pseudo_pressure(rows)._jdf.queryExecution().executedPlan().toString()


def test_free_gas_solves_both_equations(spark):
    """What is left of both equations at the roots: the bubble point of the gas in solution is the pressure, and Corey's
    fractional flow is the produced one. Above the bubble point there is no free gas."""
    data = [(k, p, 180.0, gor, 35.0, 0.75, 0.2, 0.01, 0.0) for k, (p, gor) in enumerate([(900.0, 600.0), (1500.0, 900.0), (400.0, 500.0), (2500.0, 5000.0), (6000.0, 500.0)])]
    rows = spark.createDataFrame(data, "id int, p double, t double, gor double, api double, sg double, sw double, co2 double, h2s double")
    found = L.free_gas(rows).withColumn("again", L.bubble_point(F.col("t"), F.col("rsb"), F.col("api"), F.col("sg"))).orderBy("id").collect()
    for r in found[:4]:
        assert r.rsb < r.gor and r.again == pytest.approx(r.p, rel=1e-9) and r.pb == r.p
        room, oil = 1 - 0.3 - r.sw, 1 - r.sw - r.gas_sat
        krg, kro = 0.8 * (r.gas_sat / room) ** 3, 0.7 * ((oil - 0.3) / room) ** 3
        gas = (r.gor - r.rsb) * r.bg / 5.615
        assert krg / r.mu_g / (krg / r.mu_g + kro / r.mu_o) == pytest.approx(gas / (r.bo + gas), abs=1e-9)
        assert 0 < r.gas_sat < room and r.oil_sat == pytest.approx(oil)
    assert found[4].gas_sat == 0 and found[4].rsb == found[4].gor and found[4].pb < found[4].p


def test_distances_between_laterals_by_sampling(spark):
    """A lateral's spacing to another against places sampled along it, each with its nearest place on the other."""
    import numpy as np

    rng = np.random.default_rng(6)
    ends = [(k, (float(x), float(y)), (float(x + dx), float(y + dy))) for k, ((x, y), (dx, dy)) in enumerate(zip(rng.random((6, 2)) * [600, 300], rng.normal([40, 900], [60, 200], (6, 2))))]
    frame = spark.createDataFrame(ends, "id int, a struct<x: double, y: double>, b struct<x: double, y: double>")
    pairs = S.lateral_pairs(frame, 800.0)
    got = {(r["id"], r["other"]): r for r in pairs.collect()}
    line = {k: np.linspace(a, b, 4001) for k, a, b in ends}
    for (i, j), r in got.items():
        (ax, ay), (bx, by) = ends[i][1], ends[i][2]
        along, span = np.array([bx - ax, by - ay]), np.hypot(bx - ax, by - ay)
        rel = line[j] - [ax, ay]
        s, across = rel @ along / span, (rel[:, 1] * along[0] - rel[:, 0] * along[1]) / span
        inside = (s >= 0) & (s <= span) & (np.abs(across) <= 800)
        assert inside.any() or r["t1"] - r["t0"] < 1e-3
        if inside.any():
            t = np.flatnonzero(inside) / 4000
            assert (r["t0"], r["t1"]) == pytest.approx((t[0], t[-1]), abs=5e-4)
    for i, *_ in ends:
        for j, *_ in ends:
            if i != j and (i, j) not in got:
                (ax, ay), (bx, by) = ends[i][1], ends[i][2]
                along, span = np.array([bx - ax, by - ay]), np.hypot(bx - ax, by - ay)
                rel = line[j] - [ax, ay]
                s, across = rel @ along / span, (rel[:, 1] * along[0] - rel[:, 0] * along[1]) / span
                assert not ((s > 1e-6) & (s < span - 1e-6) & (np.abs(across) < 800 - 1e-6)).any()
