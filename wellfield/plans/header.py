"""Queries over well and completion headers: projections, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import header as H
from ..operators import production as P
from ..sources import fixtures as X

W = f"with {X.SQL}"


def angle():
    return (X.well() * 37) % 180


def text():
    return F.concat(X.well(), F.lit("-123-4567"), X.well() % 10, F.lit("-01"))


def prj1_override(spark, d):
    wells = X.well_header(spark, d).withColumn("datasource", F.lit("PRIMARY"))
    return H.override(wells, X.well_override(spark, d), ["wellid", "datasource"]).select("wellid", "basin", "laterallength_ft")


def prj3_length_bin(spark, d):
    feet = F.when(X.well() % 11 != 0, F.col("laterallength_ft") + (X.well() % 2) / 2)
    return X.well_header(spark, d).select("wellid", H.length_bin(feet).alias("ll_bin"))


def prj4_primary_phase(spark, d):
    from .production import months

    return P.producing_ratios(months(spark, d)).select("wellid", H.primary_phase(F.col("gor")).alias("phase"))


def prj7_toe_up(spark, d):
    return X.well_header(spark, d).select("wellid", H.toe_up(angle()).alias("toeup"))


def prj8_zone_distance(spark, d):
    return X.well_header(spark, d).select("wellid", F.abs(F.col("laterallength_ft") - 7000).alias("to_base"), F.abs(F.col("laterallength_ft") - 5000).alias("to_top"))


def prj9_text(spark, d):
    return X.well_header(spark, d).select("wellid", F.upper("fitmethod").alias("method"), F.left("operator", F.lit(4)).alias("short"), F.left(X.well().cast("string"), F.lit(2)).alias("id_text"))


def prj10_try_cast(spark, d):
    text = F.when(X.well() % 3 == 0, F.concat(X.well().cast("string"), F.lit(".5"))).otherwise(F.concat(F.lit("n/a "), X.well().cast("string")))
    return X.well_header(spark, d).select("wellid", text.try_cast("double").alias("size"))


def prj11_fit_method(spark, d):
    return X.well_header(spark, d).select("wellid", H.fit_method(F.col("fitmethod")).alias("method"))


def prj12_api(spark, d):
    return X.well_header(spark, d).select("wellid", H.clean_api(text()).alias("api"))


def prj13_select_eur(spark, d):
    sums = X.production(spark, d).groupBy("wellid").pivot("measure", list(P.PHASES)).agg(F.sum("value"))
    pick = F.when(X.well() % 3 == 0, F.col("OIL")).when(X.well() % 3 == 1, F.col("GAS")).otherwise(0.0)
    return sums.select("wellid", F.coalesce(pick, F.lit(0.0)).alias("eur"))


def flt1_status(spark, d):
    wells = X.well_header(spark, d)
    return wells.where(~F.col("wellstatus").like("%DUC%") & ~F.col("basin").isin("ASIA") & ((F.col("fitmethod") != "curve_fit") | F.col("fitmethod").isNull())).select("wellid", "wellstatus", "basin", "fitmethod")


def flt2_candidates(spark, d):
    return H.spacing_candidates(X.well_header(spark, d), since=2006, least_feet=4000, basins=["ASIA", "EUROPE"]).select("wellid", "basin")


def flt3_other_candidates(spark, d):
    return H.spacing_candidates(X.well_header(spark, d), since=2006, least_feet=4000, basins=["ASIA", "EUROPE"], inside=False).select("wellid", "basin")


def flt4_stale(spark, d):
    updates = X.production(spark, d).select(F.col("datecreated").cast("date").alias("updatedate"))
    return H.stale(X.well_header(spark, d), updates, "updatedate", 30, "2020-01-01").select("wellid")


def flt7_two_points(spark, d):
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    coords = F.array(point(F.col("x0"), F.col("y0")), point(F.col("x0"), F.col("y0") + F.when(X.well() % 4 == 0, 0).otherwise(100)))
    return X.well_header(spark, d).withColumn("coords", coords).where(F.size(F.array_distinct("coords")) >= 2).select("wellid")


def jn1_inner(spark, d):
    wells = X.well_header(spark, d).select("wellid", "basin")
    return X.completion_header(spark, d).join(wells, "wellid").select("completionid", "wellid", "basin")


def jn2_left_outer(spark, d):
    own = X.well_override(spark, d).select("wellid", F.col("basin").alias("own_basin"))
    return X.well_header(spark, d).join(own, "wellid", "left").select("wellid", "basin", "own_basin")


def jn3_nullable_key(spark, d):
    wells = X.well_header(spark, d).select("wellid", F.when(X.well() % 2 == 0, F.col("currentcompletionid")).alias("own"))
    same = (wells["wellid"] == F.col("w")) & (F.col("own").isNull() | (F.col("own") == F.col("completionid")))
    return wells.join(X.completion_header(spark, d).select(F.col("wellid").alias("w"), "completionid"), same, "left").select("wellid", "completionid")


def jn4_full_outer(spark, d):
    sums = lambda m, n: X.production(spark, d).where((F.col("measure") == m) & (X.well() % 3 != n)).groupBy("wellid").agg(F.sum("value").alias(m.lower()))
    return sums("OIL", 1).join(sums("WATER", 2), "wellid", "full").select("wellid", "oil", "water")


def jn6_cross(spark, d):
    first = X.well_header(spark, d).agg(F.min("firstproddate").alias("first"))
    return X.well_header(spark, d).crossJoin(F.broadcast(first)).select("wellid", F.date_diff("firstproddate", "first").alias("days"))


def jn12_best_completion(spark, d):
    return H.best_completion(X.completion_header(spark, d)).select("wellid", "completionid", "datasource")


def jn13_earliest(spark, d):
    first = X.production(spark, d).groupBy("wellid").agg(F.min("dt").alias("first"), F.min(F.when(F.col("measure") == "OIL", F.col("dt"))).alias("first_oil"))
    return X.well_header(spark, d).join(first, "wellid", "left").select("wellid", "first", "first_oil")


def jn15_cast_key(spark, d):
    texts = X.completion_header(spark, d).select("completionid", X.well().cast("string").alias("well_text"))
    return X.well_header(spark, d).join(texts, X.well().cast("string") == F.col("well_text")).select("wellid", "completionid")


def jn18_explode_merge(spark, d):
    lists = X.well_header(spark, d).groupBy("y0").agg(F.sort_array(F.collect_list("wellid")).alias("ids"))
    near = X.well_header(spark, d).select(X.well().alias("own"), "y0").join(lists, "y0").select("own", F.explode("ids").alias("wellid")).where("own <> wellid")
    return near.join(X.well_header(spark, d).select("wellid", "operator"), "wellid").select("own", F.col("wellid").alias("other"), "operator")


def jn19_xref(spark, d):
    second = X.completion_header(spark, d).where("datasource = 'SECONDARY'").select("wellid", F.col("completionid").alias("second_id")).distinct()
    first = X.completion_header(spark, d).where("datasource = 'PRIMARY'").select("wellid", F.col("completionid").alias("first_id"))
    return X.well_header(spark, d).select("wellid").join(first, "wellid").join(second, "wellid", "left").distinct()


def w6_latest(spark, d):
    return H.latest(X.production(spark, d), ["wellid", "measure"], F.desc("dt"), F.col("datasource")).select("wellid", "measure", "dt", "datasource")


def w7_preferred_source(spark, d):
    by = Window.partitionBy("wellid").orderBy(P.priority("datasource", ("SECONDARY", "PRIMARY")))
    return X.completion_header(spark, d).withColumn("r", F.dense_rank().over(by)).where("r = 1").select("wellid", "completionid")


def w9_two_keys(spark, d):
    order = (P.priority("datasource", P.SOURCES), P.priority("interval_name", ("zone1", "zone2")), F.col("completionid"))
    return H.latest(X.completion_header(spark, d), ["interval_name", "oilgravity_api"], *order).select("interval_name", "oilgravity_api", "wellid", "completionid")


def w11_surrogates(spark, d):
    start = X.well_header(spark, d).agg(F.max("wellid")).first()[0] or 0
    return P.numbered_after(X.completion_header(spark, d).select("completionid"), ["completionid"], start).select("completionid", "newid")


def ag8_first_of_key(spark, d):
    return H.latest(X.well_header(spark, d), ["operator"], F.col("firstproddate"), X.well()).select("operator", "wellid")


def ag9_duplicates(spark, d):
    return H.duplicated(X.well_header(spark, d), ["operator"]).select("operator", "wellid")


def ag11_lists(spark, d):
    lists = X.well_header(spark, d).groupBy("basin").agg(F.sort_array(F.collect_list("wellid")).alias("ids"))
    return lists.select("basin", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))


def ag12_statistics(spark, d):
    v = "laterallength_ft"
    stats = (F.avg(v), F.stddev_pop(v), F.min(v), F.max(v), F.median(v))
    return X.well_header(spark, d).groupBy("basin").agg(*(F.round(s, 4).alias(n) for s, n in zip(stats, ("mean", "std", "least", "most", "middle"))), F.count(v).alias("n"))


def header_view(spark, d):
    wells = X.well_header(spark, d).where("wellstatus <> 'DUC'")
    best = H.best_completion(X.completion_header(spark, d)).select("wellid", "completionid", "proppant_lbs", "totalfluidpumped_bbl")
    feet = F.col("laterallength_ft")
    return wells.join(best, "wellid", "left").select(
        "wellid", F.upper("operator").alias("operator"), "completionid", H.length_bin(feet).alias("ll_bin"),
        F.round(P.ratio(F.col("proppant_lbs"), feet), 4).alias("lbs_per_ft"), F.round(P.ratio(F.col("totalfluidpumped_bbl"), feet), 4).alias("bbl_per_ft"),
    )


QUERIES = {f.__name__: f for f in (
    prj1_override, prj3_length_bin, prj4_primary_phase, prj7_toe_up, prj8_zone_distance, prj9_text, prj10_try_cast, prj11_fit_method, prj12_api, prj13_select_eur, flt1_status, flt2_candidates,
    flt3_other_candidates, flt4_stale, flt7_two_points, jn1_inner, jn2_left_outer, jn3_nullable_key, jn4_full_outer, jn6_cross, jn12_best_completion, jn13_earliest, jn15_cast_key, jn18_explode_merge,
    jn19_xref, w6_latest, w7_preferred_source, w9_two_keys, w11_surrogates, ag8_first_of_key, ag9_duplicates, ag11_lists, ag12_statistics, header_view,
)}

BIN = "case when {0} < 4500 or {0} is null then 'SHORT' when {0} >= 4500 and {0} <= 5499 then '5K' when {0} >= 5500 and {0} <= 8499 then '7.5K' when {0} >= 8500 and {0} <= 11000 then '10K' else 'LONG' end"
from .production import ORACLES as _PRODUCTION  # noqa: E402

ORACLES = {
    "prj1_override": f"{W} select w.wellid, coalesce(o.basin, w.basin) as basin, coalesce(o.laterallength_ft, w.laterallength_ft) as laterallength_ft from well_header w left join well_override o on w.wellid = o.wellid",
    "prj3_length_bin": f"{W} select wellid, {BIN.format('ft')} as ll_bin from (select wellid, case when wellid % 11 <> 0 then laterallength_ft + (wellid % 2) / 2 end as ft from well_header)",
    "prj4_primary_phase": f"select wellid, case when gor < 3200 then 'OIL' else 'GAS' end as phase from ({_PRODUCTION['f20_fluid_ratios']})",
    "prj7_toe_up": f"{W} select wellid, cast((wellid * 37) % 180 > 90 as int) as toeup from well_header",
    "prj8_zone_distance": f"{W} select wellid, greatest(laterallength_ft - 7000, 7000 - laterallength_ft) as to_base, greatest(laterallength_ft - 5000, 5000 - laterallength_ft) as to_top from well_header",
    "prj9_text": f"{W} select wellid, upper(fitmethod) as method, substring(operator, 1, 4) as short, substring(cast(wellid as varchar), 1, 2) as id_text from well_header",
    "prj10_try_cast": f"{W} select wellid, case when wellid % 3 = 0 then wellid + 0.5::double end as size from well_header",
    "prj11_fit_method": f"{W} select wellid, case when fitmethod like 'MONTE%' then 'monte_carlo' else 'curve_fit' end as method from well_header",
    "prj12_api": f"{W}, t as (select wellid, left(regexp_replace(concat(wellid, '-123-4567', wellid % 10, '-01'), '\\D', '', 'g'), 10) as a from well_header) select wellid, lpad(a, greatest(length(a), if(length(a) = 9, 10, 0))::int, '0') as api from t",
    "prj13_select_eur": f"{W} select wellid, coalesce(sum(value) filter (measure = case wellid % 3 when 0 then 'OIL' when 1 then 'GAS' end), 0) as eur from production group by 1",
    "flt1_status": f"{W} select wellid, wellstatus, basin, fitmethod from well_header where wellstatus not like '%DUC%' and basin not in ('ASIA') and fitmethod is distinct from 'curve_fit'",
    "flt2_candidates": f"{W} select wellid, basin from well_header where trajectory = 'HORIZONTAL' and year(firstproddate) >= 2006 and laterallength_ft > 4000 and basin in ('ASIA', 'EUROPE')",
    "flt3_other_candidates": f"{W} select wellid, basin from well_header where trajectory = 'HORIZONTAL' and year(firstproddate) >= 2006 and laterallength_ft > 4000 and coalesce(basin, '') not in ('ASIA', 'EUROPE')",
    "flt4_stale": f"{W} select wellid from well_header where (select min(datecreated)::date + 30 from production) <= date '2020-01-01'",
    "flt7_two_points": f"{W} select wellid from well_header where wellid % 4 <> 0",
    "jn1_inner": f"{W} select completionid, c.wellid, basin from completion_header c, well_header w where c.wellid = w.wellid",
    "jn2_left_outer": f"{W} select wellid, basin, (select max(o.basin) from well_override o where o.wellid = w.wellid) as own_basin from well_header w",
    "jn3_nullable_key": f"{W} select w.wellid, c.completionid from well_header w left join completion_header c on c.wellid = w.wellid and (w.wellid % 2 <> 0 or c.completionid = w.currentcompletionid)",
    "jn4_full_outer": f"{W} select wellid, sum(value) filter (measure = 'OIL' and wellid % 3 <> 1) as oil, sum(value) filter (measure = 'WATER' and wellid % 3 <> 2) as water from production where (wellid % 3 <> 1 and measure = 'OIL') or (wellid % 3 <> 2 and measure = 'WATER') group by 1",
    "jn6_cross": f"{W} select wellid, datediff('day', min(firstproddate) over (), firstproddate)::int as days from well_header",
    "jn12_best_completion": f"{W} select wellid, arg_max(completionid, completionid) as completionid, 'PRIMARY' as datasource from completion_header where datasource = 'PRIMARY' group by 1",
    "jn13_earliest": f"{W} select wellid, (select min(dt) from production p where p.wellid = w.wellid) as first, (select min(dt) from production p where p.wellid = w.wellid and measure = 'OIL') as first_oil from well_header w",
    "jn15_cast_key": f"{W} select wellid, completionid from completion_header",
    "jn18_explode_merge": f"{W} select a.wellid as own, b.wellid as other, b.operator from well_header a join well_header b on a.y0 = b.y0 and a.wellid <> b.wellid",
    "jn19_xref": f"{W} select wellid, max(completionid) filter (datasource = 'PRIMARY') as first_id, max(completionid) filter (datasource = 'SECONDARY') as second_id from completion_header group by 1",
    "w6_latest": f"{W} select wellid, measure, max(dt) as dt, arg_min(datasource, struct_pack(a := -epoch(dt), b := datasource)) as datasource from production group by 1, 2",
    "w7_preferred_source": f"{W} select wellid, completionid from completion_header where datasource = 'SECONDARY'",
    "w9_two_keys": f"{W} select interval_name, oilgravity_api, arg_min(wellid, completionid) as wellid, min(completionid) as completionid from completion_header where datasource = 'PRIMARY' group by 1, 2",
    "w11_surrogates": f"{W} select completionid, (select max(wellid) from well_header) + row_number() over (order by completionid) as newid from completion_header",
    "ag8_first_of_key": f"{W} select operator, arg_min(wellid, struct_pack(a := firstproddate, b := wellid)) as wellid from well_header group by 1",
    "ag9_duplicates": f"{W} select operator, wellid from well_header where operator in (select operator from well_header group by 1 having count(*) > 1)",
    "ag11_lists": f"{W} select basin, string_agg(wellid, ',' order by wellid) as ids from well_header group by 1",
    "ag12_statistics": f"{W} select basin, round(avg(laterallength_ft), 4) as mean, round(stddev_pop(laterallength_ft), 4) as std, min(laterallength_ft) as least, max(laterallength_ft) as most, median(laterallength_ft) as middle, count(*) as n from well_header group by 1",
    "header_view": f"""{W} select w.wellid, upper(operator) as operator, completionid, {BIN.format('laterallength_ft')} as ll_bin, round(proppant_lbs / laterallength_ft, 4) as lbs_per_ft, round(totalfluidpumped_bbl / laterallength_ft, 4) as bbl_per_ft
      from well_header w left join completion_header c on c.wellid = w.wellid and c.datasource = 'PRIMARY' where wellstatus <> 'DUC'""",
}
