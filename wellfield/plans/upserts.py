"""Upserts, deletes and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import production as P
from ..operators import upsert as U
from ..sources import fixtures as X

W = f"with {X.SQL}"
FORECAST = ["wellid", "measure", "analyst"]
NATURAL = ["wellid", "dt", "measure", "datasource"]


def _stage(forecast):
    """New forecasts: every second well again with another rate and no b factor, and some wells that are new."""
    old = forecast.where(X.well() % 2 == 0).withColumn("q3", F.col("q3") * 2).withColumn("b_factor", F.lit(None).cast("double"))
    return old.unionByName(forecast.where(X.well() % 3 == 0).withColumn("wellid", X.well() + 100000))


def _production(spark, d, even):
    """Production split by month: what is there, and what arrives with twice the value and a later date where odd."""
    return X.production(spark, d).where(F.month("dt") % 2 == (0 if even else 1)).select(*NATURAL, "value", "datecreated")


def up1_merge_forecast(spark, d):
    forecast = X.forecast(spark, d)
    return U.merge(forecast, _stage(forecast), FORECAST, coalesce_old=["b_factor"]).select(*FORECAST, F.round("q3", 4).alias("q3"), "b_factor")


def up2_merge_keep(spark, d):
    target = X.well_header(spark, d).select("wellid", "basin", "fitmethod").where(X.well() % 5 != 0)
    source = X.well_header(spark, d).select("wellid", F.lit("NEW").alias("basin"), F.lit("x").alias("fitmethod")).where((X.well() % 2 == 0) | (X.well() % 5 == 0))
    return U.merge(target, source, ["wellid"])


def up3_merge_newer(spark, d):
    target = X.production(spark, d).select(*NATURAL, "value", "datecreated")
    moved = F.col("datecreated") + F.when(X.well() % 2 == 0, F.expr("interval 1 day")).otherwise(F.expr("interval -1 day"))
    source = target.where(X.well() % 3 == 0).withColumn("value", F.col("value") + 1).withColumn("datecreated", moved)
    return U.merge(target, source, NATURAL, only_newer="datecreated").select(*NATURAL, "value")


def up4_replace(spark, d):
    target = X.completion_header(spark, d).select("wellid", "completionid", "proppant_lbs")
    source = target.where((X.well() % 4 == 0) & (F.col("completionid") % 10 == 1)).withColumn("proppant_lbs", F.lit(1.0))
    return U.replace_keys(target, source, ["wellid"])


def up5_incremental(spark, d):
    """Months of the last 30 days before the newest, or not yet loaded, aggregated, unpivoted and merged if newer."""
    feed = X.production(spark, d)
    last = feed.agg(F.max("datecreated").alias("last"))
    loaded = feed.where(X.well() % 2 == 0).select("wellid", "dt", "measure", "value", "datecreated").groupBy("wellid", "dt", "measure").agg(F.sum("value").alias("value"), F.max("datecreated").alias("datecreated"))
    touched = feed.crossJoin(F.broadcast(last)).where((F.col("datecreated") >= F.col("last") - F.expr("interval 30 days")) | (X.well() % 2 == 1))
    recent = feed.join(touched.select("wellid", "dt").distinct(), ["wellid", "dt"], "left_semi")
    wide = P.pivot_phases(recent.groupBy("wellid", "dt", "measure").agg(F.sum("value").alias("value")), ["wellid", "dt"])
    new = P.unpivot_phases(wide, ["wellid", "dt"]).join(recent.groupBy("wellid", "dt").agg(F.max("datecreated").alias("datecreated")), ["wellid", "dt"])
    return U.merge(loaded, new, ["wellid", "dt", "measure"], only_newer="datecreated").select("wellid", "dt", "measure", "value")


def up6_merge_three_keys(spark, d):
    keys = ["completionid", "wellid", "datasource"]
    target = X.completion_header(spark, d).select(*keys, "interval_name", "proppant_lbs")
    source = target.where(X.well() % 3 == 0).withColumn("datasource", F.when(F.col("completionid") % 2 == 0, "THIRD").otherwise(F.col("datasource"))).withColumn("proppant_lbs", F.lit(5.0))
    return U.merge(target, source, keys)


def up7_insert_only_columns(spark, d):
    target = X.well_header(spark, d).select("wellid", "basin", "fitmethod").where(X.well() % 5 != 0)
    source = X.well_header(spark, d).select("wellid", F.lit("NEW").alias("basin"), F.lit("x").alias("fitmethod")).where((X.well() % 2 == 0) | (X.well() % 5 == 0))
    return U.merge(target, source, ["wellid"], keep_old=["fitmethod"])


def up8_merge_property(spark, d):
    target = X.well_header(spark, d).where(X.well() % 3 == 0).select(X.well().cast("string").alias("propnum"), "operator", F.lit("2PUD").alias("rsv_cat"))
    source = X.well_header(spark, d).where((X.well() % 2 == 0) | (X.well() % 3 != 0)).select(X.well().cast("string").alias("propnum"), F.upper("basin").alias("operator"), F.lit("1PDP").alias("rsv_cat"))
    return U.merge(target, source, ["propnum"], keep_old=["rsv_cat"])


def _product(spark, d, keys):
    rows = X.production(spark, d).groupBy("wellid", "dt", "datasource").agg(*(F.sum(F.when(F.col("measure") == p, F.col("value"))).alias(p.lower()) for p in P.PHASES))
    if "datasource" not in keys:
        rows = rows.where("datasource = 'PRIMARY'")
    target = rows.where(F.month("dt") < 7)
    return U.merge(target, rows.where(F.month("dt") > 4).withColumn("oil", F.col("oil") + 1), keys).select("wellid", "dt", "datasource", "oil", "gas", "water")


def up9_merge_monthly(spark, d):
    return _product(spark, d, ["wellid", "dt"])


def up10_merge_by_source(spark, d):
    return _product(spark, d, ["wellid", "dt", "datasource"])


def up11_backfill(spark, d):
    wells = X.well_header(spark, d).select("wellid", F.when(X.well() % 3 != 0, F.col("x0")).alias("x0"))
    return U.update_from(wells, X.well_header(spark, d).select("wellid", (F.col("x0") + 1).alias("x0")), ["wellid"], only_null=True)


def up12_update_from(spark, d):
    return U.update_from(X.well_header(spark, d).select("wellid", "basin", "laterallength_ft"), X.well_override(spark, d).select("wellid", "basin", "laterallength_ft"), ["wellid"])


def up15_orphans(spark, d):
    return U.delete_orphans(X.completion_header(spark, d), X.well_header(spark, d).where(X.well() % 3 != 0), ["wellid"]).select("completionid", "wellid")


def jn7_anti(spark, d):
    return X.completion_header(spark, d).join(X.well_override(spark, d), ["wellid", "datasource"], "left_anti").select("completionid", "wellid")


def jn8_insert_missing(spark, d):
    both = X.production(spark, d).select(*NATURAL, "value")
    return U.insert_missing(both.where(F.month("dt") < 9), both.withColumn("value", F.col("value") * -1), NATURAL)


def jn9_semi(spark, d):
    return X.well_header(spark, d).join(X.production(spark, d).where("value > 150"), "wellid", "left_semi").select("wellid")


def so4_delete_all(spark, d):
    """What a loop of bounded deletes leaves, as one anti join."""
    return X.production(spark, d).join(X.well_header(spark, d).where("wellstatus = 'DUC'"), "wellid", "left_anti").select(*NATURAL)


def se1_union_all(spark, d):
    named = lambda df, n: df.select("wellid", F.lit(n).alias("list"))
    return named(X.well_header(spark, d), "header").unionByName(named(X.well_override(spark, d), "override"))


def se2_values(spark, d):
    lines = spark.createDataFrame([(4, "OIL"), (5, "GAS"), (7, "OP/MIN")], "section int, keyword string")
    return X.well_override(spark, d).select("wellid").crossJoin(F.broadcast(lines))


def se3_concat(spark, d):
    rows = X.production(spark, d).groupBy("measure").agg(F.sum("value").alias("v"))
    return rows.unionByName(X.production(spark, d).agg(F.lit("ALL").alias("measure"), F.sum("value").alias("v")))


def src10_checkpoint(spark, d):
    """Groups of work that no finished fingerprint names."""
    groups = U.fingerprint(X.forecast(spark, d).withColumn("chunk", X.well() % 13), ["chunk"], ["wellid", "measure"])
    done = groups.where("chunk % 2 = 0").select("fingerprint")
    return groups.join(done, "fingerprint", "left_anti").select("chunk")


def b16_fingerprint(spark, d):
    return U.fingerprint(X.forecast(spark, d), ["wellid"], ["wellid", "measure"])


QUERIES = {f.__name__: f for f in (
    up1_merge_forecast, up2_merge_keep, up3_merge_newer, up4_replace, up5_incremental, up6_merge_three_keys, up7_insert_only_columns, up8_merge_property, up9_merge_monthly, up10_merge_by_source, up11_backfill,
    up12_update_from, up15_orphans, jn7_anti, jn8_insert_missing, jn9_semi, so4_delete_all, se1_union_all, se2_values, se3_concat, src10_checkpoint, b16_fingerprint,
)}

_PRODUCT = f"{W}, r as (select wellid, dt, datasource, sum(value) filter (measure = 'OIL') as oil, sum(value) filter (measure = 'GAS') as gas, sum(value) filter (measure = 'WATER') as water from production group by 1, 2, 3)"
_MERGED = "select wellid, dt, datasource, case when month(dt) > 4 then oil + 1 else oil end as oil, gas, water from r"
ORACLES = {
    "up1_merge_forecast": f"{W} select wellid, measure, analyst, round(case when wellid % 2 = 0 then q3 * 2 else q3 end, 4) as q3, b_factor from forecast union all select wellid + 100000, measure, analyst, round(q3, 4), b_factor from forecast where wellid % 3 = 0",
    "up2_merge_keep": f"{W} select wellid, case when wellid % 2 = 0 or wellid % 5 = 0 then 'NEW' else basin end as basin, case when wellid % 2 = 0 or wellid % 5 = 0 then 'x' else fitmethod end as fitmethod from well_header",
    "up3_merge_newer": f"{W} select wellid, dt, measure, datasource, case when wellid % 6 = 0 then value + 1 else value end as value from production",
    "up4_replace": f"{W} select wellid, completionid, case when wellid % 4 = 0 then 1.0 else proppant_lbs end::double as proppant_lbs from completion_header where wellid % 4 <> 0 or completionid % 10 = 1",
    "up5_incremental": f"{W} select wellid, dt, measure, sum(value) as value from production group by 1, 2, 3",
    "up6_merge_three_keys": f"""{W} select completionid, wellid, datasource, interval_name, case when wellid % 3 = 0 and completionid % 2 = 1 then 5.0 else proppant_lbs end::double as proppant_lbs from completion_header
      union all select completionid, wellid, 'THIRD', interval_name, 5.0 from completion_header where wellid % 3 = 0 and completionid % 2 = 0""",
    "up7_insert_only_columns": f"{W} select wellid, case when wellid % 2 = 0 or wellid % 5 = 0 then 'NEW' else basin end as basin, case when wellid % 5 = 0 then 'x' else fitmethod end as fitmethod from well_header",
    "up8_merge_property": f"{W} select wellid::varchar as propnum, case when wellid % 2 = 0 or wellid % 3 <> 0 then basin else operator end as operator, case when wellid % 3 = 0 then '2PUD' else '1PDP' end as rsv_cat from well_header",
    "up9_merge_monthly": f"{_PRODUCT} {_MERGED} where datasource = 'PRIMARY'",
    "up10_merge_by_source": f"{_PRODUCT} {_MERGED}",
    "up11_backfill": f"{W} select wellid, case when wellid % 3 <> 0 then x0 else x0 + 1 end as x0 from well_header",
    "up12_update_from": f"{W} select wellid, case when wellid % 10 = 3 then 'OVERRIDE' else basin end as basin, case when wellid % 10 = 3 then 10000 else laterallength_ft end as laterallength_ft from well_header",
    "up15_orphans": f"{W} select completionid, wellid from completion_header c where exists (select 1 from well_header w where w.wellid = c.wellid and w.wellid % 3 <> 0)",
    "jn7_anti": f"{W} select completionid, wellid from completion_header c where not exists (select 1 from well_override o where o.wellid = c.wellid and o.datasource = c.datasource)",
    "jn8_insert_missing": f"{W} select wellid, dt, measure, datasource, case when month(dt) < 9 then value else -value end as value from production",
    "jn9_semi": f"{W} select wellid from well_header where wellid in (select wellid from production where value > 150)",
    "so4_delete_all": f"{W} select wellid, dt, measure, datasource from production where wellid not in (select wellid from well_header where wellstatus = 'DUC')",
    "se1_union_all": f"{W} select wellid, 'header' as list from well_header union all select wellid, 'override' from well_override",
    "se2_values": f"{W} select wellid, section, keyword from well_override, (values (4, 'OIL'), (5, 'GAS'), (7, 'OP/MIN')) v(section, keyword)",
    "se3_concat": f"{W} select coalesce(measure, 'ALL') as measure, sum(value) as v from production group by grouping sets ((measure), ())",
    "src10_checkpoint": f"{W} select distinct wellid % 13 as chunk from forecast where (wellid % 13) % 2 <> 0",
    "b16_fingerprint": f"{W} select wellid, left(sha1(string_agg(distinct wellid || ':' || measure, ',' order by wellid || ':' || measure)), 16) as fingerprint from forecast group by 1",
}
