"""Queries over production history."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import production as P
from ..sources import fixtures as X

PREFERRED = f"with {X.SQL}, pref as (select * from (select *, dense_rank() over (partition by wellid, measure, cadence, dt order by case datasource when 'PRIMARY' then 1 when 'SECONDARY' then 2 else 3 end) as sr from production) where sr = 1)"
WIDE = f"""{PREFERRED}, wide as (
  select wellid, dt, cadence, datasource, sum(case when measure = 'OIL' then value end) as oil,
    sum(case when measure = 'GAS' then value end) as gas, sum(case when measure = 'WATER' then value end) as water
  from pref group by all)"""
BOTH = f"{WIDE}, w as (select wellid, dt, sum(oil) as oil, sum(gas) as gas, sum(water) as water from wide group by 1, 2)"
KEYS = ["wellid", "dt", "cadence", "datasource"]


def wide(spark, d):
    return P.pivot_phases(P.preferred(X.production(spark, d)), KEYS)


def months(spark, d):
    """One row per well and month, all sources together."""
    return P.pivot_phases(P.preferred(X.production(spark, d)), ["wellid", "dt"])


def w1_date_rank(spark, d):
    return P.date_rank(X.production(spark, d)).select("wellid", "dt", "measure", "datasource", X.long("daterank"))


def w2_source_rank(spark, d):
    return P.source_rank(X.production(spark, d)).select("wellid", "dt", "measure", "datasource", "value", X.long("sourcerank"))


def w3_row_numbers(spark, d):
    return P.history(wide(spark, d)).select("wellid", "dt", "datasource", X.long("rank_asc"), X.long("rank_desc"))


def w4_cumulative(spark, d):
    return P.history(wide(spark, d)).select("wellid", "dt", "datasource", "cum_oil", "cum_gas", "cum_water")


def w5_coproducing(spark, d):
    return P.coproducing(months(spark, d), "oil", "gas").select("wellid", "dt", "both_asc", "both_desc")


def w10_batches(spark, d):
    return P.batches(X.production(spark, d).select("wellid").distinct(), ["wellid"], 7)


def w21_months_producing(spark, d):
    return P.months_producing(P.preferred(X.production(spark, d))).select("wellid", "measure", "dt", "datasource", X.long("months"))


def w22_rank_variants(spark, d):
    by = Window.partitionBy("wellid", "measure").orderBy("dt")
    return X.production(spark, d).select("wellid", "measure", "dt", "datasource", F.dense_rank().over(by).cast("long").alias("dense"), F.rank().over(by).cast("long").alias("lowest"))


def ag1_monthly_totals(spark, d):
    return X.production(spark, d).groupBy("dt", "measure").agg(F.sum("value").alias("total"), F.min("value").alias("least"), F.max("value").alias("most"))


def ag2_conditional(spark, d):
    case = lambda m: F.when(F.col("measure") == m, F.col("value"))
    return X.production_daily(spark, d).groupBy("wellid", "dt").agg(F.max(case("OIL")).alias("oil"), F.max(case("GAS")).alias("gas"), F.round(F.sum(case("WATER")), 4).alias("water"), F.max(case("TP")).alias("tp"), F.max(case("CP")).alias("cp"))


def ag3_pivot(spark, d):
    return wide(spark, d).select("wellid", "dt", "datasource", "oil", "gas", "water")


def ag5_pivot_mean(spark, d):
    mean = X.production(spark, d).groupBy("wellid").pivot("measure", list(P.PHASES)).agg(F.avg("value"))
    return mean.select("wellid", *(F.round(F.coalesce(F.col(p), F.lit(0.0)), 4).alias(p.lower()) for p in P.PHASES))


def ag6_unpivot(spark, d):
    return P.unpivot_phases(wide(spark, d), ["wellid", "dt", "datasource"])


def ag7_distinct(spark, d):
    return X.production(spark, d).select("wellid", "measure").distinct()


def ag10_counts(spark, d):
    return X.production(spark, d).agg(F.count("*").alias("n"), F.max("wellid").alias("last_well"), F.max("dt").alias("last_date"))


def prj2_safe_ratio(spark, d):
    return P.rates(X.production(spark, d)).select("wellid", "dt", "measure", "datasource", F.round("rate", 4).alias("rate"))


def prj5_phase_code(spark, d):
    code = F.when(F.col("measure") == "OIL", 1).when(F.col("measure") == "GAS", 2).otherwise(3)
    return X.production(spark, d).select("wellid", "dt", "datasource", "measure", code.alias("code"))


def prj6_units(spark, d):
    unit = F.when(F.col("measure") == "GAS", "MCF").when(F.col("measure").isin("OIL", "WATER"), "BBL")
    return X.production_daily(spark, d).select("wellid", "dt", "datasource", "measure", unit.alias("units"))


def f20_fluid_ratios(spark, d):
    return P.producing_ratios(months(spark, d)).select("wellid", *(F.round(c, 4).alias(c) for c in ("gor", "water_cut", "water_yield")))


def so1_sorted(spark, d):
    return X.production(spark, d).select("wellid", "measure", "dt", "datasource", "value").orderBy("wellid", "measure", F.desc("dt"), "datasource")


def so2_top_per_group(spark, d):
    by = Window.partitionBy("measure").orderBy(F.desc("value"), "wellid", "dt", "datasource")
    return X.production(spark, d).withColumn("place", F.row_number().over(by)).where("place <= 5").select("measure", X.long("place"), "wellid", "dt", "value")


def so3_page(spark, d):
    return X.production(spark, d).select("wellid", "measure", "dt", "datasource", "value").orderBy("wellid", "measure", "dt", "datasource").offset(100).limit(50)


def materialised_production(spark, d):
    """Producing month, volume and running total of the preferred source, with the lateral's bin and intensities."""
    by = Window.partitionBy("wellid", "measure").orderBy("dt", "datasource")
    rows = P.preferred(X.production(spark, d)).where("value > 0")
    header = X.well_header(spark, d).select("wellid", "laterallength_ft")
    rows = rows.withColumn("prodmonth", F.row_number().over(by)).withColumn("cumulative", F.sum("value").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.join(header, "wellid").select("wellid", "measure", "dt", "datasource", X.long("prodmonth"), "cumulative", F.round(F.col("cumulative") / F.col("laterallength_ft") * 1000, 4).alias("per_1000_ft"))


QUERIES = {f.__name__: f for f in (
    w1_date_rank, w2_source_rank, w3_row_numbers, w4_cumulative, w5_coproducing, w10_batches, w21_months_producing, w22_rank_variants, ag1_monthly_totals, ag2_conditional, ag3_pivot, ag5_pivot_mean,
    ag6_unpivot, ag7_distinct, ag10_counts, prj2_safe_ratio, prj5_phase_code, prj6_units, f20_fluid_ratios, so1_sorted, so2_top_per_group, so3_page, materialised_production,
)}

ORACLES = {
    "w1_date_rank": f"""with {X.SQL} select p.wellid, p.dt, p.measure, p.datasource, q.daterank from production p join (
        select wellid, measure, cadence, dt, row_number() over (partition by wellid, measure, cadence order by dt) as daterank from (select distinct wellid, measure, cadence, dt from production)) q
        using (wellid, measure, cadence, dt)""",
    "w2_source_rank": f"with {X.SQL} select wellid, dt, measure, datasource, value, dense_rank() over (partition by wellid, measure, cadence, dt order by case datasource when 'PRIMARY' then 1 else 2 end) as sourcerank from production",
    "w3_row_numbers": f"{WIDE} select wellid, dt, datasource, row_number() over (partition by wellid, cadence order by dt, datasource) as rank_asc, row_number() over (partition by wellid, cadence order by dt desc, datasource) as rank_desc from wide",
    "w4_cumulative": f"{WIDE} select a.wellid, a.dt, a.datasource, sum(b.oil) as cum_oil, sum(b.gas) as cum_gas, sum(b.water) as cum_water from wide a join wide b on a.wellid = b.wellid and a.cadence = b.cadence and b.dt <= a.dt group by 1, 2, 3",
    "w5_coproducing": f"{BOTH} select a.wellid, a.dt, count(*) filter (b.dt <= a.dt and b.oil > 0 and b.gas > 0) as both_asc, count(*) filter (b.dt >= a.dt and b.oil > 0 and b.gas > 0) as both_desc from w a join w b using (wellid) group by 1, 2",
    "w10_batches": f"with {X.SQL} select wellid, cast(ceil(row_number() over (order by wellid) / 7) as bigint) as batch from (select distinct wellid from production)",
    "w21_months_producing": f"{PREFERRED}, f as (select wellid, measure, min(dt) as first from pref group by 1, 2) select wellid, measure, dt, datasource, datediff('month', first, dt) as months from pref join f using (wellid, measure)",
    "w22_rank_variants": f"with {X.SQL} select wellid, measure, dt, datasource, dense_rank() over w as dense, rank() over w as lowest from production window w as (partition by wellid, measure order by dt)",
    "ag1_monthly_totals": f"with {X.SQL} select dt, measure, sum(value) as total, min(value) as least, max(value) as most from production group by 1, 2",
    "ag2_conditional": f"with {X.SQL} select wellid, dt, max(value) filter (measure = 'OIL') as oil, max(value) filter (measure = 'GAS') as gas, round(sum(value) filter (measure = 'WATER'), 4) as water, max(value) filter (measure = 'TP') as tp, max(value) filter (measure = 'CP') as cp from production_daily group by 1, 2",
    "ag3_pivot": f"{PREFERRED} select wellid, dt, datasource, OIL as oil, GAS as gas, WATER as water from (pivot (select wellid, dt, cadence, datasource, measure, value from pref) on measure in ('OIL', 'GAS', 'WATER') using sum(value))",
    "ag5_pivot_mean": f"with {X.SQL} select wellid, round(coalesce(avg(value) filter (measure = 'OIL'), 0), 4) as oil, round(coalesce(avg(value) filter (measure = 'GAS'), 0), 4) as gas, round(coalesce(avg(value) filter (measure = 'WATER'), 0), 4) as water from production group by 1",
    "ag6_unpivot": f"{PREFERRED} select wellid, dt, datasource, measure, sum(value) as value from pref group by 1, 2, 3, 4",
    "ag7_distinct": f"with {X.SQL} select wellid, measure from production group by 1, 2",
    "ag10_counts": f"with {X.SQL} select count(*) as n, max(wellid) as last_well, max(dt) as last_date from production",
    "prj2_safe_ratio": f"with {X.SQL} select wellid, dt, measure, datasource, round(value / coalesce(nullif(producingdays, 0), cast(30.42 as double)), 4) as rate from production",
    "prj5_phase_code": f"with {X.SQL} select wellid, dt, datasource, measure, list_position(['OIL', 'GAS', 'WATER'], measure) as code from production",
    "prj6_units": f"with {X.SQL} select wellid, dt, datasource, measure, case when measure = 'GAS' then 'MCF' when measure in ('OIL', 'WATER') then 'BBL' end as units from production_daily",
    "f20_fluid_ratios": f"""{BOTH},
      g as (select *, row_number() over (partition by wellid order by dt) as k from w where oil > 0 and gas > 0),
      gor as (select wellid, sum(gas) / sum(oil) * 1000 as gor from g where k <= 3 group by 1),
      c as (select *, row_number() over (partition by wellid order by dt) as k, row_number() over (partition by wellid order by dt desc) as j from w where oil > 0 and water > 0),
      cut as (select wellid, sum(water) / sum(oil + water) as water_cut from c where k > 3 and j <= 12 group by 1),
      y as (select *, row_number() over (partition by wellid order by dt) as k, row_number() over (partition by wellid order by dt desc) as j from w where gas > 0 and water > 0),
      yield as (select wellid, sum(water) / sum(gas) as water_yield from y where k > 3 and j <= 12 group by 1),
      ids as (select wellid from gor union select wellid from cut union select wellid from yield)
      select wellid, round(gor, 4) as gor, round(water_cut, 4) as water_cut, round(water_yield, 4) as water_yield from ids left join gor using (wellid) left join cut using (wellid) left join yield using (wellid)""",
    "so1_sorted": f"with {X.SQL} select wellid, measure, dt, datasource, value from production order by all",
    "so2_top_per_group": f"with {X.SQL} select measure, row_number() over (partition by measure order by value desc, wellid, dt, datasource) as place, wellid, dt, value from production qualify place <= 5",
    "so3_page": f"with {X.SQL} select wellid, measure, dt, datasource, value from production order by wellid, measure, dt, datasource limit 50 offset 100",
    "materialised_production": f"""{PREFERRED}, p as (select *, row_number() over (partition by wellid, measure order by dt, datasource) as prodmonth, sum(value) over (partition by wellid, measure order by dt, datasource rows unbounded preceding) as cumulative from pref where value > 0)
      select p.wellid, measure, dt, p.datasource, prodmonth, cumulative, round(cumulative / laterallength_ft * 1000, 4) as per_1000_ft from p join well_header h on p.wellid = h.wellid""",
}
