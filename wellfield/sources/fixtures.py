"""Adapters: well data in the shapes that the operators take, derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The same adapters as SQL, for the oracle.
SQL = """
production as (
  select l_suppkey as wellid, last_day(cast(l_shipdate as date)) as dt,
    case l_returnflag when 'A' then 'OIL' when 'N' then 'GAS' else 'WATER' end as measure,
    case l_linestatus when 'O' then 'PRIMARY' else 'SECONDARY' end as datasource,
    'MONTHLY' as cadence, sum(l_quantity) as value,
    count(distinct cast(l_shipdate as date)) as producingdays, max(l_shipdate) as datecreated
  from lineitem group by 1,2,3,4),
production_daily as (
  select user_id as wellid, cast(ts as date) as dt,
    case event_type when 'view' then 'OIL' when 'click' then 'GAS' when 'purchase' then 'WATER'
                    when 'signup' then 'TP' else 'CP' end as measure,
    case when user_id % 2 = 0 then 'PRIMARY' else 'SECONDARY' end as datasource,
    'DAILY' as cadence, round(sum(value),4) as value
  from events group by 1,2,3,4),
well_header as (
  select s.s_suppkey as wellid, s.s_suppkey*10+1 as currentcompletionid, r.r_name as basin, n.n_name as operator,
    case when s.s_suppkey % 5 = 0 then 'VERTICAL' else 'HORIZONTAL' end as trajectory,
    case s.s_suppkey % 4 when 0 then 'INACTIVE PRODUCER' when 1 then 'DUC' else 'PRODUCING' end as wellstatus,
    cast(3500 + (s.s_suppkey*37) % 8000 as double) as laterallength_ft,
    date '2005-01-01' + cast((s.s_suppkey*53) % 3650 as int) as firstproddate,
    cast(1500000 + (s.s_suppkey % 10)*300 as double) as x0,
    cast(6000000 + floor(s.s_suppkey/cast(10 as double))*2500 as double) as y0,
    case when s.s_suppkey % 7 = 0 then cast(null as varchar(20)) when s.s_suppkey % 7 = 1 then 'MONTE_CARLO '
         else 'curve_fit' end as fitmethod
  from supplier s join nation n on s.s_nationkey=n.n_nationkey join region r on n.n_regionkey=r.r_regionkey),
completion_header as (
  select w.wellid*10+k.k as completionid, w.wellid, concat('zone', cast(w.wellid % 3 as varchar(5))) as interval_name,
    case k.k when 1 then 'PRIMARY' else 'SECONDARY' end as datasource,
    p.p_retailprice*10000 as proppant_lbs, cast(p.p_size*1000 as double) as totalfluidpumped_bbl,
    cast(30 + w.wellid % 20 as double) as oilgravity_api, cast(60 + w.wellid % 30 as double)/100 as gasgravity_sg
  from well_header w join part p on p.p_partkey=w.wellid cross join (select 1 as k union all select 2) k),
well_override as (
  select wellid, 'PRIMARY' as datasource, 'OVERRIDE' as basin, cast(10000 as double) as laterallength_ft
  from well_header where wellid % 10 = 3),
forecast as (
  select p.wellid, p.measure, a.analyst, min(p.dt) as startdate, max(p.value)/cast(30.42 as double) as q3, cast(1 as double) as qabn,
    cast(30 + (p.wellid % 7)*7 as double)/100 as dei, cast(8 as double)/100 as def,
    case when p.wellid % 5 = 0 then cast(1 as double) else cast(7 + p.wellid % 5 as double)/10 end as b_factor, 0 as t1, 0 as t2
  from production p cross join (select 'auto_fit_1' as analyst union all select 'manual' union all select 'auto_fit_3') a
  where (a.analyst <> 'manual' or p.wellid % 4 = 0) group by p.wellid, p.measure, a.analyst)
"""


def well():
    return F.col("wellid")


def long(name: str):
    return F.col(name).cast("long").alias(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(column: str, values: dict[str, str], other: str):
    out = None
    for key, value in values.items():
        out = F.when(F.col(column) == key, value) if out is None else out.when(F.col(column) == key, value)
    return out.otherwise(other)


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly volumes in long form; two sources overlap."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("wellid"), F.last_day(F.col("l_shipdate").cast("date")).alias("dt"), _case("l_returnflag", {"A": "OIL", "N": "GAS"}, "WATER").alias("measure"),
        _case("l_linestatus", {"O": "PRIMARY"}, "SECONDARY").alias("datasource"), "l_quantity", "l_shipdate",
    )
    grouped = lines.groupBy("wellid", "dt", "measure", "datasource")
    # A group's dates lie in one month, so its days are bits of a number: one aggregate, where distinct dates take two shuffles.
    days = F.bit_count(F.bit_or(F.expr("shiftleft(1L, day(cast(l_shipdate as date)))")))
    sums = grouped.agg(F.sum("l_quantity").alias("value"), F.coalesce(days, F.lit(0)).cast("long").alias("producingdays"), F.max("l_shipdate").alias("datecreated"))
    return sums.withColumn("cadence", F.lit("MONTHLY"))


def production_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("wellid"), F.col("ts").cast("date").alias("dt"), _case("event_type", {"view": "OIL", "click": "GAS", "purchase": "WATER", "signup": "TP"}, "CP").alias("measure"),
        F.when(F.col("user_id") % 2 == 0, "PRIMARY").otherwise("SECONDARY").alias("datasource"), "value",
    )
    return events.groupBy("wellid", "dt", "measure", "datasource").agg(F.round(F.sum("value"), 4).alias("value")).withColumn("cadence", F.lit("DAILY"))


def well_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    wells = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return wells.select(
        k.alias("wellid"), (k * 10 + 1).alias("currentcompletionid"), F.col("r_name").alias("basin"), F.col("n_name").alias("operator"),
        F.when(k % 5 == 0, "VERTICAL").otherwise("HORIZONTAL").alias("trajectory"),
        F.when(k % 4 == 0, "INACTIVE PRODUCER").when(k % 4 == 1, "DUC").otherwise("PRODUCING").alias("wellstatus"),
        (3500 + (k * 37) % 8000).cast("double").alias("laterallength_ft"), F.date_add(F.lit("2005-01-01").cast("date"), ((k * 53) % 3650).cast("int")).alias("firstproddate"),
        (1500000 + (k % 10) * 300).cast("double").alias("x0"), (6000000 + F.floor(k / 10) * 2500).cast("double").alias("y0"),
        F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, "MONTE_CARLO ").otherwise("curve_fit").alias("fitmethod"),
    )


def completion_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("wellid")
    both = well_header(spark, sf_dir).join(table(spark, sf_dir, "part"), F.col("p_partkey") == w).withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    return both.select(
        (w * 10 + F.col("k")).alias("completionid"), "wellid", F.concat(F.lit("zone"), (w % 3).cast("string")).alias("interval_name"), F.when(F.col("k") == 1, "PRIMARY").otherwise("SECONDARY").alias("datasource"),
        (F.col("p_retailprice") * 10000).alias("proppant_lbs"), (F.col("p_size") * 1000).cast("double").alias("totalfluidpumped_bbl"),
        (30 + w % 20).cast("double").alias("oilgravity_api"), ((60 + w % 30).cast("double") / 100).alias("gasgravity_sg"),
    )


def well_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return well_header(spark, sf_dir).where("wellid % 10 = 3").select("wellid", F.lit("PRIMARY").alias("datasource"), F.lit("OVERRIDE").alias("basin"), F.lit(10000.0).alias("laterallength_ft"))


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = F.col("wellid")
    per = production(spark, sf_dir).groupBy("wellid", "measure").agg(F.min("dt").alias("startdate"), (F.max("value") / 30.42).alias("q3"))
    named = per.withColumn("analyst", F.explode(F.array(*map(F.lit, ("auto_fit_1", "manual", "auto_fit_3"))))).where((F.col("analyst") != "manual") | (w % 4 == 0))
    return named.select(
        "wellid", "measure", "analyst", "startdate", "q3", F.lit(1.0).alias("qabn"), ((30 + (w % 7) * 7).cast("double") / 100).alias("dei"), F.lit(0.08).alias("def"),
        F.when(w % 5 == 0, 1.0).otherwise((7 + w % 5).cast("double") / 10).alias("b_factor"), F.lit(0).alias("t1"), F.lit(0).alias("t2"),
    )
