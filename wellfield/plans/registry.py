"""All registered queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import economics as E
from ..operators import forecast as Q
from ..session import ship
from ..sources import fixtures as X
from . import economics, fits, fluids, forecasts, header, production, spatial, streams, upserts

FAMILIES = (production, header, upserts, forecasts, economics, fluids, spatial, fits, streams)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, once Python workers can import this package."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production history to forecasts, monthly volumes, cash flow and present value per well."""
    view = Q.view(X.forecast(spark, sf_dir), forecasts.ranked(spark, sf_dir)).withColumn("q1", F.lit(0.0)).withColumn("q2", F.lit(0.0))
    rows = Q.volumes(view).where("volume is not null").select(F.col("wellid").alias("uid"), F.col("month").cast("int").alias("m"), "measure", "volume")
    wide = rows.groupBy("uid", "m").pivot("measure", ["OIL", "GAS", "WATER"]).agg(F.sum("volume"))
    months = wide.select("uid", (F.col("m") - 1).alias("month"), *(F.coalesce(p, F.lit(0.0)).alias(p.lower()) for p in ("OIL", "GAS", "WATER")))
    flows = E.economic(E.cash_flow(months, economics.inputs(spark, sf_dir)))
    return flows.groupBy("uid").agg(F.round(E.present_value(F.lit(0.1)), 4).alias("npv"), F.round(F.sum("oil"), 4).alias("oil"), F.round(F.sum("gas"), 4).alias("gas"), F.max("aban_month").alias("last_month"))


def _flagship_sql() -> str:
    """The forecast volumes of d8 as months, through the cash flow to the economic limit; months may start after 0."""
    volumes = f"""{forecasts.W}, d8 as materialized ({forecasts.MONTHS} select wellid, measure, (t + sm)::bigint as m, greatest(volume, 0) as volume from w where t > 0 and q >= qabn),
      v as (select wellid as uid, (m - 1)::int as month, coalesce(sum(volume) filter (measure = 'OIL'), 0) as oil, coalesce(sum(volume) filter (measure = 'GAS'), 0) as gas, coalesce(sum(volume) filter (measure = 'WATER'), 0) as water from d8 group by 1, 2),"""
    rest = "\n  i as " + economics.ECON.split("\n  i as ", 1)[1]
    rest = rest.replace("c as (select *,", "c as materialized (select *, row_number() over (partition by uid order by month) - 1 as place,").replace("arg_min(month, struct_pack(a := -cum_bas, b := month))", "arg_min(place, struct_pack(a := -cum_bas, b := place))")
    shown = lambda x: f"sum(case when month <= am then {x} else 0 end"
    return f"""{volumes}{rest} select uid, round({shown('net')} / power(1.1, (month + 0.5) / 12)), 4) as npv, round({shown('oil')}), 4) as oil, round({shown('gas')}), 4) as gas, max(am) as last_month from e2 group by 1"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: query for family in FAMILIES for name, query in family.QUERIES.items()}
    return {name: shipped(query) for name, query in (found | {"flagship": flagship}).items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in FAMILIES for name, sql in family.ORACLES.items()} | {"flagship": _flagship_sql()}
