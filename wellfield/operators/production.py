"""Production history: ranks, preferred sources, pivots, running totals and producing ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpointed

PHASES = ("OIL", "GAS", "WATER")
SOURCES = ("PRIMARY", "SECONDARY")
#: Days of a month where the producing days are not known.
MONTH_DAYS = 30.42


def priority(column: str, order: tuple[str, ...]) -> Column:
    """1 for the first of `order`, 2 for the next, and one more than the last for anything else."""
    out = F.when(F.col(column) == order[0], 1)
    for k, value in enumerate(order[1:], 2):
        out = out.when(F.col(column) == value, k)
    return out.otherwise(len(order) + 1)


def date_rank(production: DataFrame) -> DataFrame:
    """Dense rank of the date within well, measure and cadence, for the phases only."""
    by = Window.partitionBy("wellid", "measure", "cadence").orderBy("dt")
    return production.where(F.col("measure").isin(*PHASES)).withColumn("daterank", F.dense_rank().over(by))


def source_rank(production: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """Rank of the data source at each date; rows of one source tie."""
    by = Window.partitionBy("wellid", "measure", "cadence", "dt").orderBy(priority("datasource", sources))
    return production.withColumn("sourcerank", F.dense_rank().over(by))


def preferred(production: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    return source_rank(production, sources).where("sourcerank = 1").drop("sourcerank")


def pivot_phases(production: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with a column per phase; a phase that is missing is null."""
    wide = production.groupBy(*keys).pivot("measure", list(PHASES)).agg(F.sum("value"))
    return wide.select(*keys, *(F.col(p).alias(p.lower()) for p in PHASES))


def unpivot_phases(wide: DataFrame, keys: list[str]) -> DataFrame:
    """Long form again, without nulls."""
    names = ", ".join(f"'{p}', {p.lower()}" for p in PHASES)
    return wide.select(*keys, F.expr(f"stack({len(PHASES)}, {names}) as (measure, value)")).where("value is not null")


def by_date(*keys: str) -> Window:
    return Window.partitionBy(*keys).orderBy("dt")


def history(wide: DataFrame) -> DataFrame:
    """Forward and backward row numbers of the months, and cumulative volumes (rows of one date share a total)."""
    number = Window.partitionBy("wellid", "cadence")
    tie = [F.col("datasource")]
    return wide.select(
        "*", F.row_number().over(number.orderBy("dt", *tie)).alias("rank_asc"), F.row_number().over(number.orderBy(F.desc("dt"), *tie)).alias("rank_desc"),
        *(F.sum(p).over(number.orderBy("dt")).alias(f"cum_{p}") for p in ("oil", "gas", "water")),
    )


def coproducing(wide: DataFrame, a: str, b: str) -> DataFrame:
    """Running count of the months in which both phases flow, forwards and backwards."""
    both = F.when((F.col(a) > 0) & (F.col(b) > 0), 1).otherwise(0)
    by = Window.partitionBy("wellid")
    return wide.withColumn("both_asc", F.sum(both).over(by.orderBy("dt"))).withColumn("both_desc", F.sum(both).over(by.orderBy(F.desc("dt"))))


def ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0.0))


def producing_ratios(wide: DataFrame, late: int = 12) -> DataFrame:
    """Gas-oil ratio over the first three months in which oil and gas flow; water cut and yield over the last `late`
    months in which both of the pair flow, the first three left out. One row per well with either."""
    first = coproducing(wide, "oil", "gas").where("oil > 0 and gas > 0 and both_asc between 1 and 3")
    gor = first.groupBy("wellid").agg((ratio(F.sum("gas"), F.sum("oil")) * 1000).alias("gor"))

    def last(phase: str) -> DataFrame:
        rows = coproducing(wide, phase, "water").where(f"{phase} > 0 and water > 0 and both_asc > 3 and both_desc <= {late}")
        return rows.groupBy("wellid").agg(F.sum(phase).alias("v"), F.sum("water").alias("w"))

    cut = last("oil").select("wellid", ratio(F.col("w"), F.col("v") + F.col("w")).alias("water_cut"))
    water = last("gas").select("wellid", ratio(F.col("w"), F.col("v")).alias("water_yield"))
    return gor.join(cut, "wellid", "full").join(water, "wellid", "full")


def numbered_after(rows: DataFrame, order: list[str], start: int) -> DataFrame:
    """rows with newid, numbers that follow `start` in a stable order: ranks within ranges of the order, shifted by the
    counts of the ranges before. The ranges are checkpointed, since both uses must see the same ones."""
    part = "__part"
    dealt = checkpointed(rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    sizes = dealt.groupBy(part).agg(F.count("*").alias("n"))
    shift = sizes.select(part, (F.coalesce(F.sum("n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + start).alias("shift"))
    own = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return dealt.withColumn("own", own).join(F.broadcast(shift), part).withColumn("newid", F.col("own") + F.col("shift")).drop(part, "own", "shift")


def batches(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """A batch number for each row in a stable order."""
    return numbered_after(rows, order, 0).select(*order, F.ceil(F.col("newid") / size).alias("batch"))


def rates(production: DataFrame) -> DataFrame:
    """Volume per producing day; a month without known days counts 30.42, a day counts one."""
    days = F.when(F.col("cadence") == "DAILY", F.lit(1.0)).otherwise(F.coalesce(F.nullif(F.col("producingdays"), F.lit(0)).cast("double"), F.lit(MONTH_DAYS)))
    return production.withColumn("rate", F.col("value") / days)


def month_diff(start: Column, end: Column) -> Column:
    """Calendar months from start to end; days do not count."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def months_producing(production: DataFrame) -> DataFrame:
    first = F.min("dt").over(Window.partitionBy("wellid", "measure"))
    return production.withColumn("months", month_diff(first, F.col("dt")))
