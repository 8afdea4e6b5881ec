"""Well and completion headers: overrides, bins, status filters, best completion, cross references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .production import SOURCES, priority

#: Methods that a fit may name.
FIT_METHODS = ("curve_fit", "differential_evolution", "monte_carlo")


def override(source: DataFrame, overrides: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of the override where it has a value, else those of the source."""
    shared = [c for c in overrides.columns if c in source.columns and c not in keys]
    renamed = overrides.select(*keys, *(F.col(c).alias(f"own_{c}") for c in shared))
    joined = source.join(renamed, keys, "left")
    return joined.select(*(F.coalesce(f"own_{c}", c).alias(c) if c in shared else F.col(c) for c in source.columns))


def length_bin(feet: Column) -> Column:
    """Bins of lateral length. A length between two bins' whole feet falls to LONG, a missing one to SHORT."""
    return (
        F.when(feet.isNull() | (feet < 4500), "SHORT").when(feet.between(4500, 5499), "5K").when(feet.between(5500, 8499), "7.5K").when(feet.between(8500, 11000), "10K").otherwise("LONG")
    )


def primary_phase(gor: Column) -> Column:
    """OIL below 3200; a missing ratio counts as GAS."""
    return F.when(gor < 3200, "OIL").otherwise("GAS")


def toe_up(angle: Column) -> Column:
    return F.when(angle > 90, 1).otherwise(0)


def fit_method(method: Column, default: str = "curve_fit") -> Column:
    clean = F.lower(F.trim(method))
    return F.when(clean.isin(*FIT_METHODS), clean).otherwise(default)


def clean_api(text: Column) -> Column:
    """Ten digits of a well's API number: other characters go, a lost leading zero of nine digits comes back."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    ten = F.substring(digits, 1, 10)
    return F.nullif(F.when(F.length(ten) == 9, F.concat(F.lit("0"), ten)).otherwise(ten), F.lit(""))


def spacing_candidates(wells: DataFrame, *, since: int, least_feet: float, basins: list[str], inside: bool = True) -> DataFrame:
    """Horizontal wells that can be spaced: in the named basins, or in none of them."""
    named = F.col("basin").isin(*basins)
    group = named if inside else ~named | F.col("basin").isNull()
    first = F.col("firstproddate") >= F.lit(f"{since}-01-01").cast("date")
    return wells.where((F.col("trajectory") == "HORIZONTAL") & first & (F.col("laterallength_ft") > least_feet) & F.col("x0").isNotNull() & group)


def stale(rows: DataFrame, updates: DataFrame, column: str, days: int, as_of: str) -> DataFrame:
    """All rows if nothing was ever updated or the oldest update is `days` old at `as_of`; otherwise none."""
    oldest = updates.agg(F.min(column).alias("oldest"))
    return rows.crossJoin(F.broadcast(oldest)).where(F.col("oldest").isNull() | (F.date_add("oldest", days) <= F.lit(as_of).cast("date"))).drop("oldest")


def best_completion(completions: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """One completion per well: the preferred source's, then the latest by number."""
    by = Window.partitionBy("wellid").orderBy(priority("datasource", sources), F.desc("completionid"))
    return completions.withColumn("place", F.row_number().over(by)).where("place = 1").drop("place")


def latest(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(by)).where("place = 1").drop("place")


def duplicated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of keys that occur more than once."""
    return rows.withColumn("n", F.count("*").over(Window.partitionBy(*keys))).where("n > 1")
