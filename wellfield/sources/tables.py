"""Readers and writers: grids, relational tables, typed appends, reloads and settings."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Spark types by the kind of value that a column's type name shows.
KINDS = {"float": T.DoubleType(), "double": T.DoubleType(), "int": T.IntegerType(), "long": T.LongType(), "date": T.DateType(), "time": T.TimestampNTZType(), "bool": T.BooleanType(), "binary": T.BinaryType(), "object": T.StringType(), "str": T.StringType()}
#: Values that a column may take.
ALLOWED = {"measure": ("OIL", "GAS", "WATER", "NGL", "TP", "CP", "CHOKE"), "cadence": ("DAILY", "MONTHLY"), "fitmethod": ("curve_fit", "differential_evolution", "monte_carlo")}


def read_grid(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return spark.read.csv(path, sep=sep, schema="x double, y double, z double", mode="FAILFAST")


def read_relational(spark: SparkSession, url: str, query: str, *, column: str | None = None, bounds: tuple | None = None, partitions: int = 1, **options: str) -> DataFrame:
    """A query of a database, read in ranges of `column` where bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, **options)
    if column is None:
        return reader.option("query", query).load()
    low, high = bounds
    return reader.options(dbtable=f"({query}) q", partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=partitions).load()


def read_query(spark: SparkSession, text: str, **params) -> DataFrame:
    """A SQL text with :named parameters, never pasted into it."""
    return spark.sql(text, args=params)


def schema_of(kinds: dict[str, str], overrides: dict[str, T.DataType] | None = None) -> T.StructType:
    """A schema from type names; ValueError for a name that shows no kind."""
    fields = []
    for name, kind in kinds.items():
        found = (overrides or {}).get(name) or next((t for k, t in KINDS.items() if k in kind.lower()), None)
        if found is None:
            raise ValueError(f"{name}: no type for {kind}")
        fields.append(T.StructField(name, found))
    return T.StructType(fields)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that both have, in the schema's order and types; NaN becomes null."""
    def cast(f: T.StructField):
        c = F.col(f.name)
        c = F.nanvl(c, F.lit(None).cast("double")) if df.schema[f.name].dataType in (T.DoubleType(), T.FloatType()) else c
        return c.cast(f.dataType).alias(f.name)

    return df.select(*(cast(f) for f in schema if f.name in df.columns))


def checked(df: DataFrame) -> DataFrame:
    """df, whose columns with a fixed set of values hold nothing else; a bad value ends the job with an error."""
    out = df
    for name, values in ALLOWED.items():
        if name in df.columns:
            good = F.col(name).isNull() | F.col(name).isin(*values)
            out = out.withColumn(name, F.when(good, F.col(name)).otherwise(F.raise_error(F.concat(F.lit(f"{name}: "), F.col(name).cast("string")))))
    return out


def append(df: DataFrame, path: str, schema: T.StructType, *, rows_per_file: int = 500_000) -> None:
    conform(df, schema).write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(path)


def reload(df: DataFrame, path: str, *, by: tuple[str, ...] = ()) -> None:
    """Replace a materialised table; history is best laid out by measure."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def read_json(path: str) -> dict:
    with open(path) as file:
        return json.load(file)


@dataclass(frozen=True)
class Settings:
    """Defaults of the pipelines, by section."""

    decline_curve: dict = field(default_factory=lambda: {"default": {"horizon": 360, "trials": 3000, "penalty": 1.0, "smoothing": 2, "least_months": 24, "most_months": 60}})
    well_spacing: dict = field(default_factory=lambda: {"default": {"buffer_m": 1000.0, "heel_m": 152.4, "least_ft": 100.0, "threshold_days": 70, "fraction": 0.0}})
    geology: dict = field(default_factory=lambda: {"default": {"samples": 50, "step": 100.0}})

    def get(self, section: str, name: str = "default") -> dict:
        """KeyError for a section or a name that is not there; ValueError for an empty entry."""
        sections = asdict(self)
        if section not in sections:
            raise KeyError(f"no section {section}")
        if name not in sections[section]:
            raise KeyError(f"no entry {name} in {section}")
        if not sections[section][name]:
            raise ValueError(f"entry {name} in {section} is empty")
        return sections[section][name]
