"""Upserts as DataFrame expressions: a new table from the old one and what arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


SPREAD = "__spread"


def _spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """df with a further join key: 0 for rows whose keys are known, else an odd hash of the whole row."""
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    plain = [f.name for f in df.schema if not f.dataType.simpleString().startswith("map")]
    return df.withColumn(SPREAD, F.when(known, F.lit(0).cast("long")).otherwise(F.xxhash64(*plain).bitwiseOR(F.lit(1))))


def merge(target: DataFrame, source: DataFrame, keys: list[str], *, keep_old: list[str] = (), coalesce_old: list[str] = (), only_newer: str | None = None, unique: bool = False) -> DataFrame:
    """Update rows whose keys match, insert the others. Null keys never match. A key that the source has twice would
    update one row twice: that is an error, raised when the result is computed.

    keep_old: columns set on insert only. coalesce_old: the old value stays where the new one is null. only_newer: an
    update happens only where this column has grown. unique: the source is known to hold no key twice, so that isn't
    checked. One full join on the keys does all of it; rows with a null key are dealt by what else they hold, so that many
    of them don't meet in one task."""
    t, s = (_spread(df, keys) for df in (target, source))
    match = F.lit(True)
    for key in [*keys, SPREAD]:
        match = match & (F.col(f"t.{key}") == F.col(f"s.{key}"))
    there, here = F.col("t.__old").isNotNull(), F.col("s.__new").isNotNull()
    twice = F.when((F.col(SPREAD) == 0) & (F.count("*").over(Window.partitionBy(*keys, SPREAD)) > 1), F.raise_error(F.lit("several source rows for one key"))).otherwise(1)
    t, s = t.withColumn("__old", F.lit(1)).alias("t"), s.withColumn("__new", F.lit(1) if unique else twice.cast("int")).alias("s")
    take = here if only_newer is None else here & (~there | (F.col(f"t.{only_newer}") < F.col(f"s.{only_newer}")))

    def pick(c: str):
        if c not in source.columns:
            return F.col(f"t.{c}").alias(c)
        new = F.col(f"s.{c}")
        if c in keep_old:
            new = F.when(there, F.col(f"t.{c}")).otherwise(new)
        elif c in coalesce_old:
            new = F.coalesce(new, F.col(f"t.{c}"))
        return F.when(take, new).otherwise(F.col(f"t.{c}")).alias(c)

    return t.join(s, match, "full").select(*map(pick, target.columns))


def replace_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of any key that arrives are replaced."""
    return target.join(source.select(*keys).distinct(), keys, "left_anti").unionByName(source.select(*target.columns))


def update_from(target: DataFrame, source: DataFrame, keys: list[str], *, only_null: bool = False) -> DataFrame:
    """Set the columns that the source has beside the keys, on matching rows; ValueError if it lacks a key."""
    if missing := [k for k in keys if k not in source.columns]:
        raise ValueError(f"missing keys: {missing}")
    columns = [c for c in source.columns if c not in keys]
    found = source.select(*keys, F.lit(1).alias("__found"), *(F.col(c).alias(f"__{c}") for c in columns))

    def pick(c: str):
        if c not in columns:
            return F.col(c)
        take = F.col("__found").isNotNull() & (F.col(c).isNull() if only_null else F.lit(True))
        return F.when(take, F.col(f"__{c}")).otherwise(F.col(c)).alias(c)

    return target.join(found, keys, "left").select(*map(pick, target.columns))


def delete_orphans(rows: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(parents, keys, "left_semi")


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(source.join(target, keys, "left_anti").select(*target.columns))


def latest_wins(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The row of each key with the largest `column`; of equal ones the largest by the other columns."""
    by = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(column), *(F.desc(c) for c in rows.columns if c not in (*keys, column)))
    return rows.withColumn("__n", F.row_number().over(by)).where("__n = 1").drop("__n")


def fingerprint(rows: DataFrame, group: list[str], parts: list[str]) -> DataFrame:
    """16 hex digits for each group's set of parts, whatever their order."""
    listed = F.sort_array(F.collect_set(F.concat_ws(":", *parts)))
    return rows.groupBy(*group).agg(F.left(F.sha1(F.concat_ws(",", listed)), F.lit(16)).alias("fingerprint"))
