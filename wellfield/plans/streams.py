"""Queries that drive a stream to its end and return its table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources import fixtures as X
from ..sources.versions import VersionedTable
from ..streaming.updates import merge_stream, monthly_totals, updates, upsert_stream


def _root(spark) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex[:12]}"


def _source(spark, d, root):
    """Production that arrives in files, in the order of its update times; a file may hold late rows of its own slice."""
    rows = X.production(spark, d).select("wellid", "dt", "measure", "datasource", "value", F.col("datecreated").cast("timestamp").alias("datecreated"))
    rows.withColumn("slice", F.year("datecreated")).write.partitionBy("slice").parquet(f"{root}/all")
    dealt = spark.read.parquet(f"{root}/all")
    for year in sorted(r[0] for r in dealt.select("slice").distinct().collect()):  # a handful of years
        dealt.where(F.col("slice") == year).drop("slice").write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 8).parquet(f"{root}/in")


def stream_merge(spark, d):
    """Production that arrives in files, merged if newer. A bucket holds few months, so a batch rewrites those it brings."""
    root, keys = _root(spark), ["wellid", "dt", "measure", "datasource"]
    stream = updates(_source(spark, d, root), keys, "datecreated", "800 days")
    table = VersionedTable(spark, f"{root}/table", keys, by=["dt"], buckets=512)
    merge_stream(stream, table, "datecreated", f"{root}/state").awaitTermination()
    return table.read().select(*keys, "value")


def stream_totals(spark, d):
    """Totals by window and phase; every batch updates the windows that it changes, so the last ones are there as well."""
    root = _root(spark)
    totals = monthly_totals(_source(spark, d, root), "datecreated", "800 days")
    flat = totals.select(F.col("window.start").cast("date").alias("start"), "measure", "value", "n")
    table = VersionedTable(spark, f"{root}/table", ["start", "measure"], buckets=8)
    upsert_stream(flat, table, f"{root}/state").awaitTermination()
    return table.read().select("start", "measure", F.round("value", 4).alias("value"), "n")


def snk1_append(spark, d):
    """Production appended in two parts to a table that is not there at first; a part is there whole or not at all."""
    rows = X.production(spark, d).select("wellid", "dt", "measure", "datasource", "value")
    table = VersionedTable(spark, f"{_root(spark)}/table", ["wellid", "dt", "measure", "datasource"], buckets=8)
    for half in (0, 1):  # odd months after even ones
        table.append(rows.where(F.month("dt") % 2 == half))
    return table.read()


QUERIES = {f.__name__: f for f in (stream_merge, stream_totals, snk1_append)}
ORACLES = {
    "snk1_append": f"with {X.SQL} select wellid, dt, measure, datasource, value from production",
    "stream_merge": f"with {X.SQL} select wellid, dt, measure, datasource, value from production",
    "stream_totals": f"""with {X.SQL}, p as (select measure, value, date '1970-01-01' + (datediff('day', date '1970-01-01', cast(datecreated as date)) // 30 * 30)::int as start from production)
      select start, measure, round(sum(value), 4) as value, count(*) as n from p group by 1, 2""",
}
