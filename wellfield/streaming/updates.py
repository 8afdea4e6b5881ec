"""Production updates as a stream: duplicates go, each batch is merged into the table if newer."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.upsert import latest_wins
from ..sources.versions import VersionedTable


def updates(stream: DataFrame, keys: list[str], time: str, late: str = "30 days") -> DataFrame:
    """Updates for merge_stream. A row whose key and time are in the table changes nothing there, so a table's own rows tell
    what is a duplicate, however late it comes. Rows with a null key match none: theirs go here, by state that is kept
    until the watermark has passed them."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    known = reduce(and_, (F.col(key).isNotNull() for key in keys))
    return timed.where(known).unionByName(timed.where(~known).dropDuplicatesWithinWatermark([*keys, time]))


def monthly_totals(stream: DataFrame, time: str, late: str = "30 days") -> DataFrame:
    """Volume by phase over windows of thirty days; state is kept until the watermark has passed a window."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, "30 days"), "measure").agg(F.sum("value").alias("value"), F.count("*").alias("n"))


def merge_stream(stream: DataFrame, table: VersionedTable, newer: str, checkpoint: str) -> StreamingQuery:
    """Start a query that merges each micro-batch: the latest row of a key wins if it is newer than the table's. A batch
    that runs again after a restart changes nothing."""
    return _start(stream, table, checkpoint, "append", lambda batch: latest_wins(batch, table.keys, newer), unique=True, only_newer=newer)


def upsert_stream(stream: DataFrame, table: VersionedTable, checkpoint: str) -> StreamingQuery:
    """Start a query in update mode: the rows that a micro-batch changes replace those with their keys."""
    return _start(stream, table, checkpoint, "update", lambda batch: batch)


def _start(stream: DataFrame, table: VersionedTable, checkpoint: str, mode: str, rows_of: Callable[[DataFrame], DataFrame], **options) -> StreamingQuery:
    def once(batch: DataFrame, number: int) -> None:
        rows = rows_of(batch).persist()  # its buckets are listed before it is merged
        try:
            table.merge(rows, number, **options)
        finally:
            rows.unpersist()

    # Every batch loads and commits each part of the state, however little is in it: three a core, at most. A query keeps
    # the number that it started with.
    spark, name = stream.sparkSession, "spark.sql.shuffle.partitions"
    parts = spark.conf.get(name)
    spark.conf.set(name, str(min(int(parts), 3 * spark.sparkContext.defaultParallelism)))
    try:
        return stream.writeStream.outputMode(mode).foreachBatch(once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(name, parts)
