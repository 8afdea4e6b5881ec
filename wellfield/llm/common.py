"""Shared helpers: scratch tables in the cluster's shared folder, global ranks, and zero-copy text batches."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shared_dir

#: Spark releases the shuffle files of a finished write under this setting.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as make it none of df's columns."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


@contextlib.contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Scratch:
    """Named intermediate tables under the shared folder. Writing one cuts the lineage, so a lost executor costs
    a re-read, never a recomputation of what lies before; drop() frees the disk of what is no longer needed."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.paths = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}", {}

    def put(self, name: str, df: DataFrame, codec: str = "zstd") -> DataFrame:
        path = self.paths[name] = f"{self.root}/{name}"
        with shuffle_cleanup(self.spark):
            df.write.mode("overwrite").option("compression", codec).parquet(path)
        self.until_exit(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _file(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def until_exit(self, path: str) -> None:
        """Results may still read the table; it goes when the application ends."""
        system, place = self._file(path)
        system.deleteOnExit(place)

    @contextlib.contextmanager
    def small_batches(self, rows: int = 16) -> Iterator[None]:
        """For writes of tables with large rows: so few rows go to Python at a time."""
        key = "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, str(rows))
        try:
            yield
        finally:
            self.spark.conf.set(key, before)

    def drop(self, *names: str) -> None:
        for name in names:
            system, place = self._file(self.paths.pop(name))
            system.delete(place, True)


def shuffle_parts(spark: SparkSession) -> int:
    """How finely the cluster is set to deal rows; buckets scale with it."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)), F.lit(1), n.cast("int")), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else as it is. The built-in lower() does that on ASCII text, and faster."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def ranked(scratch: Scratch, name: str, df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """df with a global rank from 0 by `order`: range partitions are numbered apart, then shifted by the counts of
    those before them. Only one count per partition meets in one place."""
    part = f"{rank}__part"
    dealt = scratch.put(name, df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = dealt.groupBy(part).agg(F.count("*").alias("n")).select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    number = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    return dealt.withColumn(rank, number.cast("long")).join(F.broadcast(shift), part).withColumn(rank, F.col(rank) + F.col("shift")).drop(part, "shift")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its rows; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(ends):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `most` bytes of text (a longer text has a slice of its own)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
