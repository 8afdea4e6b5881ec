"""Long work in chunks that are committed one by one, so that a run that broke off goes on where it stopped."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def finished(spark: SparkSession, folder: str) -> set[str]:
    """The fingerprints under folder whose results are whole: Spark marks a table when its write is committed."""
    return {found.getParent().getName() for found in _matching(spark, f"{folder}/[^_]*/_SUCCESS")}


def _matching(spark: SparkSession, pattern: str) -> list:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return [status.getPath() for status in found or []]


def fingerprints(rows: DataFrame, version: str = "") -> dict[int, str]:
    """For each chunk of rows (with `chunk`) a name that its rows give, in any order, however they are spread: their
    number, the sum and the exclusive or of their hashes. One line per chunk reaches the driver."""
    columns = [c for c in sorted(rows.columns) if c != "chunk"]
    value = F.xxhash64(*columns)
    told = rows.groupBy("chunk").agg(F.count("*").alias("n"), F.sum(value.cast("decimal(38,0)")).alias("s"), F.bit_xor(F.hash(*columns)).alias("x"))
    named = told.select("chunk", F.sha1(F.concat_ws(":", F.lit(version), F.lit(",".join(columns)), "n", "s", "x")).alias("name"))
    return {r["chunk"]: r["name"] for r in named.collect()}


def in_chunks(rows: DataFrame, keys: list[str], work: Callable[[DataFrame], DataFrame], folder: str, *, chunks: int = 16, version: str = "") -> DataFrame:
    """work(rows), done for a share of the keys at a time and kept in folder, from where the result is read.

    Rows of equal keys fall in one of `chunks` chunks by their hash; work() must treat groups of equal keys apart from
    each other. The rows are written once, by chunk, so that a chunk reads its own alone. A chunk's results are a
    table named after its rows and `version` (whatever else decides them, such as a configuration): a later call with
    the same folder skips those that are whole, and does again those of which rows have changed or that broke off.
    The input's copies, those of broken runs too, go when all is done; one run uses a folder at a time. An empty table is one chunk without rows."""
    spark = rows.sparkSession
    source = f"{folder}/_rows-{uuid.uuid4().hex[:12]}"
    rows.withColumn("chunk", F.pmod(F.xxhash64(*keys), F.lit(chunks)).cast("int")).write.partitionBy("chunk").parquet(source)
    dealt = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, chunk int").parquet(source)
    names, done = fingerprints(dealt, version) or {-1: "empty"}, finished(spark, folder)
    for chunk, name in sorted(names.items()):
        if name not in done:
            work(dealt.where(F.col("chunk") == chunk).drop("chunk")).write.mode("overwrite").parquet(f"{folder}/{name}")
    for place in _matching(spark, f"{folder}/_rows-*"):
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return spark.read.parquet(*(f"{folder}/{name}" for name in sorted(set(names.values()))))
