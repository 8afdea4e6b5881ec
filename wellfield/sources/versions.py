"""A table in key buckets of which each version is a list of folders, so that a batch rewrites only what it touches."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import merge

#: Versions whose folders stay: the current one, and the one that readers may still have open.
KEPT = 2


class VersionedTable:
    """Rows lie in folders root/data/<name>/bucket__=<k>, by a hash of the columns `by` (the keys, if not told).

    A version is a manifest root/manifests/<number>: the schema and the folders of each bucket. It counts once Spark has
    marked its write as committed; so readers see whole versions, and a batch that broke off left nothing that counts.
    A batch whose number is not above the current one has been applied before and is skipped. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], *, by: list[str] | None = None, buckets: int = 64):
        self.spark, self.root, self.keys, self.by, self.buckets = spark, root.rstrip("/"), keys, by or keys, buckets

    def _glob(self, pattern: str) -> list:
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        found = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
        return [status.getPath() for status in found or []]

    def _delete(self, place) -> None:
        place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

    def _numbers(self) -> list[int]:
        return sorted(int(p.getParent().getName()) for p in self._glob("manifests/*/_SUCCESS"))

    def _manifest(self, number: int) -> tuple[T.StructType, dict[int, list[str]]]:
        """The schema and the folders by bucket: a few rows a bucket."""
        folders: dict[int, list[str]] = {}
        for row in self.spark.read.schema("bucket int, place string").parquet(f"{self.root}/manifests/{number:012d}").collect():
            folders.setdefault(row["bucket"], []).append(row["place"])
        return T.StructType.fromJson(json.loads(folders.pop(-1)[0])), folders

    def version(self) -> int | None:
        numbers = self._numbers()
        return numbers[-1] if numbers else None

    def read(self, buckets: set[int] | None = None) -> DataFrame | None:
        """The current version, or those buckets of it; None where there is no table yet."""
        number = self.version()
        return None if number is None else self._frame(*self._manifest(number), buckets)

    def _frame(self, schema: T.StructType, folders: dict[int, list[str]], buckets: set[int] | None = None) -> DataFrame:
        places = [f"{self.root}/{p}" for k, own in sorted(folders.items()) if buckets is None or k in buckets for p in own]
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame) -> tuple[str, set[int]]:
        """Write rows by bucket; the folder, and the buckets that are in it."""
        name = f"data/{uuid.uuid4().hex}"
        rows.withColumn("bucket__", self._bucket()).write.partitionBy("bucket__").parquet(f"{self.root}/{name}")
        return name, {int(p.getName().partition("=")[2]) for p in self._glob(f"{name}/bucket__=*")}

    def _commit(self, number: int, schema: T.StructType, folders: dict[int, list[str]]) -> None:
        rows = [(-1, schema.json()), *((k, p) for k, own in folders.items() for p in own)]
        self.spark.createDataFrame(rows, "bucket int, place string").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifests/{number:012d}")
        self._clean()

    def _clean(self) -> None:
        """Manifests and folders that no kept version names go."""
        numbers = self._numbers()
        named = {p for n in numbers[-KEPT:] for own in self._manifest(n)[1].values() for p in own}
        for n in numbers[:-KEPT]:
            for place in self._glob(f"manifests/{n:012d}"):
                self._delete(place)
        for place in self._glob("data/*/bucket__=*"):
            if f"data/{place.getParent().getName()}/{place.getName()}" not in named:
                self._delete(place)

    def merge(self, rows: DataFrame, number: int, **options) -> bool:
        """Apply a batch, with the options of upsert.merge: read, merge and write the buckets that it touches, and point
        the new version to these and to the folders of all others. False if the batch had been applied before."""
        current = self.version()
        if current is not None and number <= current:
            return False
        schema, folders = (rows.schema, {}) if current is None else self._manifest(current)
        touched = {r[0] for r in rows.select(self._bucket()).distinct().collect()}  # numbers of buckets
        if touched or current is None:
            name, found = self._write(merge(self._frame(schema, folders, touched), rows, self.keys, **options))
            folders = {k: own for k, own in folders.items() if k not in touched} | {k: [f"{name}/bucket__={k}"] for k in found}
        self._commit(number, schema, folders)
        return True

    def append(self, rows: DataFrame, number: int | None = None) -> bool:
        """Add rows, all or none, creating the table if there is none; ValueError if their columns are not the table's.
        Only the new rows are written."""
        current = self.version()
        number = (-1 if current is None else current) + 1 if number is None else number
        if current is not None and number <= current:
            return False
        schema, folders = (rows.schema, {}) if current is None else self._manifest(current)
        if [(f.name, f.dataType) for f in rows.schema] != [(f.name, f.dataType) for f in schema]:
            raise ValueError(f"columns differ from the table's: {rows.schema.simpleString()}, not {schema.simpleString()}")
        name, found = self._write(rows)
        self._commit(number, schema, folders | {k: [*folders.get(k, []), f"{name}/bucket__={k}"] for k in found})
        return True
