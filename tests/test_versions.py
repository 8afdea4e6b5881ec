"""The versioned table: what a batch writes, what readers see, and batches that break off or come again."""

import pathlib

import pytest
from pyspark.sql import functions as F

from wellfield.sources.versions import VersionedTable

SCHEMA = "k long, v long, at long"


def make(spark, tmp_path, **options):
    return VersionedTable(spark, f"file://{tmp_path}/t", ["k"], **options)


def rows(spark, keys, v, at=0):
    return spark.createDataFrame([(k, v, at) for k in keys], SCHEMA)


def content(table):
    return {r["k"]: r["v"] for r in table.read().collect()}


def files(tmp_path):
    return {p for p in pathlib.Path(tmp_path, "t", "data").rglob("*.parquet")}


def test_a_batch_writes_the_buckets_it_touches(spark, tmp_path):
    table = make(spark, tmp_path, buckets=16)
    assert table.read() is None
    assert table.merge(rows(spark, range(2000), 1), 0)
    before = files(tmp_path)
    assert table.merge(rows(spark, [5, 9001], 2), 1)
    new = files(tmp_path) - before
    assert 1 <= len({p.parent.name for p in new}) <= 2 and sum(p.stat().st_size for p in new) < sum(p.stat().st_size for p in before) / 4
    got = content(table)
    assert len(got) == 2001 and got[5] == 2 and got[9001] == 2 and got[6] == 1


def test_a_batch_counts_once(spark, tmp_path):
    table = make(spark, tmp_path)
    table.merge(rows(spark, range(10), 1), 3)
    assert not table.merge(rows(spark, range(10), 2), 3)
    assert not table.merge(rows(spark, range(10), 2), 1)
    assert set(content(table).values()) == {1} and table.version() == 3


def test_readers_keep_their_version(spark, tmp_path):
    table = make(spark, tmp_path, buckets=2)
    table.merge(rows(spark, range(10), 1), 0)
    held = table.read()
    table.merge(rows(spark, range(10), 2), 1)
    assert {r["v"] for r in held.collect()} == {1} and set(content(table).values()) == {2}
    table.merge(rows(spark, range(10), 3), 2)
    assert len({p.parent.parent.name for p in files(tmp_path)}) == 2  # the first version's folders are gone


def test_a_batch_that_breaks_off_leaves_nothing(spark, tmp_path, monkeypatch):
    table = make(spark, tmp_path)
    table.merge(rows(spark, range(10), 1), 0)
    commit = VersionedTable._commit
    monkeypatch.setattr(VersionedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.merge(rows(spark, range(20), 2), 1)
    with pytest.raises(RuntimeError):
        table.append(rows(spark, range(90, 95), 2))
    assert set(content(table).values()) == {1} and table.version() == 0
    monkeypatch.setattr(VersionedTable, "_commit", commit)
    assert table.merge(rows(spark, range(20), 2), 1)
    assert content(table) == dict.fromkeys(range(20), 2)
    names = {p.parent.parent.name for p in files(tmp_path)}
    assert len(names) <= 2  # what the broken batches wrote is gone


def test_newer_rows_win(spark, tmp_path):
    table = make(spark, tmp_path)
    table.merge(rows(spark, [1, 2], 1, at=5), 0, only_newer="at")
    table.merge(rows(spark, [1], 2, at=4).union(rows(spark, [2, 3], 2, at=6)), 1, only_newer="at")
    assert content(table) == {1: 1, 2: 2, 3: 2}


def test_append_adds_and_checks(spark, tmp_path):
    table = make(spark, tmp_path, buckets=4)
    table.append(rows(spark, [], 0))
    assert table.read().count() == 0 and table.read().columns == ["k", "v", "at"]
    table.append(rows(spark, range(50), 1))
    before = files(tmp_path)
    table.append(rows(spark, range(50, 60), 2))
    assert before <= files(tmp_path)  # nothing is written again
    with pytest.raises(ValueError, match="columns differ"):
        table.append(rows(spark, [1], 1).withColumn("v", F.col("v").cast("string")))
    assert table.read().count() == 60
    table.merge(rows(spark, [3], 9), 7)
    assert table.read().count() == 60 and content(table)[3] == 9


def test_null_keys_and_empty_batches(spark, tmp_path):
    table = make(spark, tmp_path)
    table.merge(rows(spark, [None, 1], 1), 0)
    table.merge(rows(spark, [None], 2), 1)
    table.merge(rows(spark, [], 2), 2)
    assert sorted((r["k"] is None, r["v"]) for r in table.read().collect()) == [(False, 1), (True, 1), (True, 2)] and table.version() == 2


def test_a_merge_shuffles_its_rows_once(spark, tmp_path):
    """Rows are written from where the join left them: no shuffle of their own to gather a bucket."""
    from pyspark.sql import DataFrame

    dealt, plain = [], DataFrame.repartition
    table = VersionedTable(spark, f"file://{tmp_path}/once", ["k"], buckets=4)
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    DataFrame.repartition = lambda self, *a: dealt.append(a) or plain(self, *a)
    try:
        table.merge(rows, 0)
        table.merge(rows.withColumn("v", F.lit(2)), 1)
    finally:
        DataFrame.repartition = plain
    assert not dealt and table.read().where("v = 2").count() == 100
