"""Streams that are merged into a versioned table: what a batch writes, which duplicates go, and how much state is held."""

from datetime import date, datetime

from wellfield.plans import streams
from wellfield.sources.versions import VersionedTable
from wellfield.streaming.updates import merge_stream, updates

SCHEMA = "wellid long, dt date, measure string, datasource string, value double, datecreated timestamp"
KEYS = ["wellid", "dt", "measure", "datasource"]


def row(well, value, created, dt=date(2001, 1, 31)):
    return (well, dt, "OIL", "PRIMARY", float(value), created)


def arriving(spark, tmp_path, batches):
    """A stream of which each micro-batch is one of the lists."""
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")


def merged(spark, tmp_path, batches):
    table = VersionedTable(spark, f"file://{tmp_path}/table", KEYS, by=["dt"], buckets=8)
    query = merge_stream(updates(arriving(spark, tmp_path, batches), KEYS, "datecreated", "800 days"), table, "datecreated", f"file://{tmp_path}/state")
    query.awaitTermination()
    return table, query


def test_a_batch_rewrites_the_months_that_it_brings(spark, tmp_path, monkeypatch):
    years = [[row(w, y, datetime(y, m, 20), date(y, m, 28)) for w in range(10) for m in range(1, 13)] for y in range(1995, 2000)]
    written, write = [], VersionedTable._write
    monkeypatch.setattr(VersionedTable, "_write", lambda self, rows: written.append(rows.count()) or write(self, rows))
    monkeypatch.setattr(streams, "_source", lambda *a: arriving(spark, tmp_path, years))
    assert streams.stream_merge(spark, "").count() == 600
    assert len(written) == 5 and sum(written) <= 900  # 1,800 where every batch rewrites the table


def test_duplicates_go_and_late_rows_count(spark, tmp_path):
    first, again = datetime(2001, 1, 1), datetime(2001, 2, 1)
    table, _ = merged(spark, tmp_path, [
        [row(1, 1, first), row(1, 1, first), row(None, 5, first)],
        [row(1, 1, first), row(None, 5, first), row(1, 2, again)],
        [row(1, 1, first), row(None, 5, first), row(2, 3, datetime(1990, 1, 1))],
    ])
    assert sorted((r["wellid"] or 0, r["value"]) for r in table.read().collect()) == [(0, 5.0), (1, 2.0), (2, 3.0)]


def test_state_holds_no_known_key_in_few_parts(spark, tmp_path):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "100")
    try:
        _, query = merged(spark, tmp_path, [[row(w, 1, datetime(2001, 1, 1)) for w in [None, *range(50)]]])
        assert spark.conf.get(name) == "100"
    finally:
        spark.conf.set(name, before)
    state = query.recentProgress[0]["stateOperators"][0]
    assert state["numRowsTotal"] == 1 and state["numShufflePartitions"] <= 3 * spark.sparkContext.defaultParallelism


def test_a_known_unique_source_is_not_checked(spark):
    from wellfield.operators.upsert import merge

    old, new = (spark.createDataFrame(rows, "k long, v long") for rows in ([(1, 1), (2, 1)], [(2, 2), (3, 2), (None, 2)]))
    plans = [merge(old, new, ["k"], unique=unique) for unique in (False, True)]
    assert sorted(map(str, plans[0].collect())) == sorted(map(str, plans[1].collect()))
    assert ["Window" in p._jdf.queryExecution().toString() for p in plans] == [True, False]
