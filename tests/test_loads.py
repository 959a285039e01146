"""Loads that are repeated or break off, and rejected rows."""
import datetime as dt
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from urbanlens.plans import jobs
from urbanlens.sources import io, loads, scratch

TEXT = "tweets string, date string, station string, sentiment string"
ROWS = [("a", "2024-01-08 10:00:00", "Bank", "0.25"), ("b", "2024-01-08 11:00:00", None, None)]


@pytest.fixture
def db(spark):
    name = f"ul_{uuid.uuid4().hex}"
    io.ensure_tables(spark, name, location=tempfile.mkdtemp(prefix="ul-db-") + "/db")
    return name


def mark(spark, day):
    return io.lineage_row(spark, io.JOB_LOAD, io.STEP_LOAD, "x", "y", dt.datetime(2024, 1, day, 6))


def load(spark, db, day, rows):
    topics = spark.createDataFrame([(dt.date(2024, 1, day), "a, b")], "date date, topics string")
    frames = {"sentiment": io.cast_on_load(spark.createDataFrame(rows, TEXT), strict=True), "topics": topics}
    loads.load_batch(spark, db, 20240100 + day, frames, mark(spark, day))


def counts(spark, db):
    return {t: sorted(r.batch_nr for r in loads.loaded(spark, db, t).collect()) for t in ("sentiment", "topics", "data_lineage")}


def test_a_second_load_leaves_each_row_once(spark, db):
    for day, rows in ((8, ROWS), (15, ROWS[:1]), (8, ROWS), (8, ROWS[:1]), (15, [])):
        load(spark, db, day, rows)
    assert counts(spark, db) == {"sentiment": [20240108], "topics": [20240108, 20240115], "data_lineage": [20240108, 20240115]}


def test_a_load_that_breaks_off_is_not_seen_and_can_be_repeated(spark, db, monkeypatch):
    load(spark, db, 8, ROWS)
    for last in ("sentiment", "topics", "data_lineage"):
        def broken(spark, table, partition, df, last=last, write=loads._overwrite):
            if table.endswith(last):
                raise RuntimeError("lost")
            write(spark, table, partition, df)
        with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
            m.setattr(loads, "_overwrite", broken)
            load(spark, db, 15, ROWS)
        assert counts(spark, db) == {"sentiment": [20240108] * 2, "topics": [20240108], "data_lineage": [20240108]}
    load(spark, db, 15, ROWS)
    assert counts(spark, db) == {"sentiment": [20240108] * 2 + [20240115] * 2, "topics": [20240108, 20240115], "data_lineage": [20240108, 20240115]}


def test_a_batch_that_cannot_be_computed_changes_nothing(spark, db):
    load(spark, db, 8, ROWS)
    with pytest.raises(Exception, match="unreadable"):
        load(spark, db, 8, [("c", "never", "Bank", "1")])
    assert counts(spark, db) == {"sentiment": [20240108] * 2, "topics": [20240108], "data_lineage": [20240108]}


def test_rejected_rows_have_reasons(spark):
    rows = [("a", "2024-01-08 10:00:00", "s", "0.25"), ("b", "soon", "s", "0.5"), ("c", None, "s", None), ("d", "soon", "s", "1e9"), ("e", "2024-01-08", "s", "x")]
    checked = loads.checked_on_load(spark.createDataFrame(rows, TEXT), {"date": "timestamp", "sentiment": "decimal(5,2)"})
    assert sorted(r.tweets for r in loads.accepted(checked).collect()) == ["a", "c"]
    assert {r.tweets: (r.date, r.sentiment, r.reasons) for r in loads.rejected(checked, "tweets").collect()} == {
        "b": ("soon", "0.5", "date: not timestamp"), "d": ("soon", "1e9", "date: not timestamp; sentiment: not decimal(5,2)"), "e": ("2024-01-08", "x", "sentiment: not decimal(5,2)")}


def test_load_results_sets_bad_rows_aside(spark, db):
    base = tempfile.mkdtemp(prefix="ul-load-")
    spark.createDataFrame([*ROWS, ("bad", "soon", "Bank", "9")], TEXT).write.parquet(f"{base}/sentiment/1")
    spark.createDataFrame([(dt.date(2024, 1, 8), "a, b")], "date date, topics string").write.parquet(f"{base}/topics/1")
    for _ in range(2):
        jobs.load_results(spark, f"{base}/sentiment", f"{base}/topics", db, dt.datetime(2024, 1, 8), bad_rows="set_aside")
    assert loads.loaded(spark, db, "sentiment").count() == 2
    [r] = loads.loaded(spark, db, "rejected").collect()
    assert '"tweets":"bad"' in r.row and r.reasons == "date: not timestamp"
    with pytest.raises(Exception, match="unreadable"):
        jobs.load_results(spark, f"{base}/sentiment", f"{base}/topics", db, dt.datetime(2024, 1, 9))


def test_scratch_tables(spark):
    t = scratch.stored(spark.range(5).select(F.col("id").alias("n")), "test")
    assert t.count() == 5
    scratch.forget(t)
    with pytest.raises(Exception, match="(?i)not exist|FileNotFound|FAILED_READ"):
        t.count()
