"""Histories by pointer: every change shows as a whole or not at all."""

import pytest
from pyspark.sql import functions as F

from feedloom.sinks import versions as V
from feedloom.sinks.feeds import DAY


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), f"d string, v string").withColumn(DAY, F.to_date("d")).drop("d")


def rows(df):
    return sorted((str(r[DAY]), r.v) for r in df.collect())


def test_days_are_replaced_and_removed(spark, tmp_path):
    history = str(tmp_path / "h")
    with pytest.raises(ValueError, match="no history"):
        V.read_history(spark, history)
    first = V.replace_days(feed(spark, ("2024-01-01", "a"), ("2024-01-01", "a"), ("2024-01-02", "b"), (None, "n")), history)
    V.replace_days(feed(spark, ("2024-01-02", "c"), ("2024-01-03", "d")), history)
    assert rows(V.read_history(spark, history)) == [("2024-01-01", "a"), ("2024-01-01", "a"), ("2024-01-02", "c"), ("2024-01-03", "d"), ("None", "n")]
    V.replace_days(feed(spark, ("2024-01-04", "e")), history, clear=["2024-01-03", "2024-01-04"])
    assert ("2024-01-03", "d") not in rows(V.read_history(spark, history))
    V.keep_newest_days(spark, history, 2)
    assert rows(V.read_history(spark, history)) == [("2024-01-02", "c"), ("2024-01-04", "e")]
    assert ("2024-01-02", "b") in rows(V.read_history(spark, history, first))  # an older state, until it is swept
    assert V.sweep(spark, history) == 4
    assert rows(V.read_history(spark, history)) == [("2024-01-02", "c"), ("2024-01-04", "e")]
    V.drop_days(spark, history, lambda day: False)
    assert V.read_history(spark, history).columns == ["v", DAY] and V.read_history(spark, history).count() == 0


def test_failed_write_leaves_the_old_day(spark, tmp_path, monkeypatch):
    history = str(tmp_path / "h")
    V.replace_days(feed(spark, ("2024-01-01", "old")), history)
    reader = V.read_history(spark, history)
    broken = feed(spark, ("2024-01-01", "new")).withColumn("v", F.when(F.length("v") > 0, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        V.replace_days(broken, history)
    assert rows(V.read_history(spark, history)) == [("2024-01-01", "old")]
    with monkeypatch.context() as patch:  # a job that dies after its rows are written
        patch.setattr(V, "_point", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError, match="died"):
            V.replace_days(feed(spark, ("2024-01-01", "new")), history)
    assert rows(V.read_history(spark, history)) == [("2024-01-01", "old")]
    V.replace_days(feed(spark, ("2024-01-01", "new")), history)
    assert rows(reader) == [("2024-01-01", "old")]  # a reader that began before goes on with what it saw
    assert rows(V.read_history(spark, history)) == [("2024-01-01", "new")]
    assert V.sweep(spark, history) >= 2


def test_two_jobs_at_once(spark, tmp_path, monkeypatch):
    history = str(tmp_path / "h")
    V.replace_days(feed(spark, ("2024-01-01", "a")), history)
    before = V.current(spark, history)
    V.replace_days(feed(spark, ("2024-01-02", "b")), history)
    with monkeypatch.context() as patch:  # this job read the pointer before the other one wrote
        patch.setattr(V, "current", lambda *a: before)
        with pytest.raises(V.CommitConflict):
            V.replace_days(feed(spark, ("2024-01-03", "c")), history)
    assert rows(V.read_history(spark, history)) == [("2024-01-01", "a"), ("2024-01-02", "b")]


def test_new_columns_and_pruning(spark, tmp_path):
    history = str(tmp_path / "h")
    V.replace_days(feed(spark, ("2024-01-01", "a")), history)
    V.replace_days(feed(spark, ("2024-01-02", "b")).withColumn("w", F.lit(1)), history)
    read = V.read_history(spark, history)
    assert sorted((r.v, r.w) for r in read.collect()) == [("a", None), ("b", 1)]
    one = read.where(F.col(DAY) == "2024-01-02")
    assert "PartitionFilters: [isnotnull(feed_date" in one._jdf.queryExecution().toString() and len(one.collect()) == 1
