"""Repeatable appends: jobs broken after each step and run again."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.scalars import hours_after
from gridlake.sinks import once

SCHEMA = T.StructType().add("execution_id", "string").add("v", "long")


def some(spark, batch, n=5):
    return spark.range(n).select(F.lit(batch).alias("execution_id"), F.col("id").alias("v"))


def stored(spark, path):
    return rows(once.read_once(spark, path, SCHEMA))


class Broken(Exception):
    pass


def broken(*_):
    raise Broken


@pytest.mark.parametrize("step", ["_write_rows", "_write_commits"])
def test_a_broken_run_is_repeated(spark, tmp_path, monkeypatch, step):
    """Broken before its rows, or between rows and record: nothing counts, the next run adds all."""
    path = str(tmp_path / "t")
    assert once.append_once(some(spark, "a"), path, "a")
    with monkeypatch.context() as patch:
        patch.setattr(once, step, broken)
        with pytest.raises(Broken):
            once.append_once(some(spark, "b"), path, "b")
    assert stored(spark, path) == rows(some(spark, "a"))
    assert once.unused_attempts(spark, path).count() == (step == "_write_commits")
    assert once.append_once(some(spark, "b"), path, "b")
    assert not once.append_once(some(spark, "b"), path, "b")
    assert stored(spark, path) == rows(some(spark, "a").union(some(spark, "b")))


def test_two_runs_of_a_batch_count_once(spark, tmp_path, monkeypatch):
    """Both saw no record and both wrote one."""
    path = str(tmp_path / "t")
    once.append_once(some(spark, "a"), path, "a")
    none = spark.createDataFrame([], once.COMMITS)
    with monkeypatch.context() as patch:
        patch.setattr(once, "_commits", lambda *_: none)
        assert once.append_once(some(spark, "a"), path, "a")
    assert stored(spark, path) == rows(some(spark, "a"))
    assert once.unused_attempts(spark, path).count() == 1


@pytest.mark.parametrize("step", ["_write_rows", "_write_commits", None])
def test_compaction(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    for batch in "abc":
        once.append_once(some(spark, batch), path, batch)
    want = stored(spark, path)
    if step:
        with monkeypatch.context() as patch:
            patch.setattr(once, step, broken)
            with pytest.raises(Broken):
                once.compact_once(spark, path, SCHEMA)
        assert stored(spark, path) == want
    assert once.compact_once(spark, path, SCHEMA) == 3
    assert stored(spark, path) == want
    assert not once.append_once(some(spark, "a"), path, "a")
    once.append_once(some(spark, "d"), path, "d")
    assert once.compact_once(spark, path, SCHEMA) == 4
    assert stored(spark, path) == sorted(want + rows(some(spark, "d")), key=str)
    live = once.committed(spark, path).select("attempt").distinct().count()
    assert live == 1


def test_compaction_does_not_deal_rows_by_folder(spark, tmp_path, monkeypatch):
    """The rows of one batch are not brought together in one task."""
    path = str(tmp_path / "t")
    for batch in "ab":
        once.append_once(some(spark, batch, 1000), path, batch)
    plans = []
    write = once._write_rows

    def noted(df, *rest):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, *rest)

    monkeypatch.setattr(once, "_write_rows", noted)
    assert once.compact_once(spark, path, SCHEMA) == 2
    assert "BroadcastHashJoin" in plans[0] and "Exchange hashpartitioning" not in plans[0] and "SortMergeJoin" not in plans[0]
    assert len(stored(spark, path)) == 2000


def test_empty_table_batch_and_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert stored(spark, path) == [] and once.compact_once(spark, path, SCHEMA) == 0
    assert once.append_once(some(spark, "a", 0), path, "a")
    assert not once.append_once(some(spark, "a", 3), path, "a")
    assert stored(spark, path) == []
    twice = some(spark, None, 2).union(some(spark, None, 2)).withColumn("extra", F.lit(1))
    once.append_once(twice, path, "b", SCHEMA)
    assert stored(spark, path) == [(None, 0), (None, 0), (None, 1), (None, 1)]  # equal rows of one batch are all kept


def test_by_date(spark, tmp_path):
    path = str(tmp_path / "m")
    hours = spark.range(72).select(hours_after(F.col("id"), "2024-01-01 00:00:00").alias("time"), F.col("id").alias("v"))
    once.append_once(hours, path, "jan", time="time")
    once.append_once(hours, path, "jan", time="time")
    got = once.read_once(spark, path, hours.schema, dates=("2024-01-02", "2024-01-02"))
    assert got.count() == 24
    assert "PartitionFilters: [isnotnull(date" in got._jdf.queryExecution().executedPlan().toString()
    assert once.compact_once(spark, path, hours.schema, time="time") == 1
    assert once.read_once(spark, path, hours.schema, dates=("2024-01-01", "2024-01-31")).count() == 72
