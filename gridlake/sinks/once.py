"""Appends that can be repeated: every batch counts once, however often its job ran.

A run writes its rows to a folder of its own, then one commit record naming the batch and
the folder. Rows count from the record on, and a batch counts through its winning record
only, so a job that broke off at any step, or ran twice, can be run again.

Folders below a table's path: ``rows/attempt=<id>[/date=<day>]`` and
``commits/attempt=<id>``. A commit folder is one file, written whole or not at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.sinks.tables import conform

COMMITS = "batch string, generation int, committed_at timestamp, attempt string"
BATCH = "_batch"


def _stored(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The files below ``path``; no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, f"{path}/commits", COMMITS)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """``(batch, attempt)``: the folder each stored batch counts through.

    The newest generation wins, and within it the record written first, so two runs of
    one batch that both came to an end count once.
    """
    order = F.struct((-F.col("generation")).alias("g"), "committed_at", "attempt")
    return _commits(spark, path).groupBy("batch").agg(F.min(order)["attempt"].alias("attempt"))


def _write_rows(rows: DataFrame, path: str, attempt: str, time: str | None, sort: Sequence[str]) -> None:
    folder = f"{path}/rows/attempt={attempt}"
    if time is None:
        rows.write.parquet(folder)
        return
    dated = rows.withColumn("date", F.to_date(time)).hint("rebalance", "date")
    dated.sortWithinPartitions("date", *sort, time).write.partitionBy("date").parquet(folder)


def _write_commits(batches: DataFrame, path: str, attempt: str, generation: int) -> None:
    """One row per batch, in one file: whichever of them a reader sees, it sees all."""
    records = batches.select(
        F.col("batch").cast("string"), F.lit(generation).alias("generation"), F.current_timestamp().alias("committed_at")
    )
    records.coalesce(1).write.parquet(f"{path}/commits/attempt={attempt}")


def append_once(
    df: DataFrame,
    path: str,
    batch: str,
    schema: T.StructType | None = None,
    time: str | None = None,
    sort: Sequence[str] = (),
) -> bool:
    """Append the rows of ``batch`` unless they are stored; says whether they were added.

    With ``schema``, its columns are taken by name, NULL where there is none. With ``time``, rows lie by date, as measurements do. A batch's name stands for its rows:
    other rows under a name that is stored are not added. An empty batch counts as stored.
    """
    spark = df.sparkSession
    if not _commits(spark, path).filter(F.col("batch") == batch).isEmpty():
        return False
    attempt = uuid.uuid4().hex
    rows = df if schema is None else conform(df, schema)
    _write_rows(rows.withColumn(BATCH, F.lit(batch)), path, attempt, time, sort)
    _write_commits(spark.createDataFrame([(batch,)], "batch string"), path, attempt, 0)
    return True


def _all_rows(spark: SparkSession, path: str, schema: T.StructType, dated: bool) -> DataFrame:
    fields = [*schema.fields, T.StructField(BATCH, T.StringType()), T.StructField("attempt", T.StringType())]
    return _stored(spark, f"{path}/rows", T.StructType(fields + ([T.StructField("date", T.DateType())] if dated else [])))


def read_once(spark: SparkSession, path: str, schema: T.StructType, dates: tuple[str, str] | None = None) -> DataFrame:
    """The rows of all stored batches, each once, with the columns of ``schema``.

    ``dates`` limits a table that lies by date to the days between both, which prunes
    its folders. Folders of runs that broke off are pruned by the commits at run time.
    """
    rows = _all_rows(spark, path, schema, dates is not None)
    if dates is not None:
        rows = rows.filter(F.col("date").between(*dates))
    return _counting(rows, committed(spark, path)).select(*schema.fieldNames())


def _counting(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """Rows of the winning folders. Dealt by folder, a batch would be the work of one task, so
    the winners go to the rows: one row per stored batch, whatever the rows."""
    named = winners.withColumnRenamed("batch", BATCH)
    return rows.join(F.broadcast(named), ["attempt", BATCH], "left_semi")


def compact_once(spark: SparkSession, path: str, schema: T.StructType, time: str | None = None) -> int:
    """Write all stored batches to one folder; gives the number of batches in it.

    The folders before it stay until :func:`unused_attempts` names them, so readers that
    began earlier still find their files. A batch stored meanwhile keeps its own folder.
    """
    # Read once: rows and records must speak of the same batches.
    winners = [(r.batch, r.attempt) for r in committed(spark, path).collect()]  # a batch is a job's run
    if not winners:
        return 0
    last = _commits(spark, path).agg(F.max("generation")).head()[0]
    fixed = spark.createDataFrame(winners, "batch string, attempt string")
    attempt = uuid.uuid4().hex
    rows = _counting(_all_rows(spark, path, schema, time is not None), fixed).select(*schema.fieldNames(), BATCH)
    _write_rows(rows, path, attempt, time, ())
    _write_commits(fixed, path, attempt, last + 1)
    return len(winners)


def unused_attempts(spark: SparkSession, path: str) -> DataFrame:
    """``attempt`` of folders no batch counts through: broken runs, beaten and compacted ones.

    A run that is still writing is among them, so a clean-up must leave young folders alone.
    """
    stored = _all_rows(spark, path, T.StructType([]), False).select("attempt").distinct()
    return stored.join(committed(spark, path), "attempt", "left_anti")
