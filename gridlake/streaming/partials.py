"""Rollups kept as mergeable parts.

A batch adds the sums, counts and extremes of its own rows, per bucket, in a folder of its
own; reading merges the parts of a bucket. So a batch costs its rows and never reads a day
again, and any cut of the input into batches gives the same rollup. :func:`compact` merges
the parts of many batches into one generation; a reader takes the newest whole generation
and the batches after it.

Folders: ``batch=<id>/<bucket date>`` below ``parts`` and ``merged/upto=<id>``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rollup:
    """Measures per ``keys`` and time bucket: output name to column."""

    keys: Sequence[str]
    width: str = "1 hour"
    bucket: str = "bucket"
    time: str = "time"
    means: Mapping[str, str] = field(default_factory=dict)
    sums: Mapping[str, str] = field(default_factory=dict)
    lows: Mapping[str, str] = field(default_factory=dict)
    highs: Mapping[str, str] = field(default_factory=dict)
    count: str | None = None

    @property
    def grouping(self) -> list[str]:
        return [self.bucket, *self.keys]


HOURLY = Rollup(
    ("bus_id", "case_name"),
    means={
        "avg_voltage": "voltage_magnitude",
        "avg_active_power": "active_power_mw",
        "avg_reactive_power": "reactive_power_mvar",
    },
    lows={"min_voltage": "voltage_magnitude"},
    highs={"max_voltage": "voltage_magnitude"},
    count="measurement_count",
)
DAILY = Rollup(
    ("generator_id", "generator_type", "case_name"),
    width="1 day",
    bucket="day",
    means={"avg_generation": "active_power_mw", "avg_marginal_cost": "marginal_cost"},
    sums={"total_generation_mwh": "active_power_mw"},
    highs={"peak_generation": "active_power_mw"},
)


def _parts(rollup: Rollup) -> list[tuple[str, str, str]]:
    """(stored column, source column, aggregate) of all measures."""
    out = []
    for name, column in rollup.means.items():
        out += [(f"{name}_sum", column, "sum"), (f"{name}_n", column, "count")]
    out += [(name, column, "sum") for name, column in rollup.sums.items()]
    out += [(name, column, "min") for name, column in rollup.lows.items()]
    out += [(name, column, "max") for name, column in rollup.highs.items()]
    return out + ([(rollup.count, "*", "count")] if rollup.count else [])


_MAKE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
_MERGE = {**_MAKE, "count": F.sum}


def partial(rows: DataFrame, rollup: Rollup) -> DataFrame:
    """The parts of ``rows``: one row per bucket and key."""
    measures = [_MAKE[how](column).alias(name) for name, column, how in _parts(rollup)]
    grouped = rows.groupBy(F.window(rollup.time, rollup.width).alias("_w"), *rollup.keys).agg(*measures)
    return grouped.withColumn(rollup.bucket, F.col("_w.start")).drop("_w")


def merge(parts: DataFrame, rollup: Rollup) -> DataFrame:
    """Parts of one bucket and key added up; parts themselves, so merging may be repeated."""
    measures = [_MERGE[how](name).alias(name) for name, _, how in _parts(rollup)]
    return parts.groupBy(*rollup.grouping).agg(*measures)


def finish(parts: DataFrame, rollup: Rollup) -> DataFrame:
    """The rollup's measures from merged parts; a mean without values is null."""
    measures: list[Column] = []
    for name in rollup.means:
        n = F.col(f"{name}_n")
        measures.append(F.when(n > 0, F.col(f"{name}_sum") / n).alias(name))
    rest = [*rollup.sums, *rollup.lows, *rollup.highs, *([rollup.count] if rollup.count else [])]
    return parts.select(*rollup.grouping, *measures, *rest)


def _write(parts: DataFrame, rollup: Rollup, folder: str) -> None:
    dated = parts.withColumn("bucket_date", F.to_date(rollup.bucket))
    dated.hint("rebalance", "bucket_date").write.mode("overwrite").partitionBy("bucket_date").parquet(folder)


def store_partial(rows: DataFrame, rollup: Rollup, path: str, batch_id: int) -> None:
    """Add the parts of a batch. A batch that is run again replaces its own folder."""
    _write(partial(rows, rollup), rollup, f"{path}/parts/batch={batch_id}")


def whole_folders(spark: SparkSession, path: str, name: str) -> dict[int, str]:
    """Whole folders ``<name>=<number>`` below ``path``: those with Spark's commit marker."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    store = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(top):
        return {}
    found = {}
    for status in store.listStatus(top):
        place = status.getPath()
        number = re.fullmatch(rf"{name}=(\d+)", place.getName())
        if number and store.exists(jvm.org.apache.hadoop.fs.Path(place, "_SUCCESS")):
            found[int(number[1])] = place.toString()
    return found


def _delete(spark: SparkSession, folder: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _current(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """The last merged batch, and the folders that hold every part once."""
    generations = whole_folders(spark, f"{path}/merged", "upto")
    upto = max(generations, default=-1)
    later = [folder for batch, folder in sorted(whole_folders(spark, f"{path}/parts", "batch").items()) if batch > upto]
    return upto, [*([generations[upto]] if generations else []), *later]


def read_parts(spark: SparkSession, path: str, schema: T.StructType, dates: tuple[str, str] | None = None) -> DataFrame:
    """All stored parts, every one once; ``dates`` limits the bucket dates that are listed and read."""
    _, folders = _current(spark, path)
    if not folders:
        return spark.createDataFrame([], schema)
    parts = None
    for folder in folders:
        some = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket_date", T.DateType())])).parquet(folder)
        if dates is not None:
            some = some.filter(F.col("bucket_date").between(*dates))
        some = some.select(*schema.fieldNames())
        parts = some if parts is None else parts.unionByName(some)
    return parts


def part_schema(rows: T.StructType, rollup: Rollup, spark: SparkSession) -> T.StructType:
    """Schema of the parts that rows of a schema give."""
    return partial(spark.createDataFrame([], rows), rollup).schema


def read_rollup(
    spark: SparkSession, path: str, rows: T.StructType, rollup: Rollup, dates: tuple[str, str] | None = None
) -> DataFrame:
    """The rollup of everything stored; ``rows`` is the schema of the rows that went in."""
    parts = read_parts(spark, path, part_schema(rows, rollup, spark), dates)
    return finish(merge(parts, rollup), rollup)


def compact(spark: SparkSession, path: str, rows: T.StructType, rollup: Rollup) -> int:
    """Merge all stored parts into a new generation; gives the last batch in it, or -1.

    The generation counts once its commit marker is there, so a run that breaks off changes
    nothing and can be repeated. What the generation before it replaced is removed now, so
    readers that began before this run still find their files.
    """
    before, folders = _current(spark, path)
    batches = whole_folders(spark, f"{path}/parts", "batch")
    last = max([before, *batches])
    if last > before and folders:
        parts = read_parts(spark, path, part_schema(rows, rollup, spark))
        _write(merge(parts, rollup), rollup, f"{path}/merged/upto={last}")
        for number, folder in batches.items():
            if number <= before:
                _delete(spark, folder)
        for number, folder in whole_folders(spark, f"{path}/merged", "upto").items():
            if number < before:
                _delete(spark, folder)
    return last
