"""Versioned tables: closing the version before, and the version valid at a row's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def close_versions(
    versions: DataFrame,
    case: str = "case_name",
    valid_from: str = "valid_from",
    valid_until: str = "valid_until",
    tie: str = "topology_id",
) -> DataFrame:
    """Each version ends where the case's next one begins, or earlier if it says so.

    Of versions that begin together the one with the largest ``tie`` is valid; the others
    end at once. On load, close the stored versions together with the new ones. A case is
    sorted in one task: it has a row per load of the case, not per measurement.
    """
    following = F.lead(valid_from).over(Window.partitionBy(case).orderBy(valid_from, tie))
    return versions.withColumn(valid_until, F.least(valid_until, following))


def with_valid_version(
    rows: DataFrame,
    versions: DataFrame,
    time: str = "time",
    case: str = "case_name",
    valid_from: str = "valid_from",
    valid_until: str = "valid_until",
    tie: str = "topology_id",
    keep: Sequence[str] = ("topology_id",),
) -> DataFrame:
    """Every row with the ``keep`` columns of its case's version valid at its time.

    Valid is ``valid_from <= time < valid_until`` after :func:`close_versions`; a row without
    such a version, without a time or without a case has nulls. Versions without a
    beginning or a case never count.

    Days are the blocks of an equi-join: a case's day has one lookup row, holding the version
    valid at midnight and those that begin that day. No row meets versions of other days,
    and a hot case is many join keys.
    """
    clash = set(keep) & set(rows.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    dated = versions.filter(F.col(valid_from).isNotNull() & F.col(case).isNotNull())
    closed = close_versions(dated, case, valid_from, valid_until, tie)
    version = F.struct(
        F.col(valid_from).alias("begin"),
        F.col(valid_until).alias("end"),
        F.struct(*[F.col(c) for c in keep]).alias("kept"),
    )
    starts = closed.select(
        F.col(case).alias("_case"), F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"), version.alias("_version")
    )
    days = rows.select(F.col(case).alias("_case"), F.to_date(time).alias("_day")).distinct().dropna()
    moment = versions.schema[valid_from].dataType
    marks = days.select(
        "_case",
        F.col("_day").cast(moment).alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(starts.schema["_version"].dataType).alias("_version"),
    )
    # A version that begins at midnight sorts before the mark of its day.
    so_far = Window.partitionBy("_case").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    at_midnight = (
        starts.unionByName(marks)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
        .filter(F.col("_kind") == 1)
        .select("_case", F.to_date("_at").alias("_day"), F.col("_version").alias("_carried"))
    )
    begun = starts.groupBy("_case", F.to_date("_at").alias("_day")).agg(F.collect_list("_version").alias("_begun"))
    lookup = at_midnight.join(begun, ["_case", "_day"], "left").select(
        "_case",
        "_day",
        F.array_compact(F.concat(F.array("_carried"), F.coalesce("_begun", F.array()))).alias("_versions"),
    )
    found = rows.withColumns({"_case": F.col(case), "_day": F.to_date(time)}).join(lookup, ["_case", "_day"], "left")
    now = F.col(time)
    valid = F.filter(
        "_versions", lambda v: (v["begin"] <= now) & (v["end"].isNull() | (now < v["end"]))
    )
    kept = F.get(valid, F.lit(0))["kept"]
    return found.select(*rows.columns, *[kept[c].alias(c) for c in keep])
