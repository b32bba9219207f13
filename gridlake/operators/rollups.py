"""Rollups of measurements: time buckets, coverage, recent means, series arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.operators.ordered import spread_ranges, with_position


def since(df: DataFrame, as_of: Column, hours: int, time: str = "time") -> DataFrame:
    """Rows not older than ``hours`` at ``as_of``."""
    start = as_of - F.make_dt_interval(F.lit(0), F.lit(hours))
    return df.filter(F.col(time) >= start)


def range_scan(
    df: DataFrame,
    case: str,
    start: Column,
    end: Column,
    columns: Sequence[str],
    entity: str,
    time: str = "time",
    case_column: str = "case_name",
) -> DataFrame:
    """Rows of a case in a closed time range, sorted by time and entity."""
    return (
        df.filter((F.col(case_column) == case) & F.col(time).between(start, end))
        .select(*columns)
        .orderBy(time, entity)
    )


def hourly_rollup(
    df: DataFrame,
    keys: Sequence[str] = ("bus_id", "case_name"),
    time: str = "time",
    voltage: str = "voltage_magnitude",
    active: str = "active_power_mw",
    reactive: str = "reactive_power_mvar",
    width: str = "1 hour",
) -> DataFrame:
    """Averages and voltage extremes per hour and bus; works on streams."""
    return (
        df.groupBy(F.window(time, width).alias("_w"), *keys)
        .agg(
            F.avg(voltage).alias("avg_voltage"),
            F.avg(active).alias("avg_active_power"),
            F.avg(reactive).alias("avg_reactive_power"),
            F.min(voltage).alias("min_voltage"),
            F.max(voltage).alias("max_voltage"),
            F.count(F.lit(1)).alias("measurement_count"),
        )
        .withColumn("bucket", F.col("_w.start"))
        .drop("_w")
    )


def daily_stats(
    df: DataFrame,
    keys: Sequence[str] = ("generator_id", "generator_type", "case_name"),
    time: str = "time",
    power: str = "active_power_mw",
    cost: str = "marginal_cost",
    hours_per_row: Column | None = None,
) -> DataFrame:
    """Daily generation per unit. Energy assumes hourly rows unless
    ``hours_per_row`` gives the time each row stands for."""
    energy = F.col(power) if hours_per_row is None else F.col(power) * hours_per_row
    return (
        df.groupBy(F.window(time, "1 day").alias("_w"), *keys)
        .agg(
            F.avg(power).alias("avg_generation"),
            F.max(power).alias("peak_generation"),
            F.sum(energy).alias("total_generation_mwh"),
            F.avg(cost).alias("avg_marginal_cost"),
        )
        .withColumn("day", F.col("_w.start"))
        .drop("_w")
    )


def coverage(df: DataFrame, by: Sequence[str] = ("case_name",), time: str = "time") -> DataFrame:
    """First and last time, days with data and rows.

    Days are counted from daily partial counts, so a hot case is combined on the
    map side before its rows are shuffled.
    """
    daily = df.groupBy(*by, F.to_date(time).alias("_day")).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    return daily.groupBy(*by).agg(
        F.min("_first").alias("earliest"),
        F.max("_last").alias("latest"),
        F.count("_day").alias("days_covered"),
        F.sum("_n").alias("total_measurements"),
    )


def recent_mean(
    df: DataFrame,
    as_of: Column,
    hours: int,
    value: str,
    by: Sequence[str] = ("case_name",),
    time: str = "time",
) -> DataFrame:
    return since(df, as_of, hours, time).groupBy(*by).agg(F.avg(value).alias("avg_generation"))


def row_counts(df: DataFrame, by: Sequence[str], output: str = "rows") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(output))


def cumulative_histogram(
    df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Rows at or below each bound, in one pass; the last bound is +inf."""
    counts = [F.count_if(F.col(value) <= b).alias(f"_le_{i}") for i, b in enumerate(bounds)]
    totals = df.groupBy(*by).agg(*counts, F.count(value).alias("_all"))
    rows = [
        F.struct(F.lit(str(b)).alias("le"), F.col(f"_le_{i}").alias("n"))
        for i, b in enumerate(bounds)
    ]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("_all").alias("n")))
    return totals.select(*by, F.inline(F.array(*rows)))


def converged_gauge(
    executions: DataFrame,
    by: Sequence[str],
    time: str = "execution_time",
    status: str = "convergence_status",
    converged: str = "CONVERGED",
    tie: str = "execution_id",
) -> DataFrame:
    """1 where the newest execution converged, else 0."""
    newest = F.max_by(F.col(status), F.struct(time, tie))
    return executions.groupBy(*by).agg(
        F.when(newest == converged, 1).otherwise(0).alias("converged")
    )


def series_arrays(
    df: DataFrame,
    entity: str,
    time: str = "time",
    value: str = "active_power_mw",
    chunk_rows: int = 8760,
    bucket: Column | None = None,
) -> DataFrame:
    """Series per entity as time-ordered arrays, cut into numbered chunks.

    A chunk holds at most ``chunk_rows`` values, so a long or hot series is
    several bounded rows instead of one unbounded one; a year of hourly values
    is exactly one chunk.
    """
    rows = df.select(entity, time, value)
    if bucket is None:
        rows, bucket = spread_ranges(rows, [entity], time)
    placed = with_position(rows, [entity], [time, value], bucket)
    point = F.struct(F.col("position"), F.col(time).alias("time"), F.col(value).alias("value"))
    return (
        placed.withColumn("chunk_no", F.floor(F.col("position") / F.lit(chunk_rows)))
        .groupBy(entity, "chunk_no")
        .agg(F.array_sort(F.collect_list(point)).alias("_points"))
        .select(
            entity,
            "chunk_no",
            F.transform("_points", lambda p: p["time"]).alias("times"),
            F.transform("_points", lambda p: p["value"]).alias("values"),
        )
    )


def ordered_sample(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """The first ``rows`` rows by ``order``: a repeatable sample."""
    return df.orderBy(*order).limit(rows)
