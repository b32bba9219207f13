"""Columns the tables declare, computed: errors, ramps, limits, gaps, parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalars import power_factor
from gridlake.operators.ordered import (
    number_bucket,
    spread_ranges,
    with_previous,
    with_running_sum,
)


def forecast_error(
    df: DataFrame, actual: str = "active_power_mw", forecast: str = "forecasted_active_power_mw"
) -> DataFrame:
    return df.withColumn("forecast_error_mw", F.col(actual) - F.col(forecast))


def _seconds_between(start: Column, end: Column) -> Column:
    """Exact to the microsecond: the difference is taken on whole numbers."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)


def _hours_between(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(3600e6)


def ramp_rates(
    df: DataFrame,
    entity: Sequence[str] = ("generator_id",),
    time: str = "time",
    power: str = "active_power_mw",
    order: Sequence[str] | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Change of output per hour since the unit's previous row. Without a ``bucket`` the rows
    are cut into days, and days of many rows into ranges."""
    if bucket is None:
        df, bucket = spread_ranges(df, entity, time)
    stepped = with_previous(df, entity, order or [time], [time, power], bucket).drop("_range")
    hours = _hours_between(F.col(f"prev_{time}"), F.col(time))
    return stepped.withColumn(
        "ramp_rate_actual",
        F.when(hours > 0, (F.col(power) - F.col(f"prev_{power}")) / hours),
    ).drop(f"prev_{time}", f"prev_{power}")


def previous_output(
    df: DataFrame,
    entity: Sequence[str] = ("generator_id",),
    order: Sequence[str] = ("time_step",),
    power: str = "active_power_mw",
    bucket: Column | None = None,
) -> DataFrame:
    """Output of the unit's previous step; 0 at the first."""
    cell = number_bucket(order[0]) if bucket is None else bucket
    return with_previous(df, entity, order, [power], cell).withColumn(
        f"prev_{power}", F.coalesce(F.col(f"prev_{power}"), F.lit(0.0))
    )


def cumulative_time(
    history: DataFrame,
    execution: Sequence[str] = ("execution_id",),
    order: Sequence[str] = ("iteration",),
    seconds: str = "iteration_time_seconds",
    bucket: Column | None = None,
) -> DataFrame:
    """Running solve time per execution."""
    cell = number_bucket(order[0]) if bucket is None else bucket
    return with_running_sum(history, execution, order, seconds, cell, "cumulative_time_seconds")


def limit_flags(
    dispatch: DataFrame,
    power: str = "active_power_mw",
    pmin: str = "pmin",
    pmax: str = "pmax",
    tolerance: float = 1e-6,
) -> DataFrame:
    """Whether the unit runs at its lower or upper limit."""
    p = F.col(power)
    return dispatch.withColumn("at_pmin", p <= F.col(pmin) + tolerance).withColumn(
        "at_pmax", p >= F.col(pmax) - tolerance
    )


def ramp_flags(
    dispatch: DataFrame,
    entity: Sequence[str] = ("generator_id",),
    order: Sequence[str] = ("time_step",),
    power: str = "active_power_mw",
    limit: str = "ramp_up",
    bucket: Column | None = None,
    tolerance: float = 1e-6,
) -> DataFrame:
    """Whether the step's change uses up the unit's ramp limit."""
    cell = number_bucket(order[0]) if bucket is None else bucket
    stepped = with_previous(dispatch, entity, order, [power], cell)
    change = F.abs(F.col(power) - F.col(f"prev_{power}"))
    return stepped.withColumn(
        "ramp_limited", F.coalesce(change >= F.col(limit) - tolerance, F.lit(False))
    ).drop(f"prev_{power}")


def net_injection(
    generation: DataFrame,
    demand: DataFrame,
    keys: Sequence[str] = ("bus_id", "time_step"),
    power: str = "active_power_mw",
) -> DataFrame:
    """Generation minus demand per bus and step.

    Both tables go into one aggregation as signed rows, so there is no join.
    """
    signed = generation.select(*keys, F.col(power).alias("_mw")).unionByName(
        demand.select(*keys, (-F.col(power)).alias("_mw"))
    )
    return signed.groupBy(*keys).agg(F.sum("_mw").alias("net_injection_mw"))


def price_parts(
    bus_results: DataFrame,
    parts: Sequence[str] = ("lmp_energy", "lmp_congestion", "lmp_loss"),
    total: str = "lmp_total",
    tolerance: float = 1e-6,
) -> DataFrame:
    """Whether energy, congestion and loss add up to the total price."""
    sum_of_parts = F.lit(0.0)
    for p in parts:
        sum_of_parts = sum_of_parts + F.col(p)
    gap = F.col(total) - sum_of_parts
    return bus_results.withColumn("lmp_gap", gap).withColumn(
        "lmp_consistent", F.abs(gap) <= tolerance
    )


def flow_limits(flows: DataFrame, loading: str = "loading_percentage") -> DataFrame:
    return flows.withColumn("flow_constrained", F.col(loading) >= 100)


def line_losses(
    flows: DataFrame,
    from_power: str = "from_bus_active_power_mw",
    to_power: str = "to_bus_active_power_mw",
    limit: float = 1.0,
) -> DataFrame:
    """Loss on the line and whether it is small."""
    loss = F.abs(F.col(from_power) + F.col(to_power))
    return flows.withColumn("line_loss_mw", loss).withColumn("loss_small", loss <= limit)


def future_rows(df: DataFrame, as_of: Column, time: str = "time") -> DataFrame:
    """Rows stamped later than ``as_of``."""
    return df.filter(F.col(time) > as_of)


def gap_report(
    df: DataFrame,
    entity: Sequence[str] = ("bus_id",),
    time: str = "time",
    order: Sequence[str] | None = None,
    max_gap_hours: float = 1.0,
    min_hours: float = 24.0,
    min_rows: int = 24,
    bucket: Column | None = None,
) -> DataFrame:
    """Rows, span, widest gap and gaps above the limit per entity."""
    rows = df.select(*entity, *dict.fromkeys([time, *(order or [])]))
    if bucket is None:
        rows, bucket = spread_ranges(rows, entity, time)
    stepped = with_previous(rows, entity, order or [time], [time], bucket)
    gap = _hours_between(F.col(f"prev_{time}"), F.col(time))
    report = stepped.groupBy(*entity).agg(
        F.count(F.lit(1)).alias("rows"),
        _hours_between(F.min(time), F.max(time)).alias("span_hours"),
        F.max(gap).alias("widest_gap_hours"),
        F.count_if(gap > max_gap_hours).alias("large_gaps"),
    )
    return report.withColumn(
        "sufficient",
        (F.col("rows") >= min_rows)
        & (F.col("span_hours") >= min_hours)
        & (F.col("large_gaps") == 0),
    )


def latest_forecast(
    forecasts: DataFrame,
    keys: Sequence[str] = ("generator_id", "target_time"),
    issued: str = "forecast_time",
    target: str = "target_time",
) -> DataFrame:
    """Newest forecast issued not later than its target, per target."""
    rest = [c for c in forecasts.columns if c not in keys]
    return (
        forecasts.filter(F.col(issued) <= F.col(target))
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(issued, *[c for c in rest if c != issued])).alias("_f"))
        .select(*keys, *[F.col(f"_f.{c}").alias(c) for c in rest])
    )


def forecast_match(
    forecasts: DataFrame,
    actuals: DataFrame,
    entity: str = "generator_id",
    power: str = "active_power_mw",
) -> DataFrame:
    """Latest forecast beside the actual value, with error and band check."""
    newest = latest_forecast(forecasts)
    actual = actuals.select(
        entity, F.col("time").alias("target_time"), F.col(power).alias("actual_mw")
    )
    error = F.col("actual_mw") - F.col("forecasted_power_mw")
    return newest.join(actual, [entity, "target_time"]).withColumns(
        {
            "forecast_error_mw": error,
            "in_band": F.col("actual_mw").between(
                F.col("confidence_lower_mw"), F.col("confidence_upper_mw")
            ),
            "horizon_hours": _hours_between(F.col("forecast_time"), F.col("target_time")),
        }
    )


def task_durations(
    logs: DataFrame,
    by: Sequence[str] = ("pipeline_name", "status"),
    start: str = "start_time",
    end: str = "end_time",
) -> DataFrame:
    seconds = _seconds_between(F.col(start), F.col(end))
    return logs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg(seconds).alias("avg_seconds"),
        F.max(seconds).alias("max_seconds"),
    )


def with_power_factor(
    df: DataFrame, active: str = "active_power_mw", reactive: str = "reactive_power_mvar"
) -> DataFrame:
    return df.withColumn("power_factor", power_factor(F.col(active), F.col(reactive)))
