"""Reports on executions, dispatch, prices and convergence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP_KEYS = ("execution_id", "time_step", "target_datetime", "scenario_type")


def latest_rows(df: DataFrame, time: str, tie: str, n: int = 100) -> DataFrame:
    """The ``n`` newest rows; ``tie`` orders rows of the same time."""
    return df.orderBy(F.col(time).desc(), F.col(tie).desc()).limit(n)


def latest_executions(
    executions: DataFrame,
    topology: DataFrame,
    dispatch: DataFrame,
    n: int = 100,
    execution: str = "execution_id",
    time: str = "execution_time",
    topology_key: str = "topology_id",
    generator: str = "generator_id",
    case: str = "case_name",
) -> DataFrame:
    """The ``n`` newest executions with case name and number of units dispatched.

    The top-n is taken first. Its at most ``n`` rows are then broadcast to filter
    topology and dispatch, so the dispatch table is scanned once and not
    shuffled whole.
    """
    top = latest_rows(executions, time, execution, n)
    wanted = F.broadcast(top.select(execution).distinct())  # at most n rows
    units = (
        dispatch.select(execution, generator)
        .join(wanted, execution, "left_semi")
        .groupBy(execution)
        .agg(F.count_distinct(generator).alias("num_generators_dispatched"))
    )
    cases = topology.select(topology_key, case).join(
        F.broadcast(top.select(topology_key).distinct()), topology_key, "left_semi"
    )
    return (
        top.join(cases, topology_key, "left")
        .join(units, execution, "left")
        .withColumn(
            "num_generators_dispatched",
            F.coalesce("num_generators_dispatched", F.lit(0)),
        )
    )


def dispatch_summary(
    dispatch: DataFrame,
    keys: Sequence[str] = STEP_KEYS,
    power: str = "active_power_mw",
    cost: str = "generation_cost",
) -> DataFrame:
    return dispatch.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_generators"),
        F.sum(power).alias("total_generation_mw"),
        F.sum(cost).alias("total_generation_cost"),
        F.avg(power).alias("avg_generation_per_unit"),
    )


def lmp_statistics(
    bus_results: DataFrame, keys: Sequence[str] = STEP_KEYS, price: str = "lmp_total"
) -> DataFrame:
    return bus_results.groupBy(*keys).agg(
        F.avg(price).alias("avg_lmp"),
        F.min(price).alias("min_lmp"),
        F.max(price).alias("max_lmp"),
        F.stddev_samp(price).alias("lmp_std_dev"),
        (F.max(price) - F.min(price)).alias("lmp_spread"),
    )


def execution_report(
    executions: DataFrame,
    dispatch: DataFrame,
    execution: str = "execution_id",
    generator: str = "generator_id",
    power: str = "active_power_mw",
    cost: str = "generation_cost",
) -> DataFrame:
    """Units, energy and cost per execution; sums stay NULL without dispatch.

    Dispatch is reduced to one row per execution and unit, then per execution,
    before it meets the executions.
    """
    per_unit = dispatch.groupBy(execution, generator).agg(
        F.sum(power).alias("_mw"), F.sum(cost).alias("_cost")
    )
    per_run = per_unit.groupBy(execution).agg(
        F.count(generator).alias("num_generators"),
        F.sum("_mw").alias("total_generation_mw"),
        F.sum("_cost").alias("total_cost"),
    )
    return executions.join(per_run, execution, "left").withColumn(
        "num_generators", F.coalesce("num_generators", F.lit(0))
    )


def generation_by_step(
    dispatch: DataFrame,
    execution_id=None,
    execution: str = "execution_id",
    step: str = "time_step",
    power: str = "active_power_mw",
    cost: str = "generation_cost",
) -> DataFrame:
    """Total output and mean cost per step, of one execution or of all."""
    keys = [step]
    if execution_id is None:
        keys = [execution, step]
    else:
        dispatch = dispatch.filter(F.col(execution) == execution_id)
    return dispatch.groupBy(*keys).agg(
        F.sum(power).alias("total_generation"), F.avg(cost).alias("avg_cost")
    )


def results_per_execution(
    dispatch: DataFrame, execution: str = "execution_id", n: int = 5
) -> DataFrame:
    """Result rows of the ``n`` newest execution ids."""
    return (
        dispatch.groupBy(execution)
        .agg(F.count(F.lit(1)).alias("num_results"))
        .orderBy(F.col(execution).desc())
        .limit(n)
    )


def execution_rows(
    df: DataFrame, execution_id, order: Sequence[str], execution: str = "execution_id"
) -> DataFrame:
    """Rows of one execution in order."""
    return df.filter(F.col(execution) == execution_id).orderBy(*order)


def convergence_stats(
    history: DataFrame,
    execution: str = "execution_id",
    seconds: str = "iteration_time_seconds",
    residual: str = "primal_residual",
) -> DataFrame:
    return history.groupBy(execution).agg(
        F.avg(seconds).alias("avg_iter_time"), F.max(residual).alias("max_primal_res")
    )


def latest_history(
    history: DataFrame,
    executions: DataFrame,
    execution: str = "execution_id",
    time: str = "execution_time",
    iteration: str = "iteration",
) -> DataFrame:
    """Convergence curve of the newest execution."""
    newest = F.broadcast(latest_rows(executions, time, execution, 1).select(execution))
    return history.join(newest, execution, "left_semi").orderBy(iteration)


def price_matches(
    dispatch: DataFrame,
    bus_results: DataFrame,
    on: Sequence[str] = ("execution_id", "time_step"),
    power: str = "active_power_mw",
    price: str = "lmp_total",
) -> DataFrame:
    """Totals over all (dispatch row, bus row) pairs with the same keys.

    The keys name neither bus nor scenario, so each dispatch row matches every
    bus row of its step. Both sides are reduced first: the number of pairs is a
    product of counts and the sum of MW x price a product of sums, so the pairs
    themselves are never formed.
    """
    units = dispatch.groupBy(*on).agg(
        F.count(F.lit(1)).alias("_units"), F.sum(power).alias("_mw")
    )
    prices = bus_results.groupBy(*on).agg(
        F.count(F.lit(1)).alias("_buses"),
        F.sum(price).alias("_price"),
        F.min(price).alias("min_lmp"),
        F.max(price).alias("max_lmp"),
    )
    return units.join(prices, list(on)).select(
        *on,
        (F.col("_units") * F.col("_buses")).alias("pairs"),
        (F.col("_mw") * F.col("_price")).alias("mw_price_sum"),
        (F.col("_price") * F.col("_units")).alias("price_sum"),
        "min_lmp",
        "max_lmp",
    )


def dispatch_with_price(
    dispatch: DataFrame,
    bus_results: DataFrame,
    on: Sequence[str] = ("execution_id", "time_step", "scenario_type", "bus_id"),
    price: str = "lmp_total",
) -> DataFrame:
    """Dispatch rows with the price at their own bus and in their own scenario."""
    prices = bus_results.groupBy(*on).agg(F.avg(price).alias(price))
    return dispatch.join(prices, list(on))
