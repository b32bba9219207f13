"""Daily checks: input quality of the last day, result gate, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from gridlake.operators import quality, reports, rollups


def input_quality(
    power: DataFrame,
    generators: DataFrame,
    as_of: Column,
    arrival: quality.Arrival,
    branches: DataFrame | None = None,
    hours: int = 24,
    by: tuple[str, ...] = ("case_name",),
) -> DataFrame:
    """Metric rows of all suites over the last ``hours``; failures do not stop."""
    parts = [
        ("power_measurements", power, quality.POWER_SUITE),
        ("generator_measurements", generators, quality.GENERATOR_SUITE),
    ]
    if branches is not None:
        parts.append(("branch_measurements", branches, quality.BRANCH_SUITE))
    metrics = None
    for table, df, suite in parts:
        report = quality.run_suite(rollups.since(df, as_of, hours), suite, by, arrival)
        rows = quality.metric_rows(report, table, as_of)
        metrics = rows if metrics is None else metrics.unionByName(rows)
    return metrics


def case_report(
    topology: DataFrame, power: DataFrame, generators: DataFrame, as_of: Column,
    arrival: quality.Arrival, days: int = 7,
) -> DataFrame:
    """Verdict and coverage per case from the last ``days`` of measurements."""
    by = ("case_name",)
    return quality.case_verdict(
        topology,
        quality.run_suite(rollups.since(power, as_of, days * 24), quality.POWER_SUITE, by, arrival),
        quality.run_suite(rollups.since(generators, as_of, days * 24), quality.GENERATOR_SUITE, by),
        rollups.coverage(power),
    )


def gated_report(requested: DataFrame, executions: DataFrame, dispatch: DataFrame) -> DataFrame:
    """Execution report with the gate's verdict beside it."""
    gate = quality.result_gate(requested, executions, dispatch)
    return reports.execution_report(
        executions.join(gate.select("execution_id", "success", "reason"), "execution_id"), dispatch
    )
