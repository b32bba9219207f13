"""Declarative quality rules, evaluated together in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.operators.ordered import with_previous


@dataclass(frozen=True)
class Rule:
    """One rule on a column. ``mostly`` is the share of evaluated rows that must
    hold; NULL values are not evaluated (except by ``not_null``)."""

    kind: str
    column: str
    mostly: float = 1.0
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    other: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column}{',' + self.other if self.other else ''})"


def between(column: str, low: float, high: float, mostly: float = 1.0) -> Rule:
    """Value in the closed range."""
    return Rule("between", column, mostly, low=low, high=high)


def not_null(column: str) -> Rule:
    return Rule("not_null", column)


def in_set(column: str, values: Sequence, mostly: float = 1.0) -> Rule:
    """Value is one of the listed ones; NULL is never judged."""
    return Rule("in_set", column, mostly, values=tuple(v for v in values if v is not None))


def increasing(column: str) -> Rule:
    """Value not below the previous row's, per entity in arrival order."""
    return Rule("increasing", column)


def at_least(column: str, other: str, mostly: float = 1.0) -> Rule:
    """``column`` >= ``other``; judged where both are present."""
    return Rule("at_least", column, mostly, other=other)


# The rule suites of the measurement tables.
POWER_SUITE = [
    between("voltage_magnitude", 0.85, 1.15, 0.98),
    between("voltage_angle_rad", -3.15, 3.15),
    between("frequency_hz", 59.5, 60.5, 0.999),
    not_null("bus_id"),
    not_null("voltage_magnitude"),
    not_null("active_power_mw"),
    between("measurement_quality", 80, 100, 0.95),
    increasing("time"),
]
GENERATOR_SUITE = [
    between("active_power_mw", 0, 10000, 0.98),
    in_set("commitment_status", [True, False, None]),
    in_set("generator_type", ["THERMAL", "HYDRO", "WIND", "SOLAR", "STORAGE", "NUCLEAR"]),
    between("marginal_cost", 0, 1000, 0.95),
]
BRANCH_SUITE = [
    between("loading_percentage", 0, 120, 0.99),
    at_least("from_bus_active_power_mw", "to_bus_active_power_mw", 0.5),
]
STRICT_POWER_SUITE = [
    between("voltage_magnitude", 0.95, 1.05, 0.98),
    between("power_factor", -1.0, 1.0),
    between("frequency_hz", 59.5, 60.5),
    not_null("active_power_mw"),
]


def row_predicate(rule: Rule) -> Column:
    """Whether a row satisfies the rule; NULL where it is not evaluated."""
    c = F.col(rule.column)
    if rule.kind == "between":
        return c.between(rule.low, rule.high)
    if rule.kind == "not_null":
        return c.isNotNull()
    if rule.kind == "in_set":
        return c.isin(*rule.values)
    if rule.kind == "at_least":
        return c >= F.col(rule.other)
    if rule.kind == "increasing":
        return c >= F.col(f"_prev_{rule.column}")
    raise ValueError(f"unknown rule kind {rule.kind!r}")


@dataclass(frozen=True)
class Arrival:
    """How rows of an entity follow each other, for ``increasing`` rules.

    ``extra`` names columns the bucket uses beyond the entity and the order.
    """

    entity: Sequence[str]
    order: Sequence[str]
    bucket: Column = field(compare=False)
    extra: Sequence[str] = ()


def run_suite(
    df: DataFrame,
    rules: Sequence[Rule],
    by: Sequence[str] = (),
    arrival: Arrival | None = None,
) -> DataFrame:
    """One row per rule (and group): evaluated, unexpected, share, success.

    All rules that judge single rows are computed in one aggregate over the
    table, without moving a row. ``increasing`` rules need the rows in order;
    they run apart, on no more than the columns they use.
    """
    single = [r for r in rules if r.kind != "increasing"]
    sequence = [r for r in rules if r.kind == "increasing"]
    reports = [_report(df, single, by)] if single else []
    if sequence:
        if arrival is None:
            raise ValueError("an increasing rule needs the arrival order")
        ordered = sorted({r.column for r in sequence})
        used = [*by, *arrival.entity, *arrival.order, *arrival.extra, *ordered]
        stepped = with_previous(
            df.select(*dict.fromkeys(used)),
            arrival.entity,
            arrival.order,
            ordered,
            arrival.bucket,
            prefix="_prev_",
        )
        reports.append(_report(stepped, sequence, by))
    report = reports[0] if len(reports) == 1 else reports[0].unionByName(reports[1])
    share = F.when(F.col("evaluated") > 0, 1 - F.col("unexpected") / F.col("evaluated"))
    return report.withColumn("share", share).withColumn(
        "success",
        (F.col("evaluated") == 0)
        | (F.col("evaluated") - F.col("unexpected") >= F.col("mostly") * F.col("evaluated")),
    )


def _report(df: DataFrame, rules: Sequence[Rule], by: Sequence[str]) -> DataFrame:
    """Counts of evaluated and unexpected rows per rule, from one aggregate."""
    measures = []
    for i, rule in enumerate(rules):
        holds = row_predicate(rule)
        if rule.kind == "increasing":
            # The first row of an entity has no predecessor and holds.
            holds = F.coalesce(holds, F.when(F.col(rule.column).isNotNull(), F.lit(True)))
        measures.append(F.count(holds).alias(f"_evaluated_{i}"))
        measures.append(F.count_if(~holds).alias(f"_unexpected_{i}"))
    totals = df.groupBy(*by).agg(*measures)
    rows = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.kind).alias("kind"),
                F.lit(rule.column).alias("column_name"),
                F.lit(float(rule.mostly)).alias("mostly"),
                F.col(f"_evaluated_{i}").alias("evaluated"),
                F.col(f"_unexpected_{i}").alias("unexpected"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return totals.select(*by, F.inline(rows))


def suite_summary(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Overall success and rule counts per group."""
    return report.groupBy(*by).agg(
        F.count(F.lit(1)).alias("evaluated_rules"),
        F.count_if("success").alias("successful_rules"),
        F.count_if(~F.col("success")).alias("failed_rules"),
        F.min("success").alias("success"),
    )


# Which kind of quality a rule speaks about.
METRIC_TYPES = {
    "not_null": "COMPLETENESS",
    "between": "VALIDITY",
    "in_set": "VALIDITY",
    "increasing": "CONSISTENCY",
    "at_least": "CONSISTENCY",
}


def metric_rows(report: DataFrame, table: str, check_time: Column) -> DataFrame:
    """Report rows in the form of the quality metrics table.

    A rule that holds overall in spite of some bad rows is a warning.
    """
    metric_type = F.try_element_at(
        F.create_map(*[F.lit(x) for item in METRIC_TYPES.items() for x in item]), F.col("kind")
    )
    verdict = (
        F.when(~F.col("success"), "FAIL").when(F.col("unexpected") > 0, "WARNING").otherwise("PASS")
    )
    return report.select(
        check_time.alias("check_time"),
        F.lit(table).alias("table_name"),
        metric_type.alias("metric_type"),
        F.col("rule").alias("metric_name"),
        F.col("share").alias("metric_value"),
        verdict.alias("pass_fail"),
        F.to_json(F.struct("evaluated", "unexpected", "mostly")).alias("details"),
        F.col("unexpected").alias("affected_records"),
    )


def split_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``valid``: the row breaks none of the rules. Works on streams."""
    valid = F.lit(True)
    for rule in rules:
        if rule.kind == "increasing":
            raise ValueError("an increasing rule cannot be judged on one row")
        valid = valid & F.coalesce(row_predicate(rule), F.lit(True))
    return df.withColumn("valid", valid)


def apply_gate(df: DataFrame, rules: Sequence[Rule], action: str = "warn", **suite) -> DataFrame:
    """Soft gate before a load.

    ``warn`` passes the rows on, ``quarantine`` passes only the rows that break
    no rule, ``fail`` raises if the suite does not hold.
    """
    if action == "warn":
        return df
    if action == "quarantine":
        return split_rows(df, rules).filter("valid").drop("valid")
    if action == "fail":
        if not suite_summary(run_suite(df, rules, **suite)).head().success:
            raise ValueError("quality suite failed")
        return df
    raise ValueError(f"unknown action {action!r}")


def case_verdict(
    cases: DataFrame,
    power_report: DataFrame,
    generator_report: DataFrame,
    coverage: DataFrame | None = None,
    case: str = "case_name",
) -> DataFrame:
    """Verdict per case from the reports of both measurement tables by case.

    No power rows fail a case; no generator rows have no effect.
    """
    power = power_report.groupBy(case).agg(F.min("success").alias("power_ok"))
    generators = generator_report.groupBy(case).agg(F.min("success").alias("generator_ok"))
    verdict = (
        cases.select(case)
        .distinct()
        .join(power, case, "left")
        .join(generators, case, "left")
        .withColumn(
            "reason",
            F.when(F.col("power_ok").isNull(), "no power data")
            .when(~F.col("power_ok"), "power rules failed")
            .when(~F.coalesce("generator_ok", F.lit(True)), "generator rules failed"),
        )
        .withColumn("success", F.col("reason").isNull())
    )
    return verdict if coverage is None else verdict.join(coverage, case, "left")


def verdict_totals(verdict: DataFrame) -> DataFrame:
    """Number of cases, passed and failed."""
    return verdict.agg(
        F.count(F.lit(1)).alias("total_cases"),
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
    )


def result_gate(
    requested: DataFrame,
    executions: DataFrame,
    dispatch: DataFrame,
    execution: str = "execution_id",
    status: str = "convergence_status",
    converged: str = "CONVERGED",
) -> DataFrame:
    """Whether each requested execution may be reported, and why not.

    Dispatch rows are counted before the join, so one huge run is no hot key.
    """
    counted = dispatch.groupBy(execution).agg(F.count(F.lit(1)).alias("dispatch_rows"))
    found = executions.select(execution, F.col(status).alias("_status"), F.lit(True).alias("_found"))
    return (
        requested.select(execution)
        .distinct()
        .join(found, execution, "left")
        .join(counted, execution, "left")
        .withColumn("dispatch_rows", F.coalesce("dispatch_rows", F.lit(0)))
        .withColumn(
            "reason",
            F.when(F.col("_found").isNull(), "execution not found")
            .when(~F.col("_status").eqNullSafe(converged), "not converged")
            .when(F.col("dispatch_rows") == 0, "no dispatch results"),
        )
        .withColumn("success", F.col("reason").isNull())
        .drop("_status", "_found")
    )
