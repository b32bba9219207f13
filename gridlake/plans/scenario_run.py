"""Scenario study tables: valid topology, series, dispatch, status, results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import documents, joins, scenarios
from gridlake.sinks import once
from gridlake.sinks import tables as sinks

CASE = ("case_name",)


@dataclass(frozen=True)
class Study:
    """Tables of one run over any number of cases."""

    base: DataFrame
    changes: DataFrame
    totals: DataFrame
    residuals: DataFrame
    objective: DataFrame


def study(
    topology: DataFrame, contingencies: DataFrame, as_of: Column, steps: int = 24
) -> Study:
    """Dispatch tables for the versions valid at ``as_of``.

    ``contingencies`` carries ``case_name``. Scenario rows are the changes
    against the base case; see :mod:`gridlake.operators.scenarios`.
    """
    newest = joins.as_of_version(
        topology.select("case_name", "valid_from", "valid_until", "topology_id").distinct(), as_of
    )
    valid = topology.join(newest.select("case_name", "topology_id", "valid_from"),
                          ["case_name", "topology_id", "valid_from"], "left_semi")
    units = documents.document_generators(valid).filter(F.col("type") == "THERMAL")
    base = scenarios.base_dispatch(units, steps, keep=CASE)
    hit = scenarios.outages(contingencies, units, case=CASE)
    changes = scenarios.scenario_changes(base, hit, case=CASE, keep_base=True)
    names = contingencies.select(*CASE, F.col("contingency_name").alias("scenario_type")).unionByName(
        units.select(*CASE).distinct().withColumn("scenario_type", F.lit(scenarios.BASE))
    )
    totals = scenarios.scenario_totals(base, changes, names, steps, CASE)
    weighted = totals.withColumnRenamed("total_generation_cost", "generation_cost")
    return Study(
        base=base,
        changes=changes,
        totals=totals,
        residuals=scenarios.residuals(base, by=CASE),
        objective=scenarios.objective(weighted, by=CASE),
    )


def save_study(result: Study, execution_id: str, warehouse: str) -> None:
    """Append base rows and scenario changes, tagged with the execution id."""
    rows = result.base.unionByName(result.changes.drop("base_power_mw", "base_cost"))
    sinks.append_results(
        sinks.tag_results(rows, execution_id),
        schemas.DISPATCH_RESULTS,
        f"{warehouse}/generator_dispatch_results",
    )


def save_study_once(result: Study, execution_id: str, path: str) -> bool:
    """As :func:`save_study`, in a table of repeatable appends at ``path``: an execution that
    is stored is not added again. Says whether it was; :func:`stored_studies` reads it."""
    rows = result.base.unionByName(result.changes.drop("base_power_mw", "base_cost"))
    return once.append_once(
        sinks.tag_results(rows, execution_id), path, execution_id, schemas.DISPATCH_RESULTS
    )


def stored_studies(spark: SparkSession, path: str) -> DataFrame:
    """Dispatch rows of all executions stored by :func:`save_study_once`."""
    return once.read_once(spark, path, schemas.DISPATCH_RESULTS)
