"""Outage scenarios: contingencies, dispatch tables, residuals, convergence.

A study has as many scenarios as components, and a scenario differs from the base
case only in the few units it takes out. Scenario dispatch is therefore kept as
the base rows plus the rows each scenario changes; totals are computed from these
two tables, and the full rows of chosen scenarios are made on demand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.operators.joins import affected_elements, spread_join
from gridlake.operators.series import each_step

# Probability and severity of single outages, the capacity above
# which a unit counts as large, the weight of a contingency's cost, and the
# share of the primal residual taken as dual residual.
BRANCH_PROBABILITY, BRANCH_SEVERITY = 0.01, 2
UNIT_PROBABILITY, UNIT_SEVERITY = 0.005, 3
LARGE_UNIT_MW = 100.0
CONTINGENCY_WEIGHT = 0.01
DUAL_SHARE = 0.1

BASE = "BASE"


def n1_contingencies(
    branches: DataFrame,
    generators: DataFrame,
    min_pmax: float | None = None,
    name: str = "name",
    pmax: str = "pmax",
    keep: Sequence[str] = ("topology_id",),
    with_capacity: bool = False,
) -> DataFrame:
    """One contingency per branch and per unit (above ``min_pmax`` if given).

    ``with_capacity`` ends a unit's text in its capacity, as the RTS loader does.
    """

    def single(df: DataFrame, column: str, what: str, probability: float, severity: int, end=None):
        element = F.col(name).cast("string")
        text = [F.lit(f"Single {what} outage: "), element, *([end] if end is not None else [])]
        return df.select(
            *keep,
            F.concat(F.lit("N-1_"), element).alias("contingency_name"),
            F.lit("N-1").alias("contingency_type"),
            F.array(element).alias(column),
            F.lit(probability).alias("probability"),
            F.lit(severity).alias("severity_level"),
            F.concat(*text).alias("description"),
        )

    units = generators if min_pmax is None else generators.filter(F.col(pmax) > min_pmax)
    return single(
        branches, "affected_branches", "branch", BRANCH_PROBABILITY, BRANCH_SEVERITY
    ).unionByName(
        single(
            units, "affected_generators", "generator", UNIT_PROBABILITY, UNIT_SEVERITY,
            F.concat(F.lit(" ("), F.col(pmax).cast("string"), F.lit(" MW)")) if with_capacity else None,
        ),
        allowMissingColumns=True,
    )


def contingency_order(contingencies: DataFrame, tie: str = "contingency_name") -> DataFrame:
    """Most severe and most probable first."""
    return contingencies.orderBy(
        F.col("severity_level").desc(), F.col("probability").desc(), F.col(tie)
    )


def contingency_counts(
    contingencies: DataFrame, by: Sequence[str], topology: DataFrame | None = None
) -> DataFrame:
    """Contingencies per group; with ``topology`` the case name can be a key.

    Counts are formed per topology first and then named.
    """
    if topology is None:
        return contingencies.groupBy(*by).agg(F.count(F.lit(1)).alias("contingencies"))
    own = [c for c in by if c in contingencies.columns and c != "topology_id"]
    per_topology = contingencies.groupBy("topology_id", *own).agg(
        F.count(F.lit(1)).alias("_n")
    )
    names = topology.select("topology_id", *[c for c in by if c not in own and c != "topology_id"])
    return (
        per_topology.join(names, "topology_id")
        .groupBy(*by)
        .agg(F.sum("_n").alias("contingencies"))
    )


def midpoint(pmin: str = "pmin", pmax: str = "pmax") -> Column:
    return (F.col(pmin) + F.col(pmax)) / 2


def base_dispatch(
    generators: DataFrame,
    steps: int,
    keep: Sequence[str] = (),
    name: str = "name",
    pmin: str = "pmin",
    pmax: str = "pmax",
    cost: Column | None = None,
) -> DataFrame:
    """Base rows: every unit and step at the middle of its range, cost 0.

    ``cost`` may price the output from the unit's curve instead.
    """
    power = midpoint(pmin, pmax)
    return each_step(generators, steps, "time_step", 1).select(
        *keep,
        "time_step",
        F.col(name).alias("generator_id"),
        F.lit(BASE).alias("scenario_type"),
        power.alias("active_power_mw"),
        F.lit(0.0).alias("reactive_power_mvar"),
        F.lit(True).alias("commitment_status"),
        (F.lit(0.0) if cost is None else cost).alias("generation_cost"),
    )


def outages(
    contingencies: DataFrame,
    elements: DataFrame,
    column: str = "affected_generators",
    name: str = "name",
    scenario: str = "contingency_name",
    case: Sequence[str] = (),
) -> DataFrame:
    """Known components each contingency takes out: ``(*case, scenario, name)``."""
    hit = affected_elements(contingencies, column, name, [*case, scenario])
    known = elements.select(*case, name).distinct()
    return hit.dropna(subset=[name]).join(known, [*case, name], "left_semi").distinct()


def unknown_outages(
    contingencies: DataFrame,
    elements: DataFrame,
    column: str = "affected_generators",
    name: str = "name",
    scenario: str = "contingency_name",
    case: Sequence[str] = (),
) -> DataFrame:
    """Affected names that are no component; they have no effect."""
    hit = affected_elements(contingencies, column, name, [*case, scenario])
    known = elements.select(*case, name).distinct()
    return hit.dropna(subset=[name]).join(known, [*case, name], "left_anti")


def scenario_changes(
    base: DataFrame,
    outage: DataFrame,
    scenario: str = "contingency_name",
    name: str = "name",
    respect_outage: bool = True,
    case: Sequence[str] = (),
    keep_base: bool = False,
) -> DataFrame:
    """Rows that differ from the base case: outaged units at 0, uncommitted.

    ``respect_outage=False`` keeps the row of an outaged unit as it is in the
    base case. ``keep_base`` adds the base output and cost, which
    :func:`scenario_totals` needs.
    """
    hit = outage.select(
        *case, F.col(scenario).alias("_scenario"), F.col(name).alias("generator_id")
    )
    rows = base.join(hit, [*case, "generator_id"])
    kept = F.lit(not respect_outage)
    return rows.select(
        *[c for c in base.columns if c not in _CHANGED],
        F.col("_scenario").alias("scenario_type"),
        *[
            F.when(kept, F.col(c)).otherwise(F.lit(0.0)).alias(c)
            for c in ("active_power_mw", "reactive_power_mvar", "generation_cost")
        ],
        kept.alias("commitment_status"),
        *(
            [
                F.col("active_power_mw").alias("base_power_mw"),
                F.col("generation_cost").alias("base_cost"),
            ]
            if keep_base
            else []
        ),
    )


_CHANGED = (
    "scenario_type",
    "active_power_mw",
    "reactive_power_mvar",
    "generation_cost",
    "commitment_status",
)


def scenario_totals(
    base: DataFrame,
    changes: DataFrame,
    scenarios: DataFrame,
    steps: int,
    case: Sequence[str] = (),
) -> DataFrame:
    """Output and cost of every scenario and step, base case included.

    A scenario's total is the base total plus what its changed rows (made with
    ``keep_base``) add or take away; scenarios without changed units have the
    base total.
    """
    at = [*case, "time_step"]
    totals = base.groupBy(*at).agg(
        F.sum("active_power_mw").alias("_mw"), F.sum("generation_cost").alias("_cost")
    )
    deltas = changes.groupBy("scenario_type", *at).agg(
        F.sum(F.col("active_power_mw") - F.col("base_power_mw")).alias("_dmw"),
        F.sum(F.col("generation_cost") - F.col("base_cost")).alias("_dcost"),
        F.count(F.lit(1)).alias("changed_units"),
    )
    listed = scenarios.select(*case, "scenario_type").distinct()
    grid = listed.withColumn("time_step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    return (
        grid.join(deltas, ["scenario_type", *at], "left")
        .join(totals, at)
        .select(
            "scenario_type",
            *at,
            (F.col("_mw") + F.coalesce("_dmw", F.lit(0.0))).alias("total_generation_mw"),
            (F.col("_cost") + F.coalesce("_dcost", F.lit(0.0))).alias("total_generation_cost"),
            F.coalesce("changed_units", F.lit(0)).alias("changed_units"),
        )
    )


def scenario_rows(
    base: DataFrame,
    changes: DataFrame,
    scenario_ids: Sequence[str],
    case: Sequence[str] = (),
) -> DataFrame:
    """Full dispatch rows of the listed scenarios (the base case is ``BASE``)."""
    keys = [*case, "scenario_type", "time_step", "generator_id"]
    wanted = [str(s) for s in scenario_ids]
    copies = base.withColumn(
        "scenario_type", F.explode(F.array(*[F.lit(s) for s in wanted]))
    )
    changed = changes.filter(F.col("scenario_type").isin(wanted)).select(
        *keys,
        *[F.col(c).alias(f"_{c}") for c in _CHANGED if c != "scenario_type"],
        F.lit(True).alias("_changed"),
    )
    joined = copies.join(changed, keys, "left")
    replaced = [c for c in _CHANGED if c != "scenario_type"]
    return joined.select(
        *keys,
        *[
            F.when(F.col("_changed"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
            for c in replaced
        ],
        *[c for c in base.columns if c not in keys and c not in replaced],
    )


def consensus(
    dispatch: DataFrame,
    keys: Sequence[str] = ("generator_id", "time_step"),
    power: str = "active_power_mw",
) -> DataFrame:
    """Mean output per unit and step."""
    return dispatch.groupBy(*keys).agg(F.avg(power).alias("consensus_mw"))


def residuals(
    dispatch: DataFrame,
    keys: Sequence[str] = ("generator_id", "time_step"),
    by: Sequence[str] = (),
    power: str = "active_power_mw",
) -> DataFrame:
    """Primal residual (distance from the consensus) and dual residual.

    The squared distances of a unit-step are its population variance times its
    row count, so rows are combined on the map side and never joined back.
    """
    per_key = dispatch.groupBy(*by, *keys).agg(
        (F.var_pop(power) * F.count(power)).alias("_squares")
    )
    return per_key.groupBy(*by).agg(
        F.sqrt(F.sum("_squares")).alias("primal_residual")
    ).withColumn("dual_residual", F.col("primal_residual") * DUAL_SHARE)


def multipliers(
    dispatch: DataFrame,
    rho: float,
    keys: Sequence[str] = ("generator_id", "time_step"),
    power: str = "active_power_mw",
    previous: str | None = None,
    spread: int = 1,
) -> DataFrame:
    """Multiplier per row: the previous one plus rho times the distance from the
    consensus."""
    old = F.lit(0.0) if previous is None else F.coalesce(F.col(previous), F.lit(0.0))
    return (
        spread_join(dispatch, consensus(dispatch, keys, power), list(keys), "inner", spread)
        .withColumn("lambda_p", old + F.lit(rho) * (F.col(power) - F.col("consensus_mw")))
    )


def objective(
    dispatch: DataFrame,
    by: Sequence[str] = (),
    weight: float | Column = CONTINGENCY_WEIGHT,
    scenario: str = "scenario_type",
    cost: str = "generation_cost",
    base: str = BASE,
) -> DataFrame:
    """Base cost plus weighted contingency cost.

    ``weight`` may be a column, for instance the contingency's probability.
    """
    factor = F.lit(weight) if isinstance(weight, (int, float)) else weight
    is_base = F.col(scenario) == base
    return dispatch.groupBy(*by).agg(
        F.sum(F.when(is_base, F.col(cost)).otherwise(F.col(cost) * factor)).alias(
            "objective_value"
        )
    )


def convergence_status(
    history: DataFrame,
    tolerance: float,
    execution: str = "execution_id",
    iteration: str = "iteration",
    primal: str = "primal_residual",
    dual: str = "dual_residual",
    value: str = "objective_value",
) -> DataFrame:
    """Status, last iteration and objective per execution.

    A run stops at the first iteration with both residuals below the tolerance.
    """
    done = (F.col(primal) < tolerance) & (F.col(dual) < tolerance)
    stopped_at = F.when(done, F.col(iteration))
    # Plain numbers instead of structs, so that a hash aggregate can hold them.
    ends = history.groupBy(execution).agg(
        F.min(stopped_at).alias("_stop"),
        F.max(iteration).alias("_last"),
        F.min_by(F.col(value), stopped_at).alias("_stop_value"),
        F.max_by(value, iteration).alias("_last_value"),
    )
    converged = F.col("_stop").isNotNull()
    return ends.select(
        execution,
        F.when(converged, "CONVERGED").otherwise("MAX_ITERATIONS").alias("convergence_status"),
        F.coalesce("_stop", "_last").alias("final_iteration"),
        F.when(converged, F.col("_stop_value"))
        .otherwise(F.col("_last_value"))
        .alias("objective_value"),
    )
