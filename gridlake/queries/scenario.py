"""Outage scenarios on suppliers and parts, objective and residuals on lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators import scenarios as sc
from gridlake.queries.mapping import dispatch
from gridlake.queries.registry import Tables, query, rounded

STEPS = 24


def _units(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_nationkey").alias("topology_id"),
        F.col("s_name").alias("name"),
        F.lit(10.0).alias("pmin"),
        (F.abs("s_acctbal") + 10).alias("pmax"),
    )


UNITS_SQL = """u AS (
  SELECT s_nationkey AS topology_id, s_name AS name, 10.0::DOUBLE AS pmin, abs(s_acctbal) + 10 AS pmax
  FROM supplier)"""


def _branches(t: Tables) -> DataFrame:
    return t.part.select(
        (F.col("p_partkey") % 25).cast("int").alias("topology_id"),
        F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("name"),
    )


@query("n1_contingencies", f"""
WITH {UNITS_SQL}
SELECT CAST(p_partkey % 25 AS INTEGER) AS topology_id, 'N-1_B' || p_partkey AS contingency_name,
  'N-1' AS contingency_type, 'B' || p_partkey AS branches, NULL AS units, 0.01::DOUBLE AS probability,
  2 AS severity_level, 'Single branch outage: B' || p_partkey AS description FROM part
UNION ALL
SELECT topology_id, 'N-1_' || name, 'N-1', NULL, name, 0.005, 3, 'Single generator outage: ' || name
FROM u WHERE pmax > 100""")
def n1_contingencies(t):
    found = sc.n1_contingencies(_branches(t), _units(t), sc.LARGE_UNIT_MW)
    return found.select(
        "topology_id", "contingency_name", "contingency_type",
        F.array_join("affected_branches", ",").alias("branches"),
        F.array_join("affected_generators", ",").alias("units"),
        "probability", "severity_level", "description",
    )


@query("contingency_rank", f"""
WITH {UNITS_SQL}
SELECT 'N-1_B' || p_partkey AS contingency_name, 2 AS severity_level, 0.01::DOUBLE AS probability FROM part
UNION ALL SELECT 'N-1_' || name, 3, 0.005 FROM u""")
def contingency_rank(t):
    return sc.contingency_order(sc.n1_contingencies(_branches(t), _units(t))).select(
        "contingency_name", "severity_level", "probability"
    )


@query("contingency_counts", f"""
WITH {UNITS_SQL}, c AS (
  SELECT CAST(p_partkey % 25 AS INTEGER) AS topology_id FROM part UNION ALL SELECT topology_id FROM u)
SELECT n_name AS case_name, 'N-1' AS contingency_type, count(*) AS contingencies
FROM c JOIN nation ON n_nationkey = topology_id GROUP BY 1""")
def contingency_counts(t):
    cases = t.nation.select(F.col("n_nationkey").alias("topology_id"), F.col("n_name").alias("case_name"))
    found = sc.n1_contingencies(_branches(t), _units(t))
    return sc.contingency_counts(found, ["case_name", "contingency_type"], cases)


@query("contingencies_per_topology", f"""
WITH {UNITS_SQL}, c AS (
  SELECT CAST(p_partkey % 25 AS INTEGER) AS topology_id FROM part UNION ALL SELECT topology_id FROM u)
SELECT topology_id, count(*) AS contingencies FROM c GROUP BY 1""")
def contingencies_per_topology(t):
    return sc.contingency_counts(sc.n1_contingencies(_branches(t), _units(t)), ["topology_id"])


def _parts(t: Tables, respect_outage: bool = True):
    """Base rows, changes and contingencies of single unit and branch outages."""
    case = ["topology_id"]
    units = _units(t)
    price = F.lit(20.0) * sc.midpoint()
    base = sc.base_dispatch(units, STEPS, keep=case, cost=price)
    contingencies = sc.n1_contingencies(_branches(t), units)
    hit = sc.outages(contingencies, units, case=case)
    changes = sc.scenario_changes(
        base, hit, respect_outage=respect_outage, case=case, keep_base=True
    )
    return base, changes, contingencies


_BASE_SQL = f"""{UNITS_SQL},
base AS (SELECT topology_id, CAST(s AS INTEGER) AS time_step, name, (pmin + pmax) / 2 AS mw,
                20 * (pmin + pmax) / 2 AS cost FROM u, range(1, {STEPS + 1}) r(s))"""


@query("base_dispatch", f"""
WITH {_BASE_SQL}
SELECT topology_id, time_step, name AS generator_id, 'BASE' AS scenario_type,
       round(mw, 4) AS active_power_mw, round(cost, 4) AS generation_cost, TRUE AS commitment_status FROM base""")
def base_dispatch(t):
    base, _, _ = _parts(t)
    return rounded(base, "active_power_mw", "generation_cost").drop("reactive_power_mvar")


@query("scenario_dispatch", f"""
WITH {_BASE_SQL}
SELECT topology_id, time_step, name AS generator_id, 'BASE' AS scenario_type,
       round(mw, 4) AS active_power_mw, TRUE AS commitment_status FROM base
UNION ALL
SELECT topology_id, time_step, name, 'N-1_' || name, 0.0, FALSE FROM base""")
def scenario_dispatch(t):
    """Base rows and the rows the outages change."""
    base, changes, _ = _parts(t)
    rows = base.unionByName(changes.drop("base_power_mw", "base_cost"))
    return rounded(rows, "active_power_mw").select(
        "topology_id", "time_step", "generator_id", "scenario_type", "active_power_mw",
        "commitment_status",
    )


@query("outage_flags", f"""
WITH {_BASE_SQL}
SELECT topology_id, time_step, name AS generator_id, 'N-1_' || name AS scenario_type,
       round(mw, 4) AS active_power_mw, TRUE AS commitment_status FROM base""")
def outage_flags(t):
    """Compatible mode: an outaged unit keeps its base output."""
    _, changes, _ = _parts(t, respect_outage=False)
    return rounded(changes, "active_power_mw").select(
        "topology_id", "time_step", "generator_id", "scenario_type", "active_power_mw",
        "commitment_status",
    )


@query("scenario_totals", f"""
WITH {_BASE_SQL},
scen AS (SELECT topology_id, 'BASE' AS scenario_type, NULL AS outage FROM (SELECT DISTINCT topology_id FROM u) x
  UNION ALL SELECT topology_id, 'N-1_' || name, name FROM u
  UNION ALL SELECT CAST(p_partkey % 25 AS INTEGER), 'N-1_B' || p_partkey, NULL FROM part)
SELECT s.scenario_type, b.topology_id, b.time_step,
  round(sum(CASE WHEN b.name = s.outage THEN 0 ELSE mw END), 3) AS total_generation_mw,
  round(sum(CASE WHEN b.name = s.outage THEN 0 ELSE cost END), 3) AS total_generation_cost,
  CAST(sum(CASE WHEN b.name = s.outage THEN 1 ELSE 0 END) AS BIGINT) AS changed_units
FROM scen s JOIN base b ON b.topology_id = s.topology_id GROUP BY 1, 2, 3""")
def scenario_totals(t):
    """The SQL expands every scenario to all units; the operator does not."""
    base, changes, contingencies = _parts(t)
    named = contingencies.select(
        "topology_id", F.col("contingency_name").alias("scenario_type")
    ).unionByName(
        _units(t).select("topology_id").distinct().withColumn("scenario_type", F.lit(sc.BASE))
    )
    totals = sc.scenario_totals(base, changes, named, STEPS, ["topology_id"])
    return rounded(totals, "total_generation_mw", "total_generation_cost", digits=3)


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("scenario_rows", f"""
WITH {_BASE_SQL},
area AS (SELECT s_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey),
scen AS (SELECT 'BASE' AS scenario_type UNION ALL SELECT unnest({REGIONS}))
SELECT scen.scenario_type, time_step, name AS generator_id,
  round(CASE WHEN r_name = scen.scenario_type THEN 0 ELSE mw END, 4) AS active_power_mw,
  r_name <> scen.scenario_type AS commitment_status
FROM scen, base JOIN area ON s_name = name""")
def scenario_rows(t):
    """Full rows of six scenarios: the base case and the outage of each region."""
    base, _, _ = _parts(t)
    area = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("topology_id"),
            F.col("r_name").alias("contingency_name"),
            F.col("s_name").alias("name"),
        )
    )
    changes = sc.scenario_changes(base, area, case=["topology_id"])
    rows = sc.scenario_rows(base, changes, [sc.BASE, *REGIONS], ["topology_id"])
    return rounded(rows, "active_power_mw").select(
        "scenario_type", "time_step", "generator_id", "active_power_mw", "commitment_status"
    )


@query("unknown_outages", """
SELECT 'N-1_B' || p_partkey AS contingency_name, 'B' || p_partkey AS name FROM part
WHERE p_partkey % 3 = 0""")
def unknown_outages(t):
    """Outages of branches that a table without every third branch does not know."""
    found = sc.n1_contingencies(_branches(t), _units(t))
    known = _branches(t).filter(F.substring("name", 2, 20).cast("bigint") % 3 != 0)
    return sc.unknown_outages(found, known, "affected_branches").select("contingency_name", "name")


@query("dispatch_union", """
SELECT l_linenumber AS time_step, l_suppkey AS generator_id, l_quantity AS active_power_mw,
       CASE WHEN l_returnflag = 'N' THEN 'BASE' ELSE l_returnflag END AS scenario_type FROM lineitem""")
def dispatch_union(t):
    """Base and contingency rows under one schema."""
    rows = dispatch(t).select("time_step", "generator_id", "active_power_mw", "scenario_type")
    base = rows.filter(F.col("scenario_type") == "N").withColumn("scenario_type", F.lit(sc.BASE))
    return base.unionByName(rows.filter(F.col("scenario_type") != "N"))


@query("consensus", """
SELECT l_suppkey AS generator_id, l_linenumber AS time_step, round(avg(l_quantity), 6) AS consensus_mw
FROM lineitem GROUP BY 1, 2""")
def consensus(t):
    return rounded(sc.consensus(dispatch(t)), "consensus_mw", digits=6)


@query("residuals", """
WITH c AS (SELECT *, avg(l_quantity) OVER (PARTITION BY l_suppkey, l_linenumber) AS m FROM lineitem)
SELECT l_returnflag AS scenario_type, round(sqrt(sum((l_quantity - g) * (l_quantity - g))), 4) AS primal_residual,
       round(0.1 * sqrt(sum((l_quantity - g) * (l_quantity - g))), 4) AS dual_residual
FROM (SELECT *, avg(l_quantity) OVER (PARTITION BY l_returnflag, l_suppkey, l_linenumber) AS g FROM c) x
GROUP BY 1""")
def residuals(t):
    r = sc.residuals(dispatch(t), by=["scenario_type"])
    return rounded(r, "primal_residual", "dual_residual")


@query("multipliers", """
SELECT l_orderkey AS execution_id, l_linenumber AS time_step, l_suppkey AS generator_id, l_partkey AS bus_id,
  round(l_discount + 0.5 * (l_quantity - avg(l_quantity) OVER (PARTITION BY l_suppkey, l_linenumber)), 8) AS lambda_p
FROM lineitem""")
def multipliers(t):
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("execution_id"),
        F.col("l_linenumber").alias("time_step"),
        F.col("l_suppkey").alias("generator_id"),
        F.col("l_partkey").alias("bus_id"),
        F.col("l_quantity").alias("active_power_mw"),
        F.col("l_discount").alias("old"),
    )
    out = sc.multipliers(rows, 0.5, previous="old", spread=4)
    return rounded(out, "lambda_p", digits=8).select(
        "execution_id", "time_step", "generator_id", "bus_id", "lambda_p"
    )


@query("objective", """
SELECT l_orderkey AS execution_id,
  round(sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE 0.01 * l_extendedprice END), 4) AS objective_value
FROM lineitem GROUP BY 1""")
def objective(t):
    return rounded(sc.objective(dispatch(t), ["execution_id"], base="N"), "objective_value")


@query("objective_by_probability", """
SELECT round(sum(CASE WHEN l_returnflag = 'N' THEN l_extendedprice ELSE l_discount * l_extendedprice END), 2)
  AS objective_value FROM lineitem""")
def objective_by_probability(t):
    """Contingency cost weighted by its own probability."""
    rows = t.lineitem.select(
        F.col("l_returnflag").alias("scenario_type"),
        F.col("l_extendedprice").alias("generation_cost"),
        F.col("l_discount").alias("probability"),
    )
    return rounded(
        sc.objective(rows, weight=F.col("probability"), base="N"), "objective_value", digits=2
    )
