"""Scenario tables against full expansion by hand; study plan; status."""

import itertools

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridlake.operators import scenarios as sc
from gridlake.operators.documents import to_system_document
from gridlake.operators.joins import affected_elements, as_of_version
from gridlake.plans.scenario_run import save_study, save_study_once, stored_studies, study

UNITS = [("c1", "G1", 10.0, 110.0), ("c1", "G2", 0.0, 50.0), ("c2", "G1", 20.0, 40.0)]
OUTAGES = [
    ("c1", "N-1_G1", ["G1"]),
    ("c1", "both", ["G1", "G2"]),
    ("c1", "line", None),
    ("c1", "ghost", ["G9"]),
    ("c2", "N-1_G1", ["G1"]),
]
STEPS = 3


@pytest.fixture(scope="module")
def tables(spark):
    units = spark.createDataFrame(UNITS, "case_name string, name string, pmin double, pmax double")
    contingencies = spark.createDataFrame(
        OUTAGES, "case_name string, contingency_name string, affected_generators array<string>"
    )
    return units, contingencies


def brute_force():
    out = {}
    names = {(c, s): a for c, s, a in OUTAGES} | {("c1", "BASE"): None, ("c2", "BASE"): None}
    for (case, scenario), affected in names.items():
        for (c, g, lo, hi), t in itertools.product(UNITS, range(1, STEPS + 1)):
            if c == case:
                out[case, scenario, t, g] = 0.0 if g in (affected or []) else (lo + hi) / 2
    return out


def test_totals_equal_full_expansion(tables):
    units, contingencies = tables
    case = ["case_name"]
    base = sc.base_dispatch(units, STEPS, keep=case)
    changes = sc.scenario_changes(
        base, sc.outages(contingencies, units, case=case), case=case, keep_base=True
    )
    listed = contingencies.select("case_name", F.col("contingency_name").alias("scenario_type")).unionByName(
        units.select("case_name").distinct().withColumn("scenario_type", F.lit("BASE"))
    )
    got = {
        (r.case_name, r.scenario_type, r.time_step): r.total_generation_mw
        for r in sc.scenario_totals(base, changes, listed, STEPS, case).collect()
    }
    want = {}
    for (case_name, scenario, t, _), mw in brute_force().items():
        want[case_name, scenario, t] = want.get((case_name, scenario, t), 0.0) + mw
    assert got == want


def test_full_rows_of_chosen_scenarios(tables):
    units, contingencies = tables
    case = ["case_name"]
    base = sc.base_dispatch(units, STEPS, keep=case)
    changes = sc.scenario_changes(base, sc.outages(contingencies, units, case=case), case=case)
    got = {
        (r.case_name, r.scenario_type, r.time_step, r.generator_id): r.active_power_mw
        for r in sc.scenario_rows(base, changes, ["BASE", "N-1_G1"], case).collect()
    }
    assert got == {k: v for k, v in brute_force().items() if k[1] in ("BASE", "N-1_G1")}


def test_compatible_mode_keeps_output(tables):
    units, contingencies = tables
    base = sc.base_dispatch(units, 1, keep=["case_name"])
    hit = sc.outages(contingencies, units, case=["case_name"])
    kept = sc.scenario_changes(base, hit, respect_outage=False, case=["case_name"])
    assert {r.active_power_mw for r in kept.collect()} == {60.0, 25.0, 30.0}


def test_null_and_unknown_elements(tables):
    units, contingencies = tables
    long = affected_elements(contingencies, "affected_generators", "name")
    assert ("line", None) in rows(long)
    unknown = sc.unknown_outages(contingencies, units, case=["case_name"])
    assert rows(unknown, "case_name", "contingency_name", "name") == [("c1", "ghost", "G9")]


def test_residuals_and_multipliers(spark):
    df = spark.createDataFrame(
        [("g", 1, 10.0), ("g", 1, 14.0), ("h", 1, 5.0)],
        "generator_id string, time_step int, active_power_mw double",
    )
    r = sc.residuals(df).head()
    assert r.primal_residual == pytest.approx(8**0.5)
    assert r.dual_residual == pytest.approx(0.1 * 8**0.5)
    assert rows(sc.multipliers(df, 0.5), "active_power_mw", "lambda_p") == [(10.0, -1.0), (14.0, 1.0), (5.0, 0.0)]


def test_own_average_leaves_no_residual(tables):
    units, _ = tables
    base = sc.base_dispatch(units, STEPS, keep=["case_name"])
    assert all(r.primal_residual == 0 for r in sc.residuals(base, by=["case_name"]).collect())


def test_objective_weight(spark):
    df = spark.createDataFrame(
        [("BASE", 100.0), ("x", 50.0), ("y", 10.0)], "scenario_type string, generation_cost double"
    )
    assert sc.objective(df).head().objective_value == pytest.approx(100.6)


def test_convergence_status(spark):
    history = spark.createDataFrame(
        [("a", 1, 1.0, 0.1, 9.0), ("a", 2, 0.005, 0.0005, 8.0), ("a", 3, 0.001, 0.0001, 7.0),
         ("b", 1, 1.0, 0.0, 5.0), ("b", 2, 0.5, 0.0, 4.0)],
        "execution_id string, iteration int, primal_residual double, dual_residual double, objective_value double",
    )
    assert rows(sc.convergence_status(history, 0.01)) == [
        ("a", "CONVERGED", 2, 8.0), ("b", "MAX_ITERATIONS", 2, 4.0),
    ]


def test_as_of_versions(spark):
    df = spark.createDataFrame(
        [("c", 1, "2024-01-01", None), ("c", 2, "2024-02-01", "2024-03-01"), ("c", 3, "2024-02-15", "2024-02-20"),
         ("d", 4, "2024-01-01", "2024-01-05")],
        "case_name string, topology_id bigint, f string, u string",
    ).selectExpr(
        "case_name", "topology_id", "cast(f AS timestamp_ntz) AS valid_from", "cast(u AS timestamp_ntz) AS valid_until"
    )
    at = lambda text: F.to_timestamp_ntz(F.lit(text))
    assert rows(as_of_version(df, at("2024-02-25 00:00:00")), "case_name", "topology_id") == [("c", 2)]
    assert rows(as_of_version(df, at("2024-03-02 00:00:00")), "case_name", "topology_id") == [("c", 1)]


def test_study_end_to_end(spark, tables, tmp_path):
    units, contingencies = tables
    buses = spark.createDataFrame([("c1", 1, "B"), ("c2", 1, "B")], "case_name string, number bigint, name string")
    generators = units.withColumns(
        {"type": F.when(F.col("name") == "G2", "HYDRO").otherwise("THERMAL"), "rating": F.col("pmax")}
    )
    topology = to_system_document({"buses": buses, "generators": generators}).withColumns(
        {"valid_from": F.to_timestamp_ntz(F.lit("2024-01-01")), "valid_until": F.lit(None).cast("timestamp_ntz")}
    )
    result = study(topology, contingencies, F.to_timestamp_ntz(F.lit("2024-06-01")), steps=3)
    # The hydro unit stays out; its part in an outage has no effect.
    assert {r.generator_id for r in result.base.collect()} == {"G1"}
    assert result.totals.filter("scenario_type = 'both'").select("changed_units").distinct().head()[0] == 1
    assert result.objective.count() == 2
    save_study(result, "run-1", str(tmp_path))
    stored = spark.read.parquet(f"{tmp_path}/generator_dispatch_results")
    assert stored.count() == result.base.count() + result.changes.count() > 0
    assert rows(stored.select("execution_id").distinct()) == [("run-1",)]
    table = str(tmp_path / "studies")
    added = [save_study_once(result, run, table) for run in ("run-1", "run-2", "run-1")]
    assert added == [True, True, False]
    assert stored_studies(spark, table).count() == 2 * stored.count()
