"""Quality rules: mostly, nulls, empty frames, order, gates, verdicts."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gridlake.operators import quality as q
from gridlake.operators.ordered import number_bucket
from gridlake.plans import daily


def arrival():
    return q.Arrival(["bus_id"], ["arrival"], number_bucket("arrival", 2))


def power(spark, data):
    schema = (
        "arrival bigint, time timestamp_ntz, bus_id string, voltage_magnitude double,"
        " voltage_angle_rad double, active_power_mw double, frequency_hz double,"
        " measurement_quality int, case_name string"
    )
    df = spark.createDataFrame(
        [(i, str(t), *rest) for i, (t, *rest) in enumerate(data)],
        schema.replace("timestamp_ntz", "string"),
    )
    return df.withColumn("time", F.col("time").cast("timestamp_ntz"))


GOOD = [
    ("2024-01-01 00:00:00", "Bus1", 1.0, 0.0, 100.0, 60.0, 100, "c"),
    ("2024-01-01 00:00:00", "Bus2", 1.02, 0.1, 150.0, 60.0, 100, "c"),
    ("2024-01-01 01:00:00", "Bus1", 1.0, 0.0, 100.0, 60.0, 100, "c"),
]


def test_valid_power_frame_passes(spark):
    report = q.run_suite(power(spark, GOOD), q.POWER_SUITE, arrival=arrival())
    assert report.count() == len(q.POWER_SUITE)
    assert q.suite_summary(report).head().success


def test_negative_generator_fails(spark):
    df = spark.createDataFrame(
        [("Gen1", -10.0, True, "THERMAL", 50.0)],
        "generator_id string, active_power_mw double, commitment_status boolean,"
        " generator_type string, marginal_cost double",
    )
    report = q.run_suite(df, q.GENERATOR_SUITE)
    assert [r.rule for r in report.filter("NOT success").collect()] == ["between(active_power_mw)"]


def test_condenser_is_no_valid_type(spark):
    df = spark.createDataFrame([("SYNC_COND",), ("HYDRO",), (None,)], "generator_type string")
    rule = q.in_set("generator_type", ["THERMAL", "HYDRO"])
    assert rows(q.run_suite(df, [rule]), "evaluated", "unexpected", "success") == [(2, 1, False)]


@pytest.mark.parametrize("bad,success", [(2, True), (3, False)])
def test_mostly_boundary(spark, bad, success):
    df = spark.range(100).select(F.when(F.col("id") < bad, 2.0).otherwise(1.0).alias("v"))
    report = q.run_suite(df, [q.between("v", 0.9, 1.1, 0.98)])
    assert rows(report, "unexpected", "success") == [(bad, success)]


def test_all_null_and_empty(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    rules = [q.between("v", 0, 1), q.not_null("v")]
    assert rows(q.run_suite(df, rules), "kind", "evaluated", "unexpected", "success") == [
        ("between", 0, 0, True), ("not_null", 2, 2, False),
    ]
    assert q.suite_summary(q.run_suite(df.limit(0), rules)).head().success


def test_time_going_back_in_one_bus(spark):
    data = GOOD + [("2024-01-01 00:30:00", "Bus1", 1.0, 0.0, 1.0, 60.0, 100, "c")]
    report = q.run_suite(power(spark, data), [q.increasing("time")], arrival=arrival())
    assert rows(report, "evaluated", "unexpected", "success") == [(4, 1, False)]
    with pytest.raises(ValueError):
        q.run_suite(power(spark, data), [q.increasing("time")])


def test_equal_times_are_in_order(spark):
    data = [GOOD[0], GOOD[0]]
    report = q.run_suite(power(spark, data), [q.increasing("time")], arrival=arrival())
    assert rows(report, "unexpected") == [(0,)]


def test_gate(spark):
    df = spark.createDataFrame([(1.0,), (9.0,), (None,)], "v double")
    rules = [q.between("v", 0, 2)]
    assert q.apply_gate(df, rules).count() == 3
    assert q.apply_gate(df, rules, "quarantine").count() == 2
    with pytest.raises(ValueError):
        q.apply_gate(df, rules, "fail")


def test_verdict_reasons(spark):
    cases = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "case_name string")
    power_report = spark.createDataFrame(
        [("a", True), ("b", False), ("c", True)], "case_name string, success boolean"
    )
    generator_report = spark.createDataFrame([("c", False)], "case_name string, success boolean")
    verdict = q.case_verdict(cases, power_report, generator_report)
    assert rows(verdict, "case_name", "success", "reason") == [
        ("a", True, None),
        ("b", False, "power rules failed"),
        ("c", False, "generator rules failed"),
        ("d", False, "no power data"),
    ]
    assert rows(q.verdict_totals(verdict)) == [(4, 1, 3)]


def test_result_gate(spark):
    wanted = spark.createDataFrame([("e1",), ("e2",), ("e3",), ("e4",)], "execution_id string")
    runs = spark.createDataFrame(
        [("e1", "CONVERGED"), ("e2", "MAX_ITERATIONS"), ("e3", "CONVERGED")],
        "execution_id string, convergence_status string",
    )
    dispatch = spark.createDataFrame([("e1",), ("e1",), ("e2",)], "execution_id string")
    assert rows(q.result_gate(wanted, runs, dispatch), "execution_id", "dispatch_rows", "reason") == [
        ("e1", 2, None),
        ("e2", 1, "not converged"),
        ("e3", 0, "no dispatch results"),
        ("e4", 0, "execution not found"),
    ]


def test_daily_metric_rows(spark):
    generators = spark.createDataFrame(
        [("2024-01-01 00:00:00", -5.0, True, "THERMAL", 20.0, "c")],
        "time string, active_power_mw double, commitment_status boolean, generator_type string,"
        " marginal_cost double, case_name string",
    ).withColumn("time", F.col("time").cast("timestamp_ntz"))
    metrics = daily.input_quality(
        power(spark, GOOD), generators, F.to_timestamp_ntz(F.lit("2024-01-01 02:00:00")), arrival()
    )
    bad = metrics.filter("pass_fail = 'FAIL'")
    assert rows(bad, "table_name", "metric_type", "metric_name", "affected_records") == [
        ("generator_measurements", "VALIDITY", "between(active_power_mw)", 1)
    ]
    assert metrics.filter("metric_type = 'COMPLETENESS'").count() == 3


def test_case_report_and_gated_report(spark):
    topology = spark.createDataFrame([("c",), ("empty",)], "case_name string")
    generators = spark.createDataFrame(
        [("2024-01-01 00:00:00", 5.0, True, "THERMAL", 20.0, "c")],
        "time string, active_power_mw double, commitment_status boolean, generator_type string,"
        " marginal_cost double, case_name string",
    ).withColumn("time", F.col("time").cast("timestamp_ntz"))
    now = F.to_timestamp_ntz(F.lit("2024-01-02 00:00:00"))
    report = daily.case_report(topology, power(spark, GOOD), generators, now, arrival())
    assert rows(report, "case_name", "success", "days_covered", "total_measurements") == [
        ("c", True, 1, 3), ("empty", False, None, None),
    ]
    runs = spark.createDataFrame(
        [("e1", "CONVERGED"), ("e2", "FAILED")], "execution_id string, convergence_status string"
    )
    dispatch = spark.createDataFrame(
        [("e1", "g", 2.0, 9.0), ("e1", "g", 3.0, 1.0), ("e1", "h", 1.0, 1.0)],
        "execution_id string, generator_id string, active_power_mw double, generation_cost double",
    )
    got = daily.gated_report(runs, runs, dispatch)
    assert rows(got, "execution_id", "success", "num_generators", "total_generation_mw", "total_cost") == [
        ("e1", True, 2, 6.0, 11.0), ("e2", False, 0, None, None),
    ]


def test_gaps_and_ramps(spark):
    from gridlake.operators import derived

    data = [("a", f"2024-01-0{d} {h:02d}:00:00", float(h)) for d in (1, 2) for h in range(24) if (d, h) != (1, 23)]
    df = spark.createDataFrame(data, "bus_id string, time string, active_power_mw double").withColumn(
        "time", F.col("time").cast("timestamp_ntz")
    )
    assert rows(derived.gap_report(df), "rows", "span_hours", "widest_gap_hours", "large_gaps", "sufficient") == [
        (47, 47.0, 2.0, 1, False)
    ]
    ramp = {r.time.isoformat(): r.ramp_rate_actual for r in derived.ramp_rates(df, ["bus_id"]).collect()}
    assert ramp["2024-01-01T00:00:00"] is None and ramp["2024-01-01T05:00:00"] == 1.0
    # Across midnight and the missing hour: from 22 to 0 in two hours.
    assert ramp["2024-01-02T00:00:00"] == -11.0


def test_forecast_as_of(spark):
    from gridlake.operators import derived

    forecasts = spark.createDataFrame(
        [("g", "2024-01-02 00:00:00", "2024-01-01 00:00:00", 5.0, 4.0, 6.0),
         ("g", "2024-01-02 00:00:00", "2024-01-01 12:00:00", 7.0, 6.5, 7.5),
         ("g", "2024-01-02 00:00:00", "2024-01-02 01:00:00", 9.0, 9.0, 9.0)],
        "generator_id string, target_time string, forecast_time string, forecasted_power_mw double,"
        " confidence_lower_mw double, confidence_upper_mw double",
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("target_time", "forecast_time")})
    actual = spark.createDataFrame(
        [("g", "2024-01-02 00:00:00", 8.0)], "generator_id string, time string, active_power_mw double"
    ).withColumn("time", F.col("time").cast("timestamp_ntz"))
    got = derived.forecast_match(forecasts, actual)
    assert rows(got, "forecasted_power_mw", "forecast_error_mw", "in_band", "horizon_hours") == [
        (7.0, 1.0, False, 12.0)
    ]
