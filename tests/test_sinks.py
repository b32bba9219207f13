"""Sinks: names over positions, retention, new cases, refresh, pruning."""

from conftest import rows
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import reports, rollups
from gridlake.sinks import tables as sinks
from gridlake.sources.tables import read_measurements
from gridlake.streaming import measurements as st


def at(text):
    return F.to_timestamp_ntz(F.lit(text))


def hours(spark, n, start="2024-01-01 00:00:00"):
    from gridlake.functions.scalars import hours_after

    return spark.range(n).select(
        hours_after(F.col("id"), start).alias("time"),
        (F.col("id") % 3).alias("bus_id"),
        F.lit("c").alias("case_name"),
        F.col("id").cast("double").alias("voltage_magnitude"),
        F.lit(1.0).alias("active_power_mw"),
        F.lit(1.0).alias("reactive_power_mvar"),
    )


def test_columns_go_by_name(spark, tmp_path):
    df = spark.createDataFrame([(5.0, "G1", 2)], "active_power_mw double, generator_id string, time_step int")
    sinks.append_results(sinks.tag_results(df, "run"), schemas.DISPATCH_RESULTS, str(tmp_path / "d"))
    got = spark.read.parquet(str(tmp_path / "d")).head()
    assert (got.execution_id, got.time_step, got.generator_id, got.active_power_mw) == ("run", 2, "G1", 5.0)
    assert got.generation_cost is None


def test_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "m")
    sinks.append_measurements(hours(spark, 96), path, entity="bus_id")
    got = read_measurements(spark, path, "2024-01-02 00:00:00", "2024-01-02 05:00:00")
    assert got.count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(time)" in plan


def test_retention(spark, tmp_path):
    path, kept = str(tmp_path / "m"), str(tmp_path / "k")
    sinks.append_measurements(hours(spark, 96), path)
    now = at("2024-01-05 12:00:00")
    sinks.rewrite_retained(spark.read.parquet(path), now, 2, kept)
    assert spark.read.parquet(kept).count() == 36  # from 3 January, 12:00
    assert sinks.expired_dates(spark.read.parquet(path), now, 2).count() == 2


def test_only_new_cases_are_added(spark, tmp_path):
    path = str(tmp_path / "c")
    spark.createDataFrame([("a", 1)], "case_name string, v int").write.parquet(path)
    more = spark.createDataFrame([("a", 2), ("b", 2)], "case_name string, v int")
    sinks.append_new_cases(more, spark.read.parquet(path), path)
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", 2)]


def test_execution_defaults(spark):
    runs = spark.createDataFrame([(1, None), (2, "DAG")], "topology_id bigint, triggered_by string")
    got = rows(sinks.execution_records(runs), "topology_id", "optimization_horizon_hours", "triggered_by")
    assert got == [(1, 24, "MANUAL"), (2, 24, "DAG")]


def test_solution_has_a_heading_per_column(spark, tmp_path):
    df = spark.createDataFrame([("corn", 1, 2, 2022, 3.5)], "a string, i int, j int, t int, v double")
    sinks.write_solution_csv(df, str(tmp_path / "x"), "biomass")
    back = spark.read.option("header", True).csv(str(tmp_path / "x"))
    assert back.columns == ["Resource", "SourceCounty", "ProdCounty", "Year", "Production"]
    assert back.head().Production == "3.5"


def test_report_forms(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "case_name string, n int")
    sinks.write_report(df, str(tmp_path / "j"))
    sinks.write_report(df, str(tmp_path / "c"), "csv")
    assert spark.read.json(str(tmp_path / "j")).count() == spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 1


def test_refresh_replaces_only_its_window(spark, tmp_path):
    path = str(tmp_path / "r")
    st.refresh_rollup(rollups.hourly_rollup(hours(spark, 48)), path)
    late = hours(spark, 48).unionByName(hours(spark, 48))  # every row came a second time
    bounds = st.refresh_bounds(at("2024-01-02 12:30:00"), 3, 1)
    st.refresh_rollup(rollups.hourly_rollup(st.refresh_window(late, bounds)), path, bounds)
    twice = spark.read.parquet(path).filter("measurement_count = 2")
    # 12:30 - 3 h = 09:30, whole buckets from 10:00; 12:30 - 1 h = 11:30, up to 11:00.
    assert rows(twice.selectExpr("date_format(bucket, 'dd HH')")) == [("02 10",)]
    assert spark.read.parquet(path).count() == 48


def test_daily_refresh_bounds(spark):
    first, last = st.refresh_bounds(at("2024-01-10 00:00:00"), *st.DAILY_REFRESH, unit="day")
    got = spark.range(1).select(first.alias("f"), last.alias("l")).head()
    assert (got.f.day, got.l.day) == (7, 9)


def test_latest_executions_without_dispatch(spark):
    runs = spark.createDataFrame(
        [(1, "2024-01-01", 10), (2, "2024-01-02", 11), (3, "2024-01-02", 99)], "execution_id int, execution_time string, topology_id int"
    )
    cases = spark.createDataFrame([(10, "a"), (11, "b")], "topology_id int, case_name string")
    dispatch = spark.createDataFrame([(2, "g"), (2, "g"), (2, "h")], "execution_id int, generator_id string")
    got = reports.latest_executions(runs, cases, dispatch, n=2)
    assert rows(got, "execution_id", "case_name", "num_generators_dispatched") == [(2, "b", 2), (3, None, 0)]


def test_price_matches_equal_the_pairs(spark):
    dispatch = spark.createDataFrame(
        [("e", 1, "g", 2.0), ("e", 1, "h", 3.0), ("e", 2, "g", 5.0)],
        "execution_id string, time_step int, generator_id string, active_power_mw double",
    )
    prices = spark.createDataFrame(
        [("e", 1, 10.0), ("e", 1, 20.0), ("e", 1, 30.0), ("f", 1, 1.0)],
        "execution_id string, time_step int, lmp_total double",
    )
    pairs = dispatch.join(prices, ["execution_id", "time_step"]).collect()
    got = reports.price_matches(dispatch, prices).head()
    assert got.pairs == len(pairs) == 6
    assert got.mw_price_sum == sum(r.active_power_mw * r.lmp_total for r in pairs)
    assert got.price_sum == sum(r.lmp_total for r in pairs)


def test_shared_folder_follows_one_rule():
    from gridlake import session

    class Fake:
        def __init__(self, settings):
            self.conf = settings

    warehouse = {"spark.sql.warehouse.dir": "file:/w"}
    assert session.shared_dir(Fake(warehouse)) == "file:/w/_scratch"
    assert session.shared_dir(Fake({**warehouse, "spark.checkpoint.dir": "hdfs://x/c/"})) == "hdfs://x/c"


def test_retention_is_per_table(spark):
    from gridlake.sinks import tables

    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS time")
    now = F.to_timestamp_ntz(F.lit("2024-03-01 00:00:00"))
    assert tables.apply_table_retention(df, "renewable_forecasts", now).count() == 0
    assert tables.apply_table_retention(df, "power_measurements", now).count() == 1
    assert tables.apply_table_retention(df, "load_measurements", now + F.expr("INTERVAL 9 YEAR")).count() == 1
