"""Appends to every kind of table, read back; exports; refresh by day."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import quality as q
from gridlake.operators import rollups
from gridlake.operators import scenarios as sc
from gridlake.operators.joins import new_cases
from gridlake.queries.mapping import power
from gridlake.queries.quality import RULES, arrival
from gridlake.queries.registry import ORACLE, Tables, as_of, query, rounded
from gridlake.queries.scenario import _branches, _units
from gridlake.session import fresh_path
from gridlake.sinks import once
from gridlake.sinks import tables as sinks
from gridlake.sources import tables as sources
from gridlake.streaming import measurements as st


@query("contingency_append", """
SELECT CAST(p_partkey % 25 AS INTEGER)::BIGINT AS topology_id, 'N-1_B' || p_partkey AS contingency_name,
       'B' || p_partkey AS branches, 2 AS severity_level FROM part
UNION ALL SELECT s_nationkey::BIGINT, 'N-1_' || s_name, NULL, 3 FROM supplier""")
def contingency_append(t):
    """Appended, and offered again: topologies that are there are not added twice."""
    path = fresh_path(t.spark, "contingencies")
    found = sc.n1_contingencies(_branches(t), _units(t))
    sinks.append_results(found, schemas.CONTINGENCIES, path)
    stored = sources.read_table(t.spark, path)
    sinks.append_results(new_cases(found, stored, "topology_id"), schemas.CONTINGENCIES, path)
    return sources.read_table(t.spark, path).select(
        "topology_id", "contingency_name", F.array_join("affected_branches", ",").alias("branches"), "severity_level"
    )


@query("bus_results_append", """
SELECT 'run-1' AS execution_id, l_linenumber AS time_step, CAST(l_partkey AS VARCHAR) AS bus_id,
       l_returnflag AS scenario_type, l_extendedprice AS lmp_energy, l_tax AS lmp_loss
FROM lineitem""")
def bus_results_append(t):
    path = fresh_path(t.spark, "bus-results")
    rows = t.lineitem.select(
        F.col("l_tax").alias("lmp_loss"),
        F.col("l_extendedprice").alias("lmp_energy"),
        F.col("l_partkey").alias("bus_id"),
        F.col("l_linenumber").alias("time_step"),
        F.col("l_returnflag").alias("scenario_type"),
    )
    sinks.append_results(sinks.tag_results(rows, "run-1"), schemas.BUS_RESULTS, path)
    return sources.read_table(t.spark, path).select(
        "execution_id", "time_step", "bus_id", "scenario_type", "lmp_energy", "lmp_loss"
    )


@query("results_once", """
SELECT CAST(l_linenumber AS VARCHAR) AS execution_id, count(*) AS result_rows, sum(l_quantity) AS active_power_mw
FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1""")
def results_once(t):
    """Three executions stored, two of them offered again, before and after the folders are merged."""
    path = fresh_path(t.spark, "results-once")
    lines = t.lineitem.select(F.col("l_quantity").alias("active_power_mw"), "l_linenumber")

    def offer(run: int) -> None:
        rows = sinks.tag_results(lines.filter(F.col("l_linenumber") == run), str(run))
        once.append_once(rows, path, str(run), schemas.DISPATCH_RESULTS)

    for run in (1, 2, 1):
        offer(run)
    once.compact_once(t.spark, path, schemas.DISPATCH_RESULTS)
    for run in (2, 3):
        offer(run)
    stored = once.read_once(t.spark, path, schemas.DISPATCH_RESULTS)
    return stored.groupBy("execution_id").agg(
        F.count(F.lit(1)).alias("result_rows"), F.sum("active_power_mw").alias("active_power_mw")
    )


@query("measurements_once", """
SELECT event_id, ts AS time, value FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'""")
def measurements_once(t):
    """All events in two loads, each of them run twice; three days read back by their folders."""
    path = fresh_path(t.spark, "measurements-once")
    rows = t.events.select("event_id", F.col("ts").alias("time"), "value")
    purchase = F.col("event_type").eqNullSafe("purchase")
    for batch, chosen in 2 * [("purchases", purchase), ("others", ~purchase)]:
        some = t.events.filter(chosen).select("event_id", F.col("ts").alias("time"), "value")
        once.append_once(some, path, batch, time="time")
    return once.read_once(t.spark, path, rows.schema, dates=("2024-01-10", "2024-01-12"))


@query("convergence_append", """
SELECT CAST(o_custkey AS VARCHAR) AS execution_id,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS iteration,
       o_totalprice AS objective_value, NULL::DOUBLE AS dual_residual FROM orders""")
def convergence_append(t):
    """The history lacks the dual residual: its column is there and empty."""
    from pyspark.sql import Window

    order = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    rows = t.orders.select(
        F.col("o_custkey").alias("execution_id"),
        F.row_number().over(order).alias("iteration"),
        F.col("o_totalprice").alias("objective_value"),
    )
    path = fresh_path(t.spark, "convergence")
    sinks.append_results(rows, schemas.CONVERGENCE_HISTORY, path)
    return sources.read_table(t.spark, path).select(
        "execution_id", "iteration", "objective_value", "dual_residual"
    )


@query("quality_metrics_append", ORACLE["metric_rows"])
def quality_metrics_append(t):
    """Metric rows stored in their table."""
    report = q.run_suite(power(t), RULES, by=["case_name"], arrival=arrival())
    path = fresh_path(t.spark, "quality-metrics")
    rows = q.metric_rows(report, "power_measurements", as_of())
    sinks.append_results(rows, schemas.QUALITY_METRICS, path)
    return rounded(sources.read_table(t.spark, path), "metric_value", digits=6).drop("details")


@query("daily_refresh", """
WITH src AS (
  SELECT * FROM events WHERE event_type <> 'error' AND ts < TIMESTAMP '2024-01-17'
  UNION ALL
  SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-17' AND ts < TIMESTAMP '2024-01-19')
SELECT date_trunc('day', ts) AS day, user_id AS generator_id, max(value) AS peak_generation,
       round(sum(value), 4) AS total_generation_mwh FROM src GROUP BY 1, 2""")
def daily_refresh(t):
    """A refresh of whole days adds the late errors of its days and no older ones."""

    def daily(rows):
        renamed = rows.select(F.col("ts").alias("time"), F.col("user_id").alias("generator_id"), "value")
        return rollups.daily_stats(renamed, ["generator_id"], power="value", cost="value")

    path = fresh_path(t.spark, "daily")
    early = t.events.filter((F.col("event_type") != "error") & (F.col("ts") < as_of("2024-01-19 00:00:00")))
    st.refresh_rollup(daily(early), path, bucket="day")
    start, end = st.DAILY_REFRESH
    bounds = st.refresh_bounds(as_of("2024-01-20 00:00:00"), start, end, unit="day")
    st.refresh_rollup(daily(st.refresh_window(t.events, bounds, "ts")), path, bounds, bucket="day")
    stored = rounded(sources.read_table(t.spark, path), "total_generation_mwh")
    return stored.select("day", "generator_id", "peak_generation", "total_generation_mwh")


@query("index_sets", """
SELECT CAST(s_suppkey AS VARCHAR) AS source, CAST(s_nationkey AS VARCHAR) AS county,
       CASE WHEN s_suppkey % 5 = 0 THEN 1000.0 ELSE abs(s_acctbal) END AS value FROM supplier""")
def index_sets(t):
    """A set and a sparse parameter from CSV files; entries without a row have the default."""
    from gridlake.operators.solution import DISTANCE_DEFAULT, with_parameter

    def table(df, name: str, columns: str):
        path = fresh_path(t.spark, name)
        sinks.write_csv(df, path)
        return sources.read_csv_table(t.spark, path, schemas._schema(columns))

    pairs = t.supplier.select(F.col("s_suppkey").alias("source"), F.col("s_nationkey").alias("county"))
    known = t.supplier.filter(F.col("s_suppkey") % 5 != 0).select(
        F.col("s_suppkey").alias("source"), F.col("s_nationkey").alias("county"), F.abs("s_acctbal").alias("value")
    )
    return with_parameter(
        table(pairs, "pairs", "source string, county string"),
        table(known, "distance", "source string, county string, value double"),
        ["source", "county"], "value", DISTANCE_DEFAULT,
    )


def _export(t: Tables, kind: str, keys: list):
    solution = t.lineitem.groupBy(*keys).agg(F.sum("l_quantity").alias("amount"))
    path = fresh_path(t.spark, kind)
    sinks.write_solution_csv(solution, path, kind)
    back = t.spark.read.option("header", True).csv(path)
    last = back.columns[-1]
    return back.withColumn(last, F.col(last).cast("double"))


@query("solution_energy_csv", """
SELECT l_returnflag AS Tech, CAST(l_suppkey AS VARCHAR) AS County, CAST(year(l_shipdate) AS VARCHAR) AS Year,
       sum(l_quantity) AS Energy FROM lineitem GROUP BY 1, 2, 3""")
def solution_energy_csv(t):
    return _export(t, "energy", ["l_returnflag", "l_suppkey", F.year("l_shipdate")])


@query("solution_transport_csv", """
SELECT l_returnflag AS Tech, CAST(l_suppkey AS VARCHAR) AS County, l_linestatus AS Basin,
       CAST(year(l_shipdate) AS VARCHAR) AS Year, sum(l_quantity) AS Amount FROM lineitem GROUP BY 1, 2, 3, 4""")
def solution_transport_csv(t):
    return _export(t, "co2_transport", ["l_returnflag", "l_suppkey", "l_linestatus", F.year("l_shipdate")])


@query("solution_sequestration_csv", """
SELECT l_linestatus AS Basin, CAST(year(l_shipdate) AS VARCHAR) AS Year, sum(l_quantity) AS Amount
FROM lineitem GROUP BY 1, 2""")
def solution_sequestration_csv(t):
    return _export(t, "co2_sequestration", ["l_linestatus", F.year("l_shipdate")])


@query("profile_by_place", """
SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS BIGINT) AS hour_index, round(coalesce(p, 0), 4) AS view
FROM (SELECT date_trunc('hour', ts) AS h, sum(CASE WHEN event_type = 'view' THEN value END) AS p
      FROM events GROUP BY 1) e""")
def profile_by_place(t):
    """The hour of a profile without an order column is its place in the file."""
    from gridlake.queries.series import wide

    folder = fresh_path(t.spark, "profile-places")
    # One file, as profile files are: an hour per row, so its length does not grow with the data.
    ordered = wide(t).orderBy("hour_index").select("view").na.fill(0.0).coalesce(1)
    sinks.write_csv(ordered, f"{folder}/load.csv", False)
    profile = sources.read_profiles(t.spark, folder, "load")
    return rounded(profile.withColumn("hour_index", F.col("hour_index").cast("bigint")), "view")
