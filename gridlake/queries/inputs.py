"""Files and tables written and read back: CSV inputs, result tables, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import convert
from gridlake.queries.mapping import UNIT_TYPE_SQL, UNITS_SQL, dispatch, power, units
from gridlake.queries.registry import AS_OF, Tables, as_of, query, rounded
from gridlake.session import fresh_path
from gridlake.sinks import tables as sinks
from gridlake.sources import tables as sources


def _csv(t: Tables, df: DataFrame, label: str) -> str:
    path = fresh_path(t.spark, label)
    sinks.write_csv(df, path, quote_all=False)
    return path


@query("csv_buses", """
SELECT 'RTS' AS case_name, s_suppkey AS number, s_name AS name, 138.0::DOUBLE AS base_voltage,
       CAST(s_nationkey AS VARCHAR) AS area, 0.95::DOUBLE AS voltage_min,
       round(1 + s_nationkey / 100, 4) AS voltage_max, 1.0::DOUBLE AS voltage_magnitude
FROM supplier""")
def csv_buses(t):
    """A bus file with an upper but no lower voltage limit."""
    file = t.supplier.select(
        F.col("s_name").alias("Bus Name"),
        F.col("s_suppkey").alias("Bus ID"),
        F.lit(138.0).alias("BaseKV"),
        F.col("s_nationkey").alias("Area"),
        F.lit("Z1").alias("Zone"),
        (1 + F.col("s_nationkey") / 100).alias("Vmax"),
    )
    table = sources.read_csv_table(t.spark, _csv(t, file, "bus"), schemas.BUS_CSV)
    return rounded(convert.rts_buses(table, "RTS"), "voltage_max").select(
        "case_name", "number", "name", "base_voltage", "area", "voltage_min", "voltage_max",
        "voltage_magnitude",
    )


@query("csv_generators", f"""
WITH {UNITS_SQL}
SELECT name, bus_number, coalesce(s_name, 'Bus' || bus_number) AS bus_name, {UNIT_TYPE_SQL} AS type,
       pmin, pmax, -pmax AS qmin, pmax AS qmax, round(pmin * 60, 4) AS ramp_up,
       round(pmin * 10, 4) AS cost_linear, pmin AS marginal_cost, 0.0::DOUBLE AS startup_cost, fuel,
       '' AS unit_group
FROM units LEFT JOIN supplier ON s_suppkey = bus_number""")
def csv_generators(t):
    """A unit file without reactive limits, heat rates and unit groups."""
    file = units(t).select(
        F.col("name").alias("GEN UID"),
        F.col("bus_number").alias("Bus ID"),
        F.col("fuel").alias("Fuel"),
        F.col("pmin").alias("PMin MW"),
        F.col("pmax").alias("PMax MW"),
        F.col("pmin").alias("Ramp Rate MW/Min"),
        F.col("pmin").alias("Fuel Price $/MMBTU"),
    )
    buses = t.supplier.select(
        F.lit("RTS").alias("case_name"),
        F.col("s_suppkey").alias("number"),
        F.col("s_name").alias("name"),
    )
    table = sources.read_csv_table(t.spark, _csv(t, file, "gen"), schemas.GEN_CSV)
    rows = convert.rts_generators(table, "RTS", buses)
    return rounded(rows, "ramp_up", "cost_linear").select(
        "name", "bus_number", "bus_name", "type", "pmin", "pmax", "qmin", "qmax", "ramp_up",
        "cost_linear", "marginal_cost", "startup_cost", "fuel", "unit_group",
    )


@query("csv_branches", """
SELECT 'B' || p_partkey AS name, p_partkey AS from_bus, p_partkey + 1 AS to_bus,
       coalesce(s_name, 'Bus' || p_partkey) AS from_bus_name, 0.0::DOUBLE AS shunt_susceptance,
       p_retailprice AS rating, CASE WHEN p_size % 3 = 1 THEN 0.95 ELSE 1.0 END::DOUBLE AS ratio,
       CASE WHEN p_size % 3 = 1 THEN 'transformer' ELSE 'line' END AS type
FROM part LEFT JOIN supplier ON s_suppkey = p_partkey""")
def csv_branches(t):
    file = t.part.select(
        F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("UID"),
        F.col("p_partkey").alias("From Bus"),
        (F.col("p_partkey") + 1).alias("To Bus"),
        F.lit(0.01).alias("R"),
        F.lit(0.1).alias("X"),
        F.col("p_retailprice").alias("Cont Rating"),
        F.when(F.col("p_size") % 3 == 0, 0.0)
        .when(F.col("p_size") % 3 == 1, 0.95)
        .otherwise(1.0)
        .alias("Tr Ratio"),
    )
    buses = t.supplier.select(
        F.lit("RTS").alias("case_name"),
        F.col("s_suppkey").alias("number"),
        F.col("s_name").alias("name"),
    )
    table = sources.read_csv_table(t.spark, _csv(t, file, "branch"), schemas.BRANCH_CSV)
    return convert.rts_branches(table, "RTS", buses).select(
        "name", "from_bus", "to_bus", "from_bus_name", "shunt_susceptance", "rating", "ratio", "type"
    )


@query("custom_loads", """
SELECT ts AS time, 'Load_' || user_id AS load_id, CAST(user_id AS VARCHAR) AS bus_id,
       value AS active_power_mw, round(value * 0.3, 6) AS reactive_power_mvar, 'CUSTOM' AS source
FROM events""")
def custom_loads(t):
    file = t.events.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("user_id").alias("bus_id"),
        F.col("value").alias("active_power_mw"),
        F.round(F.col("value") * 0.3, 6).alias("reactive_power_mvar"),
    )
    rows = sources.read_custom_loads(t.spark, _csv(t, file, "custom"), "C1")
    return rows.select(
        "time", "load_id", "bus_id", "active_power_mw", "reactive_power_mvar", "source"
    )


@query("text_filter", """
SELECT event_id, strftime(ts, '%Y-%m-%d') || ' ' || event_type AS stamp FROM events
WHERE event_type LIKE '%ur%'""")
def text_filter(t):
    stamped = t.events.select(
        "event_id",
        F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" "), "event_type").alias("stamp"),
    )
    return sources.rows_with_marker(stamped, "stamp", "ur")


@query("profile_folder", """
SELECT CAST(date_diff('hour', TIMESTAMP '2024-01-01', date_trunc('hour', ts)) AS INTEGER) AS hour_index,
       round(sum(CASE WHEN event_type = 'view' THEN value END), 4) AS view,
       round(sum(CASE WHEN event_type = 'click' THEN value END), 4) AS click
FROM events GROUP BY 1""")
def profile_folder(t):
    """A wide profile with an order column, written as several files."""
    from gridlake.queries.series import wide

    folder = fresh_path(t.spark, "profiles")
    sinks.write_csv(wide(t).select("hour_index", "view", "click"), f"{folder}/load.csv", False)
    profile = sources.read_profiles(t.spark, folder, "load", order_column="hour_index")
    return rounded(profile, "view", "click")


@query("profile_stems", "SELECT event_type AS stem, count(*) AS rows FROM events GROUP BY 1")
def profile_stems(t):
    """The stems of a folder with one profile per event type, and their rows."""
    folder = fresh_path(t.spark, "stems")
    for stem in ("click", "error", "purchase", "signup", "view"):
        part = t.events.filter(F.col("event_type") == stem).select("event_id", "value")
        sinks.write_csv(part, f"{folder}/{stem}.csv", quote_all=False)
    return sources.profile_stems(t.spark, folder)


@query("solution_csv", """
SELECT l_returnflag AS Resource, CAST(l_suppkey AS VARCHAR) AS SourceCounty,
       CAST(l_partkey AS VARCHAR) AS ProdCounty, CAST(year(l_shipdate) AS VARCHAR) AS Year,
       sum(l_quantity) AS Production
FROM lineitem GROUP BY 1, 2, 3, 4""")
def solution_csv(t):
    solution = t.lineitem.groupBy(
        "l_returnflag", "l_suppkey", "l_partkey", F.year("l_shipdate").alias("year")
    ).agg(F.sum("l_quantity").alias("amount"))
    path = fresh_path(t.spark, "solution")
    sinks.write_solution_csv(solution, path, "biomass")
    back = t.spark.read.option("header", True).csv(path)
    return back.withColumn("Production", F.col("Production").cast("double"))


@query("table_roundtrip", f"""
SELECT event_id, ts AS time, user_id AS bus_id, value FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '{AS_OF}'""")
def table_roundtrip(t):
    """Measurements appended by date and read back with a pruned range."""
    path = fresh_path(t.spark, "measurements")
    rows = t.events.select(
        "event_id", F.col("ts").alias("time"), F.col("user_id").alias("bus_id"), "value"
    )
    sinks.append_measurements(rows, path, entity="bus_id")
    return sources.read_measurements(t.spark, path, "2024-01-10 00:00:00", AS_OF).drop("date")


@query("retained_table", f"""
SELECT event_id, ts AS time, value FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY""")
def retained_table(t):
    """A stored table rewritten without its expired days."""
    path, kept = fresh_path(t.spark, "measurements"), fresh_path(t.spark, "kept")
    rows = t.events.select("event_id", F.col("ts").alias("time"), "value")
    sinks.append_measurements(rows, path)
    sinks.rewrite_retained(sources.read_table(t.spark, path), as_of(), 10, kept)
    return sources.read_table(t.spark, kept).drop("date")


@query("results_append", """
SELECT 'run-1' AS execution_id, l_linenumber AS time_step, CAST(l_suppkey AS VARCHAR) AS generator_id,
       l_returnflag AS scenario_type, l_quantity AS active_power_mw, l_extendedprice AS generation_cost
FROM lineitem""")
def results_append(t):
    """Columns are matched by name although the run id is added last."""
    path = fresh_path(t.spark, "dispatch")
    rows = sinks.tag_results(dispatch(t).drop("execution_id"), "run-1")
    sinks.append_results(rows, schemas.DISPATCH_RESULTS, path)
    return sources.read_table(t.spark, path).select(
        "execution_id", "time_step", "generator_id", "scenario_type", "active_power_mw",
        "generation_cost",
    )


@query("execution_records", """
SELECT o_custkey AS topology_id, o_totalprice AS objective_value, 24 AS optimization_horizon_hours,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'MANUAL' ELSE o_orderpriority END AS triggered_by,
       TRUE AS id_is_new
FROM orders""")
def execution_records(t):
    """Defaults for missing settings; generated ids must all differ."""
    runs = t.orders.select(
        F.col("o_custkey").alias("topology_id"),
        F.col("o_totalprice").alias("objective_value"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias(
            "triggered_by"
        ),
    )
    path = fresh_path(t.spark, "executions")
    sinks.append_results(sinks.execution_records(runs), schemas.EXECUTIONS, path)
    stored = sources.read_table(t.spark, path)
    ids = stored.groupBy("execution_id").agg(F.count(F.lit(1)).alias("_n"))
    return stored.join(ids, "execution_id").select(
        "topology_id", "objective_value", "optimization_horizon_hours", "triggered_by",
        (F.col("_n") == 1).alias("id_is_new"),
    )


@query("case_append", """
SELECT c_custkey AS topology_id, c_name AS case_name, CASE WHEN c_acctbal < 0 THEN 1 ELSE 2 END AS version
FROM customer""")
def case_append(t):
    """Loading twice adds only what is new: first the customers in debt, then all."""
    path = fresh_path(t.spark, "cases")
    named = t.customer.select(
        F.col("c_custkey").alias("topology_id"), F.col("c_name").alias("case_name"), "c_acctbal"
    )
    first = named.filter("c_acctbal < 0").withColumn("version", F.lit(1)).drop("c_acctbal")
    first.write.parquet(path)
    second = named.withColumn("version", F.lit(2)).drop("c_acctbal")
    sinks.append_new_cases(second, sources.read_table(t.spark, path), path)
    return sources.read_table(t.spark, path)


@query("report_export", """
SELECT event_type AS case_name, count(*) AS rows, round(avg(value), 4) AS mean FROM events GROUP BY 1""")
def report_export(t):
    path = fresh_path(t.spark, "report")
    report = power(t).groupBy("case_name").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("voltage_magnitude"), 4).alias("mean")
    )
    sinks.write_report(report, path)
    return t.spark.read.schema("case_name string, rows bigint, mean double").json(path)
