"""Reports on executions, dispatch and prices, on orders and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import joins, reports, rollups, scenarios, versions
from gridlake.queries.mapping import bus_results, dispatch, executions, power, topology
from gridlake.queries.registry import as_of, query, rounded


@query("latest_executions", """
WITH top AS (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100)
SELECT o_orderkey AS execution_id, o_orderdate AS execution_time, o_custkey AS topology_id,
       o_orderstatus AS convergence_status, o_totalprice AS objective_value, c_name AS case_name,
       count(DISTINCT l_suppkey) AS num_generators_dispatched
FROM top LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY ALL""")
def latest_executions(t):
    return reports.latest_executions(executions(t), topology(t), dispatch(t))


@query("dashboard_executions", """
SELECT o_orderkey AS execution_id, o_orderdate AS execution_time, o_orderstatus AS convergence_status
FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20""")
def dashboard_executions(t):
    return reports.latest_rows(
        executions(t).select("execution_id", "execution_time", "convergence_status"),
        "execution_time", "execution_id", 20,
    )


@query("dispatch_summary", """
SELECT l_orderkey AS execution_id, l_linenumber AS time_step, l_shipdate AS target_datetime,
       l_returnflag AS scenario_type, count(*) AS num_generators,
       sum(l_quantity) AS total_generation_mw,
       round(sum(l_extendedprice), 4) AS total_generation_cost,
       round(avg(l_quantity), 4) AS avg_generation_per_unit
FROM lineitem GROUP BY 1, 2, 3, 4""")
def dispatch_summary(t):
    return rounded(
        reports.dispatch_summary(dispatch(t)), "total_generation_cost", "avg_generation_per_unit"
    )


_LMP = """
SELECT l_orderkey AS execution_id, l_linenumber AS time_step, l_returnflag AS scenario_type,
       round(avg(l_extendedprice), 4) AS avg_lmp, min(l_extendedprice) AS min_lmp,
       max(l_extendedprice) AS max_lmp, round(stddev_samp(l_extendedprice), 4) AS lmp_std_dev,
       round(max(l_extendedprice) - min(l_extendedprice), 4) AS lmp_spread
FROM lineitem GROUP BY 1, 2, 3"""


def _lmp(t):
    stats = reports.lmp_statistics(bus_results(t), ["execution_id", "time_step", "scenario_type"])
    return rounded(stats, "avg_lmp", "lmp_std_dev", "lmp_spread")


@query("lmp_statistics", _LMP)
def lmp_statistics(t):
    return _lmp(t)


@query("lmp_by_step", """
SELECT l_linenumber AS time_step, l_returnflag AS scenario_type,
       round(avg(l_extendedprice), 4) AS avg_lmp, min(l_extendedprice) AS min_lmp,
       max(l_extendedprice) AS max_lmp, round(stddev_samp(l_extendedprice), 4) AS lmp_std_dev,
       round(max(l_extendedprice) - min(l_extendedprice), 4) AS lmp_spread
FROM lineitem GROUP BY 1, 2""")
def lmp_by_step(t):
    """Few large groups: everything is combined before the shuffle."""
    stats = reports.lmp_statistics(bus_results(t), ["time_step", "scenario_type"])
    return rounded(stats, "avg_lmp", "lmp_std_dev", "lmp_spread").orderBy("time_step")


@query("lmp_of_execution", f"""
SELECT * FROM ({_LMP}) s WHERE execution_id = (SELECT max(o_orderkey) FROM orders) // 2""")
def lmp_of_execution(t):
    """Price statistics of one execution by step."""
    chosen = t.orders.agg(F.max("o_orderkey")).head()[0] // 2
    rows = bus_results(t).filter(F.col("execution_id") == chosen)
    stats = reports.lmp_statistics(rows, ["execution_id", "time_step", "scenario_type"])
    return rounded(stats, "avg_lmp", "lmp_std_dev", "lmp_spread").orderBy("time_step")


@query("generation_by_step", """
SELECT l_orderkey AS execution_id, l_linenumber AS time_step, sum(l_quantity) AS total_generation,
       round(avg(l_extendedprice), 4) AS avg_cost
FROM lineitem GROUP BY 1, 2""")
def generation_by_step(t):
    return rounded(reports.generation_by_step(dispatch(t)), "avg_cost")


@query("execution_report", """
SELECT o_orderkey AS execution_id, o_orderdate AS execution_time, o_custkey AS topology_id,
       o_orderstatus AS convergence_status, o_totalprice AS objective_value,
       count(DISTINCT l_suppkey) AS num_generators,
       sum(l_quantity) AS total_generation_mw, round(sum(l_extendedprice), 4) AS total_cost
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY 1, 2, 3, 4, 5""")
def execution_report(t):
    return rounded(reports.execution_report(executions(t), dispatch(t)), "total_cost")


@query("results_per_execution", """
SELECT l_orderkey AS execution_id, count(*) AS num_results FROM lineitem
GROUP BY 1 ORDER BY 1 DESC LIMIT 5""")
def results_per_execution(t):
    return reports.results_per_execution(dispatch(t))


@query("rows_per_execution", """
SELECT l_orderkey AS execution_id, count(*) AS rows FROM lineitem GROUP BY 1""")
def rows_per_execution(t):
    return rollups.row_counts(dispatch(t), ["execution_id"])


@query("execution_dispatch", """
SELECT l_linenumber AS time_step, l_suppkey AS generator_id, l_quantity AS active_power_mw
FROM lineitem WHERE l_orderkey = (SELECT max(l_orderkey) FROM lineitem)""")
def execution_dispatch(t):
    chosen = t.lineitem.agg(F.max("l_orderkey")).head()[0]
    rows = reports.execution_rows(dispatch(t), chosen, ["time_step", "generator_id"])
    return rows.select("time_step", "generator_id", "active_power_mw")


@query("topology_catalogue", """
SELECT c_name AS case_name, c_custkey AS topology_id, r_name AS source,
       count(o_orderkey) AS num_runs
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2, 3""")
def topology_catalogue(t):
    """Counts and source per case; runs are counted before the join."""
    runs = t.orders.groupBy(F.col("o_custkey").alias("topology_id")).agg(
        F.count(F.lit(1)).alias("num_runs")
    )
    area = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("source")
    )
    return (
        t.customer.join(area, "c_nationkey", "left")
        .select(F.col("c_name").alias("case_name"), F.col("c_custkey").alias("topology_id"), "source")
        .join(runs, "topology_id", "left")
        .withColumn("num_runs", F.coalesce("num_runs", F.lit(0)))
        .orderBy("case_name")
    )


@query("topology_by_id", """
SELECT c_custkey AS topology_id, c_name AS case_name FROM customer
WHERE c_custkey = (SELECT max(c_custkey) FROM customer)""")
def topology_by_id(t):
    chosen = t.customer.agg(F.max("c_custkey")).head()[0]
    return topology(t).filter(F.col("topology_id") == chosen)


def _order_versions(t):
    """Orders as versions of their customer's case; some say when they end."""
    until = F.when(
        F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.make_dt_interval(F.lit(365))
    )
    return t.orders.select(
        F.col("o_custkey").alias("case_name"),
        F.col("o_orderkey").alias("topology_id"),
        F.col("o_orderdate").alias("valid_from"),
        until.alias("valid_until"),
    )


@query("asof_topology", """
WITH versions AS (
  SELECT o_custkey AS case_name, o_orderkey AS topology_id, o_orderdate AS valid_from,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 365 DAY END AS valid_until
  FROM orders)
SELECT case_name, topology_id, valid_from, valid_until FROM (
  SELECT *, row_number() OVER (PARTITION BY case_name ORDER BY valid_from DESC, topology_id DESC) AS rn
  FROM versions WHERE valid_until IS NULL OR valid_until > TIMESTAMP '1998-06-01') v
WHERE rn = 1""")
def asof_topology(t):
    return joins.as_of_version(_order_versions(t), as_of("1998-06-01 00:00:00")).select(
        "case_name", "topology_id", "valid_from", "valid_until"
    )


@query("valid_topology", """
WITH closed AS (
  SELECT o_custkey AS case_name, o_orderkey AS topology_id, o_orderdate AS valid_from,
         least(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 365 DAY END,
               lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) AS valid_until
  FROM orders)
SELECT l_orderkey, l_linenumber, l_suppkey AS case_name, topology_id
FROM lineitem LEFT JOIN closed
  ON case_name = l_suppkey AND valid_from <= l_shipdate AND (valid_until IS NULL OR l_shipdate < valid_until)""")
def valid_topology(t):
    """The version valid when a row was measured: an order holds until the customer's next one."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("case_name"), F.col("l_shipdate").alias("time")
    )
    return versions.with_valid_version(rows, _order_versions(t)).drop("time")


@query("dispatch_lmp_join", """
SELECT a.l_orderkey AS execution_id, a.l_linenumber AS time_step, count(*) AS pairs,
       round(sum(a.l_quantity * b.l_extendedprice), 2) AS mw_price_sum,
       round(sum(b.l_extendedprice), 4) AS price_sum,
       min(b.l_extendedprice) AS min_lmp, max(b.l_extendedprice) AS max_lmp
FROM lineitem a JOIN lineitem b
  ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
GROUP BY 1, 2""")
def dispatch_lmp_join(t):
    """The SQL forms all pairs; the operator computes the same totals without."""
    totals = reports.price_matches(dispatch(t), bus_results(t))
    return rounded(rounded(totals, "price_sum"), "mw_price_sum", digits=2)


@query("dispatch_lmp_keyed", """
WITH prices AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey, avg(l_extendedprice) AS lmp_total
  FROM lineitem GROUP BY 1, 2, 3, 4)
SELECT a.l_orderkey AS execution_id, a.l_linenumber AS time_step, a.l_returnflag AS scenario_type,
       a.l_partkey AS bus_id, a.l_suppkey AS generator_id, a.l_quantity AS active_power_mw,
       round(b.lmp_total, 4) AS lmp_total
FROM lineitem a JOIN prices b USING (l_orderkey, l_linenumber, l_returnflag, l_partkey)""")
def dispatch_lmp_keyed(t):
    rows = reports.dispatch_with_price(dispatch(t), bus_results(t))
    return rounded(rows, "lmp_total").select(
        "execution_id", "time_step", "scenario_type", "bus_id", "generator_id",
        "active_power_mw", "lmp_total",
    )


def _history(t):
    """Events as iterations: the arrival number counts them, values are residuals."""
    return t.events.select(
        F.col("user_id").alias("execution_id"),
        F.col("event_id").alias("iteration"),
        (F.col("value") / 100).alias("primal_residual"),
        (F.col("value") / 1000).alias("dual_residual"),
        (F.col("value") * 10).alias("objective_value"),
        (F.col("value") / 10).alias("iteration_time_seconds"),
    )


@query("convergence_stats", """
SELECT user_id AS execution_id, round(avg(value / 10), 4) AS avg_iter_time,
       round(max(value / 100), 4) AS max_primal_res
FROM events GROUP BY 1""")
def convergence_stats(t):
    return rounded(reports.convergence_stats(_history(t)), "avg_iter_time", "max_primal_res")


@query("convergence_curve", """
SELECT event_id AS iteration, value / 100 AS primal_residual FROM events
WHERE user_id = (SELECT user_id FROM events ORDER BY ts DESC, user_id DESC LIMIT 1)""")
def convergence_curve(t):
    runs = t.events.select(
        F.col("user_id").alias("execution_id"), F.col("ts").alias("execution_time")
    )
    return reports.latest_history(_history(t), runs).select("iteration", "primal_residual")


@query("convergence_status", """
WITH h AS (SELECT user_id, event_id, value / 100 AS p, value / 1000 AS d, value * 10 AS o FROM events),
s AS (SELECT user_id, min(CASE WHEN p < 0.05 AND d < 0.05 THEN event_id END) AS stop,
             max(event_id) AS last FROM h GROUP BY 1)
SELECT s.user_id AS execution_id,
       CASE WHEN stop IS NULL THEN 'MAX_ITERATIONS' ELSE 'CONVERGED' END AS convergence_status,
       coalesce(stop, last) AS final_iteration, round(o, 4) AS objective_value
FROM s JOIN h ON h.user_id = s.user_id AND h.event_id = coalesce(stop, last)""")
def convergence_status(t):
    return rounded(scenarios.convergence_status(_history(t), 0.05), "objective_value")


@query("recent_cases_union", """
SELECT event_type AS name FROM events UNION SELECT o_orderstatus FROM orders""")
def recent_cases_union(t):
    """Distinct ids over several tables."""
    cases = power(t).select(F.col("case_name").alias("name"))
    status = executions(t).select(F.col("convergence_status").alias("name"))
    return cases.unionByName(status).distinct()
