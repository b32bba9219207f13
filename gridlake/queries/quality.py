"""Quality rules and verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import quality as q
from gridlake.operators import rollups
from gridlake.operators.ordered import number_bucket
from gridlake.queries.mapping import POWER_SQL, dispatch, executions, power
from gridlake.queries.registry import AS_OF, as_of, query, rounded

RULES = [
    q.between("voltage_magnitude", 0.5, 150.0, 0.9),
    q.between("active_power_mw", 0, 500),
    q.not_null("bus_id"),
    q.in_set("case_name", ["view", "click", "purchase", "signup"], 0.5),
    q.increasing("time"),
    q.at_least("active_power_mw", "reactive_power_mvar", 0.5),
]


def arrival():
    return q.Arrival(["bus_id"], ["event_id"], number_bucket("event_id"))


def _rule_sql(rule: str, mostly: float, holds: str, evaluated: str, group: str = "") -> str:
    by = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    return f"""
    SELECT {by}'{rule}' AS rule, {mostly} AS mostly, CAST(count({evaluated}) AS BIGINT) AS evaluated,
           CAST(coalesce(sum(CASE WHEN {evaluated} IS NOT NULL AND NOT ({holds}) THEN 1 ELSE 0 END), 0)
                AS BIGINT) AS unexpected
    FROM stepped{tail}"""


def _report_sql(group: str = "") -> str:
    parts = [
        _rule_sql("between(voltage_magnitude)", 0.9, "voltage_magnitude BETWEEN 0.5 AND 150", "voltage_magnitude", group),
        _rule_sql("between(active_power_mw)", 1.0, "active_power_mw BETWEEN 0 AND 500", "active_power_mw", group),
        _rule_sql("not_null(bus_id)", 1.0, "bus_id IS NOT NULL", "1", group),
        _rule_sql("in_set(case_name)", 0.5, "case_name IN ('view','click','purchase','signup')", "case_name", group),
        _rule_sql("increasing(time)", 1.0, "prev IS NULL OR time >= prev", "time", group),
        _rule_sql("at_least(active_power_mw,reactive_power_mvar)", 0.5,
                  "active_power_mw >= reactive_power_mvar", "active_power_mw", group),
    ]
    by = f"{group}, " if group else ""
    return f"""
WITH {POWER_SQL},
stepped AS (SELECT *, lag(time) OVER (PARTITION BY bus_id ORDER BY event_id) AS prev FROM power),
report AS ({" UNION ALL ".join(parts)})
SELECT {by}rule, CAST(mostly AS DOUBLE) AS mostly, evaluated, unexpected,
       round(1 - unexpected / evaluated, 6) AS share,
       (evaluated - unexpected >= mostly * evaluated) AS success
FROM report"""


@query("rules_report", _report_sql())
def rules_report(t):
    report = q.run_suite(power(t), RULES, arrival=arrival())
    return rounded(report, "share", digits=6).drop("kind", "column_name")


@query("rules_by_case", _report_sql("case_name"))
def rules_by_case(t):
    report = q.run_suite(power(t), RULES, by=["case_name"], arrival=arrival())
    return rounded(report, "share", digits=6).drop("kind", "column_name")


@query("suite_summary", f"""
WITH full_report AS ({_report_sql("case_name")})
SELECT case_name, count(*) AS evaluated_rules,
       CAST(sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS successful_rules,
       CAST(sum(CASE WHEN success THEN 0 ELSE 1 END) AS BIGINT) AS failed_rules,
       min(success) AS success
FROM full_report GROUP BY 1""")
def suite_summary(t):
    return q.suite_summary(
        q.run_suite(power(t), RULES, by=["case_name"], arrival=arrival()), ["case_name"]
    )


@query("metric_rows", f"""
WITH full_report AS ({_report_sql("case_name")})
SELECT TIMESTAMP '{AS_OF}' AS check_time, 'power_measurements' AS table_name,
       CASE WHEN rule LIKE 'not_null%' THEN 'COMPLETENESS'
            WHEN rule LIKE 'between%' OR rule LIKE 'in_set%' THEN 'VALIDITY'
            ELSE 'CONSISTENCY' END AS metric_type,
       rule AS metric_name, share AS metric_value,
       CASE WHEN NOT success THEN 'FAIL' WHEN unexpected > 0 THEN 'WARNING' ELSE 'PASS' END AS pass_fail,
       unexpected AS affected_records
FROM full_report""")
def metric_rows(t):
    report = q.run_suite(power(t), RULES, by=["case_name"], arrival=arrival())
    rows = q.metric_rows(report, "power_measurements", as_of())
    return rounded(rows, "metric_value", digits=6).drop("details")


@query("strict_suite", """
WITH m AS (SELECT value, value * 2 AS p, value * 0.5 AS r FROM events),
f AS (SELECT *, p / nullif(sqrt(p * p + r * r), 0) AS pf FROM m)
SELECT 'between(voltage_magnitude)' AS rule, count(value) AS evaluated,
       CAST(sum(CASE WHEN value NOT BETWEEN 0.95 AND 1.05 THEN 1 ELSE 0 END) AS BIGINT) AS unexpected,
       sum(CASE WHEN value BETWEEN 0.95 AND 1.05 THEN 1 ELSE 0 END) >= 0.98 * count(value) AS success FROM f
UNION ALL
SELECT 'between(power_factor)', count(pf),
       CAST(sum(CASE WHEN pf NOT BETWEEN -1 AND 1 THEN 1 ELSE 0 END) AS BIGINT),
       sum(CASE WHEN pf BETWEEN -1 AND 1 THEN 1 ELSE 0 END) >= count(pf) FROM f
UNION ALL
SELECT 'between(frequency_hz)', count(*), CAST(0 AS BIGINT), TRUE FROM f
UNION ALL
SELECT 'not_null(active_power_mw)', count(*),
       CAST(sum(CASE WHEN p IS NULL THEN 1 ELSE 0 END) AS BIGINT), sum(CASE WHEN p IS NULL THEN 1 ELSE 0 END) = 0
FROM f""")
def strict_suite(t):
    from gridlake.operators.derived import with_power_factor

    df = with_power_factor(power(t)).withColumn("frequency_hz", F.lit(60.0))
    return q.run_suite(df, q.STRICT_POWER_SUITE).select("rule", "evaluated", "unexpected", "success")


@query("branch_suite", """
SELECT 'between(loading_percentage)' AS rule, count(l_quantity) AS evaluated,
       CAST(sum(CASE WHEN l_quantity * 2.5 BETWEEN 0 AND 120 THEN 0 ELSE 1 END) AS BIGINT) AS unexpected,
       sum(CASE WHEN l_quantity * 2.5 BETWEEN 0 AND 120 THEN 1 ELSE 0 END)
         >= 0.99 * count(l_quantity) AS success FROM lineitem
UNION ALL
SELECT 'at_least(from_bus_active_power_mw,to_bus_active_power_mw)', count(*),
       CAST(sum(CASE WHEN l_discount >= l_tax THEN 0 ELSE 1 END) AS BIGINT),
       sum(CASE WHEN l_discount >= l_tax THEN 1 ELSE 0 END) >= 0.5 * count(*) FROM lineitem""")
def branch_suite(t):
    df = t.lineitem.select(
        (F.col("l_quantity") * 2.5).alias("loading_percentage"),
        F.col("l_discount").alias("from_bus_active_power_mw"),
        F.col("l_tax").alias("to_bus_active_power_mw"),
    )
    return q.run_suite(df, q.BRANCH_SUITE).select("rule", "evaluated", "unexpected", "success")


@query("generator_suite", """
WITH g AS (SELECT value AS p, value * 3 AS cost,
    CASE event_type WHEN 'view' THEN 'THERMAL' WHEN 'click' THEN 'HYDRO' WHEN 'error' THEN 'SYNC_COND'
         ELSE 'WIND' END AS kind FROM events)
SELECT 'between(active_power_mw)' AS rule, count(p) AS evaluated, CAST(0 AS BIGINT) AS unexpected FROM g
UNION ALL SELECT 'in_set(commitment_status)', count(*), CAST(0 AS BIGINT) FROM g
UNION ALL SELECT 'in_set(generator_type)', count(kind),
   CAST(sum(CASE WHEN kind = 'SYNC_COND' THEN 1 ELSE 0 END) AS BIGINT) FROM g
UNION ALL SELECT 'between(marginal_cost)', count(cost),
   CAST(sum(CASE WHEN cost > 1000 THEN 1 ELSE 0 END) AS BIGINT) FROM g""")
def generator_suite(t):
    """A synchronous condenser is produced by the fuel map but is no valid type."""
    kind = (
        F.when(F.col("event_type") == "view", "THERMAL")
        .when(F.col("event_type") == "click", "HYDRO")
        .when(F.col("event_type") == "error", "SYNC_COND")
        .otherwise("WIND")
    )
    df = t.events.select(
        F.col("value").alias("active_power_mw"),
        F.lit(True).alias("commitment_status"),
        kind.alias("generator_type"),
        (F.col("value") * 3).alias("marginal_cost"),
    )
    return q.run_suite(df, q.GENERATOR_SUITE).select("rule", "evaluated", "unexpected")


@query("order_check", """
SELECT user_id AS bus_id, CAST(sum(CASE WHEN prev IS NOT NULL AND value < prev THEN 1 ELSE 0 END) AS BIGINT)
       AS unexpected, count(*) AS evaluated
FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events) e
GROUP BY 1""")
def order_check(t):
    """The rule on a column that does go down: falls of the value per bus."""
    df = power(t).withColumnRenamed("voltage_magnitude", "v")
    report = q.run_suite(df, [q.increasing("v")], by=["bus_id"], arrival=arrival())
    return report.select("bus_id", "evaluated", "unexpected")


@query("pair_rule", """
SELECT l_returnflag, count(*) AS evaluated,
       CAST(sum(CASE WHEN l_discount >= l_tax THEN 0 ELSE 1 END) AS BIGINT) AS unexpected,
       sum(CASE WHEN l_discount >= l_tax THEN 1 ELSE 0 END) >= 0.5 * count(*) AS success
FROM lineitem GROUP BY 1""")
def pair_rule(t):
    report = q.run_suite(t.lineitem, [q.at_least("l_discount", "l_tax", 0.5)], ["l_returnflag"])
    return report.select("l_returnflag", "evaluated", "unexpected", "success")


@query("quarantine", """
SELECT event_id, voltage_magnitude FROM (SELECT event_id, value AS voltage_magnitude, event_type FROM events) e
WHERE voltage_magnitude BETWEEN 0.5 AND 150 AND event_type IN ('view', 'click')""")
def quarantine(t):
    """The soft gate passing on only rows that break no rule."""
    rules = [q.between("voltage_magnitude", 0.5, 150.0), q.in_set("case_name", ["view", "click"])]
    return q.apply_gate(power(t), rules, "quarantine").select("event_id", "voltage_magnitude")


_VERDICT = f"""
WITH cases AS (
  SELECT DISTINCT event_type AS case_name FROM events
  UNION ALL SELECT DISTINCT o_orderstatus FROM orders),
p AS (SELECT event_type AS case_name,
        sum(CASE WHEN value BETWEEN 0.5 AND 150 THEN 1 ELSE 0 END) >= 0.97 * count(*) AS ok
      FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR GROUP BY 1),
g AS (SELECT event_type AS case_name,
        sum(CASE WHEN value * 2 BETWEEN 0 AND 400 THEN 1 ELSE 0 END) >= 0.99 * count(*) AS ok
      FROM events WHERE event_type <> 'click' AND ts >= TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR
      GROUP BY 1)
SELECT c.case_name, p.ok AS power_ok, g.ok AS generator_ok,
       CASE WHEN p.ok IS NULL THEN 'no power data' WHEN NOT p.ok THEN 'power rules failed'
            WHEN NOT coalesce(g.ok, TRUE) THEN 'generator rules failed' END AS reason,
       p.ok IS NOT NULL AND p.ok AND coalesce(g.ok, TRUE) AS success
FROM cases c LEFT JOIN p USING (case_name) LEFT JOIN g USING (case_name)"""


def _verdict(t):
    """Order states stand for cases without any measurement."""
    cases = power(t).select("case_name").unionByName(
        executions(t).select(F.col("convergence_status").alias("case_name"))
    )
    recent = rollups.since(power(t), as_of(), 168)
    power_report = q.run_suite(recent, [q.between("voltage_magnitude", 0.5, 150.0, 0.97)], ["case_name"])
    gen_report = q.run_suite(
        recent.filter(F.col("case_name") != "click"),
        [q.between("active_power_mw", 0, 400, 0.99)],
        ["case_name"],
    )
    return q.case_verdict(cases, power_report, gen_report)


@query("case_verdict", _VERDICT)
def case_verdict(t):
    return _verdict(t)


@query("validation_totals", f"""
SELECT count(*) AS total_cases, CAST(sum(CASE WHEN success THEN 1 ELSE 0 END) AS BIGINT) AS passed,
       CAST(sum(CASE WHEN success THEN 0 ELSE 1 END) AS BIGINT) AS failed
FROM ({_VERDICT}) v""")
def validation_totals(t):
    return q.verdict_totals(_verdict(t))


@query("result_gate", """
WITH requested AS (
  SELECT o_orderkey AS execution_id FROM orders UNION SELECT o_orderkey + 10000000 FROM orders),
d AS (SELECT l_orderkey AS execution_id, count(*) AS n FROM lineitem GROUP BY 1)
SELECT r.execution_id, coalesce(d.n, 0) AS dispatch_rows,
       CASE WHEN o.o_orderkey IS NULL THEN 'execution not found'
            WHEN o.o_orderstatus <> 'F' THEN 'not converged'
            WHEN coalesce(d.n, 0) = 0 THEN 'no dispatch results' END AS reason,
       o.o_orderkey IS NOT NULL AND o.o_orderstatus = 'F' AND coalesce(d.n, 0) > 0 AS success
FROM requested r LEFT JOIN orders o ON r.execution_id = o.o_orderkey
LEFT JOIN d ON r.execution_id = d.execution_id""")
def result_gate(t):
    """Known executions, and as many unknown ids."""
    known = executions(t).select("execution_id")
    unknown = known.select((F.col("execution_id") + 10000000).alias("execution_id"))
    return q.result_gate(known.unionByName(unknown), executions(t), dispatch(t), converged="F")


@query("daily_input_quality", f"""
WITH recent AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR),
stepped AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM recent)
SELECT event_type AS case_name, count(*) AS evaluated,
       CAST(sum(CASE WHEN value / 100 BETWEEN 0.85 AND 1.15 THEN 0 ELSE 1 END) AS BIGINT) AS bad_voltage,
       CAST(sum(CASE WHEN prev IS NOT NULL AND ts < prev THEN 1 ELSE 0 END) AS BIGINT) AS bad_order
FROM stepped GROUP BY 1""")
def daily_input_quality(t):
    """The power suite over the last day, two of its rules shown."""
    df = power(t).withColumns(
        {
            "voltage_magnitude": F.col("voltage_magnitude") / 100,
            "voltage_angle_rad": F.lit(0.0),
            "frequency_hz": F.lit(60.0),
            "measurement_quality": F.lit(100),
        }
    )
    report = q.run_suite(
        rollups.since(df, as_of(), 24), q.POWER_SUITE, ["case_name"], arrival()
    )
    picked = lambda rule: F.max(F.when(F.col("rule") == rule, F.col("unexpected")))
    return report.groupBy("case_name").agg(
        F.max("evaluated").alias("evaluated"),
        picked("between(voltage_magnitude)").alias("bad_voltage"),
        picked("increasing(time)").alias("bad_order"),
    )
