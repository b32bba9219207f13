"""Declared columns, computed on events and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlake.operators import derived as d
from gridlake.operators.ordered import number_bucket
from gridlake.queries.registry import AS_OF, as_of, query, rounded


@query("forecast_error", """
SELECT event_id, round(value - user_id, 4) AS forecast_error_mw FROM events""")
def forecast_error(t):
    df = t.events.withColumn("user_id", F.col("user_id").cast("double"))
    return rounded(d.forecast_error(df, "value", "user_id"), "forecast_error_mw").select(
        "event_id", "forecast_error_mw"
    )


@query("ramp", """
WITH s AS (SELECT event_id, user_id, ts, value,
  lag(ts) OVER w AS pt, lag(value) OVER w AS pv FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, round(CASE WHEN ts > pt THEN
  (value - pv) / ((epoch_us(ts) - epoch_us(pt)) / 3600e6) END, 4) AS ramp_rate_actual FROM s""")
def ramp(t):
    rows = d.ramp_rates(
        t.events.select("event_id", "user_id", "ts", "value"),
        ["user_id"], "ts", "value", order=["ts", "event_id"],
    )
    return rounded(rows, "ramp_rate_actual").select("event_id", "user_id", "ramp_rate_actual")


@query("previous_output", """
SELECT event_id, user_id, coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS prev_value
FROM events""")
def previous_output(t):
    rows = d.previous_output(
        t.events.select("event_id", "user_id", "value"), ["user_id"], ["event_id"], "value",
        number_bucket("event_id", 1000),
    )
    return rows.select("event_id", "user_id", "prev_value")


@query("cumulative_time", """
SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id
  ROWS UNBOUNDED PRECEDING), 4) AS cumulative_time_seconds FROM events""")
def cumulative_time(t):
    rows = d.cumulative_time(
        t.events.select("event_id", "user_id", "value"), ["user_id"], ["event_id"], "value",
        number_bucket("event_id", 1000),
    )
    return rounded(rows, "cumulative_time_seconds").select(
        "event_id", "user_id", "cumulative_time_seconds"
    )


@query("limit_flags", """
SELECT l_orderkey, l_linenumber, l_quantity, l_quantity <= 1 + 1e-6 AS at_pmin, l_quantity >= 50 - 1e-6 AS at_pmax
FROM lineitem""")
def limit_flags(t):
    rows = t.lineitem.withColumns({"pmin": F.lit(1.0), "pmax": F.lit(50.0)})
    return d.limit_flags(rows, "l_quantity").select(
        "l_orderkey", "l_linenumber", "l_quantity", "at_pmin", "at_pmax"
    )


@query("ramp_flags", """
SELECT event_id, coalesce(abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id)) >= 50 - 1e-6, FALSE)
  AS ramp_limited FROM events""")
def ramp_flags(t):
    rows = t.events.select("event_id", "user_id", "value").withColumn("ramp_up", F.lit(50.0))
    return d.ramp_flags(
        rows, ["user_id"], ["event_id"], "value", bucket=number_bucket("event_id")
    ).select("event_id", "ramp_limited")


@query("net_injection", """
SELECT l_suppkey AS bus_id, l_linenumber AS time_step,
  round(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE -l_quantity END), 4) AS net_injection_mw
FROM lineitem GROUP BY 1, 2""")
def net_injection(t):
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("bus_id"),
        F.col("l_linenumber").alias("time_step"),
        F.col("l_quantity").alias("active_power_mw"),
        "l_linestatus",
    )
    out = d.net_injection(
        rows.filter("l_linestatus = 'F'"), rows.filter("l_linestatus <> 'F'")
    )
    return rounded(out, "net_injection_mw")


@query("lmp_parts", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
  round(l_extendedprice * (l_discount - 0.03), 4) AS lmp_gap,
  abs(l_extendedprice * (l_discount - 0.03)) <= 1e-6 AS lmp_consistent FROM lineitem""")
def lmp_parts(t):
    price = F.col("l_extendedprice")
    rows = t.lineitem.withColumns(
        {
            "lmp_energy": price * 0.9,
            "lmp_congestion": price * 0.1,
            "lmp_loss": -price * (F.col("l_discount") - 0.03),
        }
    )
    out = d.price_parts(rows, total="l_extendedprice")
    return out.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        (F.round("lmp_gap", 4) + F.lit(0.0)).alias("lmp_gap"), "lmp_consistent",
    )


@query("flow_limits", """
SELECT l_returnflag, count(*) AS rows, CAST(sum(CASE WHEN l_quantity * 2.5 >= 100 THEN 1 ELSE 0 END) AS BIGINT)
  AS constrained FROM lineitem GROUP BY 1""")
def flow_limits(t):
    rows = d.flow_limits(t.lineitem.withColumn("loading", F.col("l_quantity") * 2.5), "loading")
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("flow_constrained").alias("constrained")
    )


@query("line_losses", """
SELECT l_orderkey, l_linenumber, round(abs(l_discount - l_tax), 6) AS line_loss_mw,
  round(abs(l_discount - l_tax), 6) <= 0.045 AS loss_small FROM lineitem""")
def line_losses(t):
    rows = t.lineitem.withColumn("to_mw", -F.col("l_tax"))
    out = rounded(d.line_losses(rows, "l_discount", "to_mw", 0.045), "line_loss_mw", digits=6)
    return out.select("l_orderkey", "l_linenumber", "line_loss_mw", "loss_small")


@query("future_rows", f"SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '{AS_OF}'")
def future_rows(t):
    return d.future_rows(t.events.select("event_id", "ts"), as_of(), "ts")


@query("gap_check", """
WITH s AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pt FROM events),
g AS (SELECT *, (epoch_us(ts) - epoch_us(pt)) / 3600e6 AS gap FROM s)
SELECT user_id, count(*) AS rows, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 3600e6, 4) AS span_hours,
  round(max(gap), 4) AS widest_gap_hours, CAST(sum(CASE WHEN gap > 24 THEN 1 ELSE 0 END) AS BIGINT) AS large_gaps,
  count(*) >= 24 AND (epoch_us(max(ts)) - epoch_us(min(ts))) / 3600e6 >= 24
    AND sum(CASE WHEN gap > 24 THEN 1 ELSE 0 END) = 0 AS sufficient
FROM g GROUP BY 1""")
def gap_check(t):
    report = d.gap_report(
        t.events, ["user_id"], "ts", ["ts", "event_id"], max_gap_hours=24.0
    )
    return rounded(report, "span_hours", "widest_gap_hours")


def _forecasts(t):
    """Forecast issues per user and target hour: the target is the next full hour
    after an event, early or late issues by the payload number."""
    number = F.from_json("props", "k int")["k"]
    target = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return t.events.select(
        F.col("event_type").alias("generator_id"),
        target.alias("target_time"),
        (target + F.make_dt_interval(F.lit(0), (5 - number % 12).cast("int"))).alias("forecast_time"),
        F.col("value").alias("forecasted_power_mw"),
        (F.col("value") - 30).alias("confidence_lower_mw"),
        (F.col("value") + 30).alias("confidence_upper_mw"),
    )


@query("asof_forecast", """
WITH f AS (
  SELECT event_type AS generator_id, date_trunc('hour', ts) AS target_time,
    date_trunc('hour', ts) + INTERVAL 1 HOUR * (5 - CAST(json_extract(props, '$.k') AS INTEGER) % 12) AS forecast_time,
    value FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY generator_id, target_time ORDER BY forecast_time DESC, value DESC) AS rn
      FROM f WHERE forecast_time <= target_time),
a AS (SELECT event_type AS generator_id, date_trunc('hour', ts) AS target_time, avg(value) AS actual_mw
      FROM events GROUP BY 1, 2)
SELECT generator_id, target_time, forecast_time, value AS forecasted_power_mw, round(actual_mw, 8) AS actual_mw,
  round(actual_mw - value, 8) AS forecast_error_mw, actual_mw BETWEEN value - 30 AND value + 30 AS in_band,
  (epoch_us(target_time) - epoch_us(forecast_time)) / 3600e6 AS horizon_hours
FROM n JOIN a USING (generator_id, target_time) WHERE rn = 1""")
def asof_forecast(t):
    """Newest forecast not issued after its target, against the hourly mean."""
    actual = t.events.groupBy(
        F.col("event_type").alias("generator_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"),
    ).agg(F.avg("value").alias("active_power_mw"))
    out = d.forecast_match(_forecasts(t), actual)
    return rounded(out, "actual_mw", "forecast_error_mw", digits=8).select(
        "generator_id", "target_time", "forecast_time", "forecasted_power_mw", "actual_mw",
        "forecast_error_mw", "in_band", "horizon_hours",
    )


@query("task_durations", """
SELECT event_type AS pipeline_name, CASE WHEN value > 20 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
  count(*) AS runs, round(avg(round(value) * 60), 4) AS avg_seconds, max(round(value) * 60) AS max_seconds
FROM events GROUP BY 1, 2""")
def task_durations(t):
    logs = t.events.select(
        F.col("event_type").alias("pipeline_name"),
        F.when(F.col("value") > 20, "SUCCESS").otherwise("FAILED").alias("status"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.round("value").cast("int"))).alias(
            "end_time"
        ),
    )
    return rounded(d.task_durations(logs), "avg_seconds", "max_seconds")


@query("power_factor", """
SELECT event_id, round(value / nullif(sqrt(value * value + user_id * user_id), 0), 6) AS power_factor FROM events""")
def power_factor(t):
    df = t.events.withColumn("user_id", F.col("user_id").cast("double"))
    return rounded(
        d.with_power_factor(df, "value", "user_id"), "power_factor", digits=6
    ).select("event_id", "power_factor")
