"""Rollups and scans of measurements, on events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlake.functions import forecast as fc
from gridlake.functions.time_features import FEATURES, time_features
from gridlake.operators import rollups
from gridlake.operators.ordered import number_bucket
from gridlake.queries.mapping import POWER_SQL, power
from gridlake.queries.registry import AS_OF, as_of, query, rounded
from gridlake.session import fresh_path
from gridlake.sinks.tables import apply_retention, expired_dates


@query("hourly_rollup", f"""
WITH {POWER_SQL}
SELECT date_trunc('hour', time) AS bucket, bus_id, case_name,
       round(avg(voltage_magnitude), 8) AS avg_voltage,
       round(avg(active_power_mw), 8) AS avg_active_power,
       round(avg(reactive_power_mvar), 8) AS avg_reactive_power,
       min(voltage_magnitude) AS min_voltage, max(voltage_magnitude) AS max_voltage,
       count(*) AS measurement_count
FROM power GROUP BY 1, 2, 3""")
def hourly_rollup(t):
    return rounded(
        rollups.hourly_rollup(power(t)),
        "avg_voltage", "avg_active_power", "avg_reactive_power", digits=8,
    )


@query("daily_stats", """
SELECT date_trunc('day', ts) AS day, user_id AS generator_id, event_type AS case_name,
       round(avg(value), 6) AS avg_generation, max(value) AS peak_generation,
       round(sum(value), 6) AS total_generation_mwh,
       round(avg(value * 0.1), 6) AS avg_marginal_cost
FROM events GROUP BY 1, 2, 3""")
def daily_stats(t):
    df = t.events.select(
        F.col("ts").alias("time"),
        F.col("user_id").alias("generator_id"),
        F.col("event_type").alias("case_name"),
        "value",
        (F.col("value") * 0.1).alias("cost"),
    )
    stats = rollups.daily_stats(df, ["generator_id", "case_name"], power="value", cost="cost")
    return rounded(
        stats, "avg_generation", "total_generation_mwh", "avg_marginal_cost", digits=6
    )


@query("daily_energy_weighted", """
SELECT date_trunc('day', ts) AS day, user_id AS generator_id,
       round(avg(value), 6) AS avg_generation, max(value) AS peak_generation,
       round(sum(value * 0.25), 6) AS total_generation_mwh,
       round(avg(value), 6) AS avg_marginal_cost
FROM events GROUP BY 1, 2""")
def daily_energy_weighted(t):
    """Rows stand for a quarter of an hour each."""
    df = t.events.select(F.col("ts").alias("time"), F.col("user_id").alias("generator_id"), "value")
    stats = rollups.daily_stats(
        df, ["generator_id"], power="value", cost="value", hours_per_row=F.lit(0.25)
    )
    return rounded(
        stats, "avg_generation", "total_generation_mwh", "avg_marginal_cost", digits=6
    )


@query("coverage", """
SELECT event_type AS case_name, min(ts) AS earliest, max(ts) AS latest,
       count(DISTINCT CAST(ts AS DATE)) AS days_covered, count(*) AS total_measurements
FROM events GROUP BY 1""")
def coverage(t):
    return rollups.coverage(power(t))


@query("recent_mean", f"""
SELECT event_type AS case_name, round(avg(value * 2), 4) AS avg_generation
FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR GROUP BY 1""")
def recent_mean(t):
    return rounded(rollups.recent_mean(power(t), as_of(), 24, "active_power_mw"), "avg_generation")


@query("recent_rows", f"""
SELECT event_id, ts, user_id, value FROM events
WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR""")
def recent_rows(t):
    return rollups.since(t.events, as_of(), 168, "ts").select("event_id", "ts", "user_id", "value")


@query("range_scan", """
SELECT ts AS time, user_id AS bus_id, value AS voltage_magnitude, value * 2 AS active_power_mw
FROM events WHERE event_type = 'view'
  AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-12 00:00:00'""")
def range_scan(t):
    return rollups.range_scan(
        power(t),
        "view",
        as_of("2024-01-05 00:00:00"),
        as_of("2024-01-12 00:00:00"),
        ["time", "bus_id", "voltage_magnitude", "active_power_mw"],
        "bus_id",
    )


@query("time_range_scan", """
SELECT ts AS time, user_id AS bus_id, value AS voltage_magnitude, event_type AS case_name
FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-06 00:00:00'""")
def time_range_scan(t):
    """All cases in a time range, by time."""
    return (
        power(t)
        .filter(F.col("time").between(as_of("2024-01-05 00:00:00"), as_of("2024-01-06 00:00:00")))
        .select("time", "bus_id", "voltage_magnitude", "case_name")
        .orderBy("time")
    )


@query("case_list", "SELECT DISTINCT event_type AS case_name FROM events")
def case_list(t):
    return power(t).select("case_name").distinct().orderBy("case_name")


@query("ingest_counts", """
SELECT event_type AS source, CASE WHEN value >= 1 THEN 'success' ELSE 'failure' END AS status,
       count(*) AS rows
FROM events GROUP BY 1, 2""")
def ingest_counts(t):
    status = F.when(F.col("value") >= 1, "success").otherwise("failure")
    df = t.events.select(F.col("event_type").alias("source"), status.alias("status"))
    return rollups.row_counts(df, ["source", "status"])


@query("time_histogram", """
SELECT event_type, le, n FROM (
  SELECT event_type, '5' AS le, CAST(sum(CASE WHEN value <= 5 THEN 1 ELSE 0 END) AS BIGINT) AS n
  FROM events GROUP BY 1
  UNION ALL SELECT event_type, '25', CAST(sum(CASE WHEN value <= 25 THEN 1 ELSE 0 END) AS BIGINT)
  FROM events GROUP BY 1
  UNION ALL SELECT event_type, '100', CAST(sum(CASE WHEN value <= 100 THEN 1 ELSE 0 END) AS BIGINT)
  FROM events GROUP BY 1
  UNION ALL SELECT event_type, '+Inf', count(value) FROM events GROUP BY 1) x""")
def time_histogram(t):
    return rollups.cumulative_histogram(t.events, "value", [5, 25, 100], ["event_type"])


@query("converged_gauge", """
SELECT o_custkey AS topology_id, CASE WHEN arg_max(o_orderstatus, ROW(o_orderdate, o_orderkey)) = 'F'
       THEN 1 ELSE 0 END AS converged
FROM orders GROUP BY 1""")
def converged_gauge(t):
    from gridlake.queries.mapping import executions

    return rollups.converged_gauge(executions(t), ["topology_id"], converged="F")


@query("series_arrays", """
WITH placed AS (
  SELECT user_id, ts, value,
         (row_number() OVER (PARTITION BY user_id ORDER BY ts, value) - 1) AS pos
  FROM events)
SELECT user_id, CAST(pos // 24 AS BIGINT) AS chunk_no, count(*) AS points,
       min(ts) AS first_time, max(ts) AS last_time,
       arg_min(value, pos) AS first_value, arg_max(value, pos) AS last_value,
       round(sum(value * (pos % 24 + 1)), 4) AS weighted_sum
FROM placed GROUP BY 1, 2""")
def series_arrays(t):
    """Series per load in chunks of 24 points; the sum weights each by its place."""
    s = rollups.series_arrays(t.events, "user_id", "ts", "value", chunk_rows=24)
    weighted = F.aggregate(
        F.transform("values", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v
    )
    return s.select(
        "user_id",
        "chunk_no",
        F.size("times").cast("bigint").alias("points"),
        F.element_at("times", 1).alias("first_time"),
        F.element_at("times", -1).alias("last_time"),
        F.element_at("values", 1).alias("first_value"),
        F.element_at("values", -1).alias("last_value"),
        F.round(weighted, 4).alias("weighted_sum"),
    )


@query("ordered_sample", """
SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 1000""")
def ordered_sample(t):
    return rollups.ordered_sample(t.events.select("event_id", "ts", "value"), ["ts", "event_id"], 1000)


@query("retention", f"""
SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY""")
def retention(t):
    return apply_retention(t.events.select("event_id", "ts", "value"), as_of(), 10, "ts")


@query("expired_days", f"""
SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events
WHERE CAST(ts AS DATE) < CAST(TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY AS DATE)""")
def expired_days(t):
    dated = t.events.select(F.to_date("ts").alias("date"))
    days = expired_dates(dated, as_of(), 10)
    return days.select(F.date_format("date", "yyyy-MM-dd").alias("day"))


@query("rows_per_table", """
SELECT 'events' AS table_name, count(*) AS rows FROM events
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def rows_per_table(t):
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
        for n, df in (("events", t.events), ("orders", t.orders), ("lineitem", t.lineitem))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("time_features", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       CAST(month(ts) AS INTEGER) AS month, round(sin(2 * pi() * hour(ts) / 24), 8) AS hour_sin,
       round(cos(2 * pi() * hour(ts) / 24), 8) AS hour_cos
FROM events""")
def features(t):
    df = time_features(t.events, "ts").select("event_id", *FEATURES)
    # Adding 0.0 turns a rounded -0.0 into 0.0.
    return df.withColumns({c: F.round(c, 8) + F.lit(0.0) for c in ("hour_sin", "hour_cos")})


@query("forecast", """
SELECT CAST(hour(h) AS INTEGER) AS hour, CAST(isodow(h) - 1 AS INTEGER) AS day_of_week,
       CAST(month(h) AS INTEGER) AS month, count(*) AS hours, TRUE AS one_value, TRUE AS in_range
FROM (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events) e GROUP BY 1, 2, 3""")
def forecast(t):
    """Train on all events, save, load, predict every hour that has events; per calendar
    cell: hours, whether they agree, and whether the value lies within the history's."""
    history = t.events.select(F.col("ts").alias("time"), F.col("value").alias("active_power_mw"))
    path = fresh_path(t.spark, "model")
    fc.save_model(fc.train_forecast(history), path)
    hours = history.select(F.window("time", "1 hour")["start"].alias("time")).distinct()
    predicted = time_features(fc.forecast(fc.load_model(path), hours), "time")
    span = fc.feature_cells(history).agg(F.min("label").alias("low"), F.max("label").alias("high"))
    cells = predicted.groupBy("hour", "day_of_week", "month").agg(
        F.count(F.lit(1)).alias("hours"),
        F.min("forecasted_load_mw").alias("_low"),
        F.max("forecasted_load_mw").alias("_high"),
    )
    # One row of bounds, met through a constant key.
    judged = cells.withColumn("_one", F.lit(1)).join(span.withColumn("_one", F.lit(1)), "_one")
    return judged.select(
        "hour",
        "day_of_week",
        "month",
        "hours",
        (F.col("_low") == F.col("_high")).alias("one_value"),
        ((F.col("_low") >= F.col("low") - 1e-6) & (F.col("_high") <= F.col("high") + 1e-6)).alias("in_range"),
    )


@query("forecast_held_out", """
WITH origins AS (SELECT unnest([TIMESTAMP '2024-01-15', TIMESTAMP '2024-01-22']) AS origin),
past AS (SELECT origin, hour(ts) AS h, isodow(ts) AS d, value FROM events JOIN origins ON ts < origin),
cell AS (SELECT origin, h, d, avg(value) AS m FROM past GROUP BY 1, 2, 3),
by_hour AS (SELECT origin, h, avg(value) AS m FROM past GROUP BY 1, 2),
everything AS (SELECT origin, avg(value) AS m FROM past GROUP BY 1)
SELECT e.origin, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS held_out,
       round(avg(abs(value - coalesce(c.m, b.m, a.m))), 6) AS seasonal_mae, TRUE AS forest_close
FROM events JOIN origins e ON ts >= e.origin AND ts < e.origin + INTERVAL 7 DAY
  JOIN everything a ON a.origin = e.origin
  LEFT JOIN by_hour b ON b.origin = e.origin AND b.h = hour(ts)
  LEFT JOIN cell c ON c.origin = e.origin AND c.h = hour(ts) AND c.d = isodow(ts)
WHERE value IS NOT NULL GROUP BY 1, 2""")
def forecast_held_out(t):
    """Errors per hour over the weeks after two origins. The forest's error over an origin's
    whole week is held to a tenth above the seasonal mean's, which SQL states."""
    history = t.events.select(F.col("ts").alias("time"), F.col("value").alias("active_power_mw"))
    origins = [as_of("2024-01-15 00:00:00"), as_of("2024-01-22 00:00:00")]
    errors = fc.rolling_origin(history, origins, trees=20)

    def total(name):
        return F.sum(F.col(name) * F.col("held_out")).over(Window.partitionBy("origin"))  # 24 rows

    close = total("forest_mae") <= 1.1 * total("seasonal_mae")
    return rounded(errors.withColumn("forest_close", close), "seasonal_mae", digits=6).drop("forest_mae")


@query("forecast_cells", """
SELECT CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
       CAST(month(ts) AS INTEGER) AS month, round(avg(value), 4) AS label,
       CAST(count(value) AS DOUBLE) AS weight
FROM events GROUP BY 1, 2, 3""")
def forecast_cells(t):
    cells = fc.feature_cells(t.events, "ts", "value")
    return rounded(cells, "label").select("hour", "day_of_week", "month", "label", "weight")


@query("scalar_functions", """
SELECT event_id, CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS INTEGER) AS k,
       json_extract_string(props, '$.k') AS k_text,
       upper(substr(event_type, 1, 1)) || '_' || CAST(user_id AS VARCHAR) AS label,
       event_type LIKE '%ur%' AS has_marker, event_type LIKE 'p%' AS starts_with_p,
       right(event_type, 1) AS last_char, regexp_replace(event_type, '[aeiou]', '', 'g') AS consonants,
       CAST(len(string_split('a ' || event_type, ' ')) AS INTEGER) AS words,
       round(abs(value - 50), 4) AS distance, round(sqrt(value), 6) AS root,
       round(value * value, 4) AS square,
       date_trunc('day', ts) AS midnight, strftime(ts, '%Y-%m-%d') AS day,
       round(0.6 + 0.3 * sin((hour(ts) - 6) * pi() / 12), 8) AS load_factor,
       CASE WHEN value > 1 THEN value ELSE 0.0 END AS cleaned
FROM events""")
def scalar_functions(t):
    from gridlake.functions import scalars

    c = F.col
    missing = F.when(c("value") > 1, c("value")).otherwise(F.lit(float("nan")))
    return t.events.select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        F.get_json_object("props", "$.k").alias("k_text"),
        F.concat(
            F.upper(F.substring("event_type", 1, 1)), F.lit("_"), c("user_id").cast("string")
        ).alias("label"),
        c("event_type").contains("ur").alias("has_marker"),
        c("event_type").startswith("p").alias("starts_with_p"),
        F.right("event_type", F.lit(1)).alias("last_char"),
        F.regexp_replace("event_type", "[aeiou]", "").alias("consonants"),
        F.size(F.split(F.concat(F.lit("a "), c("event_type")), " ")).alias("words"),
        F.round(F.abs(c("value") - 50), 4).alias("distance"),
        F.round(F.sqrt("value"), 6).alias("root"),
        F.round(F.pow("value", F.lit(2)), 4).alias("square"),
        scalars.midnight(c("ts")).cast("timestamp_ntz").alias("midnight"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.round(scalars.load_factor(c("ts")), 8).alias("load_factor"),
        scalars.zero_if_missing(missing).alias("cleaned"),
    )


@query("array_membership", """
SELECT user_id, count(*) AS events,
       CAST(sum(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS BIGINT) AS listed,
       CAST(sum(CASE WHEN TRY_CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) IS NULL
                THEN 1 ELSE 0 END) AS BIGINT) AS unparsed
FROM events GROUP BY 1""")
def array_membership(t):
    from gridlake.functions.scalars import parse_iso_time

    listed = F.array_contains(F.array(F.lit("view"), F.lit("click")), F.col("event_type"))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return t.events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(listed).alias("listed"),
        F.count_if(parse_iso_time(iso).isNull()).alias("unparsed"),
    )


def arrival_bucket():
    return number_bucket("event_id")
