"""Streaming queries: the event table as a file stream, drained and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import quality as q
from gridlake.operators import rollups
from gridlake.queries.registry import Tables, as_of, query, rounded
from gridlake.session import fresh_path
from gridlake.streaming import first_writes as first
from gridlake.streaming import measurements as st
from gridlake.streaming import partials


def _stream(t: Tables) -> DataFrame:
    """Events as a stream, with times a watermark accepts."""
    path = t.path("events")
    schema = t.spark.read.parquet(path).schema
    # A file stream takes a folder or a pattern; the pattern fits file and folder.
    pattern = f"{path[:-1]}[{path[-1]}]"
    return st.file_stream(t.spark, pattern, schema).withColumn("ts", F.col("ts").cast("timestamp"))


def _drain(t: Tables, stream: DataFrame, label: str) -> DataFrame:
    out, checkpoint = fresh_path(t.spark, label), fresh_path(t.spark, f"{label}-checkpoint")
    st.store_stream(stream, out, checkpoint).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(out)


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _messages(t: Tables) -> DataFrame:
    """Events as JSON messages; those whose payload number ends in 0 are broken."""
    body = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
            F.col("user_id").cast("string").alias("bus_id"),
            (F.col("value") / 50).alias("voltage_magnitude"),
            F.lit(0.1).alias("voltage_angle_rad"),
            F.col("value").alias("active_power_mw"),
            F.lit(60.0).alias("frequency_hz"),
        )
    )
    number = F.from_json("props", "k int")["k"]
    broken = F.concat(F.lit('{"timestamp": '), "props")
    return _stream(t).select(
        F.when(number % 10 == 0, broken).otherwise(body).alias("value"), "event_id"
    )


OK_SQL = "CAST(json_extract(props, '$.k') AS INTEGER) % 10 <> 0"


@query("stream_store", f"""
SELECT ts AS time, CAST(user_id AS VARCHAR) AS bus_id, round(value / 50, 6) AS voltage_magnitude,
       value AS active_power_mw, 'SCADA' AS source
FROM events WHERE {OK_SQL} AND value <= 300""")
def stream_store(t):
    """Decode, check and store; broken and implausible messages stay out."""
    decoded = st.decode(_messages(t), schemas.STREAM_MESSAGE)
    checked = st.split_valid(decoded, [q.between("active_power_mw", 0, 300), q.not_null("bus_id")])
    stored = _drain(t, st.to_measurements(checked.filter("valid")), "store")
    return _naive(rounded(stored, "voltage_magnitude", digits=6), "time").select(
        "time", "bus_id", "voltage_magnitude", "active_power_mw", "source"
    )


@query("stream_dead_letter", f"""
SELECT '{{"timestamp": ' || props AS value, count(*) AS messages FROM events WHERE NOT ({OK_SQL}) GROUP BY 1""")
def stream_dead_letter(t):
    bad = _drain(t, st.dead_letters(st.decode(_messages(t), schemas.STREAM_MESSAGE)), "dead")
    return bad.groupBy("value").agg(F.count(F.lit(1)).alias("messages"))


@query("stream_rejected", f"""
SELECT event_id, value AS active_power_mw FROM events WHERE {OK_SQL} AND value > 100""")
def stream_rejected(t):
    """Side output of decoded messages that break a rule."""
    decoded = st.decode(_messages(t), schemas.STREAM_MESSAGE)
    checked = st.split_valid(decoded, [q.between("active_power_mw", 0, 100)])
    return _drain(
        t, checked.filter("decoded AND NOT valid").select("event_id", "active_power_mw"), "rejected"
    )


@query("stream_dedupe", "SELECT event_id, ts AS time, user_id AS bus_id, value FROM events")
def stream_dedupe(t):
    """Every event arrives twice and is kept once, however the input is cut into batches."""
    twice = _stream(t).select(
        "event_id", F.col("ts").alias("time"), F.col("user_id").alias("bus_id"), "value",
        F.explode(F.array(F.lit(1), F.lit(2))).alias("arrival"),
    )
    stored, _ = _first(t, twice, ["time", "bus_id", "event_id"], arrival="arrival")
    return _naive(stored.filter("arrival = 1").drop("batch", "date", "arrival"), "time")


@query("stream_copies", """
SELECT user_id AS bus_id, count(*) AS copies, min(event_id) AS first_event FROM (
  SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id) AS n
  FROM events) WHERE n > 1 GROUP BY 1""")
def stream_copies(t):
    """Side output: rows of a bus after the first to arrive in an hour."""
    rows = _stream(t).select("event_id", F.date_trunc("hour", "ts").alias("time"), F.col("user_id").alias("bus_id"))
    out, checkpoint = fresh_path(t.spark, "rows"), fresh_path(t.spark, "rows-checkpoint")
    first.store_first(rows, out, checkpoint, ["time", "bus_id"], arrival="event_id").awaitTermination()
    found = first.stored_rows(t.spark, out, rows.schema, "copies")
    return found.groupBy("bus_id").agg(F.count(F.lit(1)).alias("copies"), F.min("event_id").alias("first_event"))


@query("stream_late", """
WITH marks AS (SELECT event_id % 3 AS batch, max(ts) AS newest FROM events GROUP BY 1),
seen AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM marks)
SELECT date_trunc('day', ts) AS day, count(*) AS late_rows
FROM events JOIN seen ON seen.batch = event_id % 3 WHERE ts < seen - INTERVAL 3 HOUR GROUP BY 1""")
def stream_late(t):
    """Side output: rows more than three hours behind what earlier batches have shown."""
    folder = fresh_path(t.spark, "late")
    events = t.events.select("event_id", F.col("ts").cast("timestamp").alias("time"), F.col("user_id").alias("bus_id"))
    for batch in range(3):
        events.filter(F.col("event_id") % 3 == batch).coalesce(1).write.parquet(f"{folder}/{batch}")
    rows = st.file_stream(t.spark, f"{folder}/*", events.schema, files_per_trigger=1)
    out, checkpoint = fresh_path(t.spark, "rows"), fresh_path(t.spark, "rows-checkpoint")
    keys = ["time", "bus_id", "event_id"]
    first.store_first(rows, out, checkpoint, keys).awaitTermination()
    late = first.late_rows(first.stored_rows(t.spark, out, rows.schema), F.expr("INTERVAL 3 HOURS"))
    days = late.groupBy(F.date_trunc("day", "time").alias("day")).agg(F.count(F.lit(1)).alias("late_rows"))
    return _naive(days, "day")


@query("stream_alerts", """
SELECT event_id, user_id AS bus_id, value AS voltage_magnitude FROM events WHERE abs(value - 50) > 40""")
def stream_alerts(t):
    renamed = _stream(t).select(
        "event_id", F.col("user_id").alias("bus_id"), F.col("value").alias("voltage_magnitude")
    )
    return _drain(t, st.alerts(renamed, nominal=50.0, limit=40.0), "alerts")


@query("stream_rerun_requests", """
SELECT DISTINCT user_id AS bus_id FROM events WHERE abs(value - 50) > 40""")
def stream_rerun_requests(t):
    """One request per bus and batch, over all batches."""
    renamed = _stream(t).select(
        F.col("user_id").alias("bus_id"), F.col("value").alias("voltage_magnitude")
    )
    out, checkpoint = fresh_path(t.spark, "requests"), fresh_path(t.spark, "requests-checkpoint")
    found = st.alerts(renamed, nominal=50.0, limit=40.0)
    st.request_reruns(found, out, checkpoint).awaitTermination()
    requests = t.spark.read.schema("bus_id bigint, batch_id int").parquet(f"{out}/*")
    return requests.select("bus_id").distinct()


def _first(t: Tables, rows: DataFrame, keys: list[str], rollup: partials.Rollup | None = None, arrival: str | None = None):
    """Stored rows, and the rollup whose parts went along with them."""
    out, target, checkpoint = (fresh_path(t.spark, x) for x in ("rows", "rollup", "rows-checkpoint"))
    rollups = [(rollup, target)] if rollup else []
    first.store_first(rows, out, checkpoint, keys, arrival, rollups=rollups).awaitTermination()
    rolled = partials.read_rollup(t.spark, target, rows.schema, rollup) if rollup else None
    return first.stored_rows(t.spark, out, rows.schema), rolled


def _rollup_input(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        *more,
        F.col("ts").alias("time"),
        F.col("user_id").alias("bus_id"),
        F.col("event_type").alias("case_name"),
        F.col("value").alias("voltage_magnitude"),
        F.col("value").alias("active_power_mw"),
        F.col("value").alias("reactive_power_mvar"),
    )


@query("stream_hourly", """
SELECT date_trunc('hour', ts) AS bucket, user_id AS bus_id, event_type AS case_name,
       round(avg(value), 4) AS avg_voltage, min(value) AS min_voltage, max(value) AS max_voltage,
       count(*) AS measurement_count
FROM events GROUP BY 1, 2, 3""")
def stream_hourly(t):
    """Hourly rollup kept as mergeable parts while rows are stored."""
    rows = _rollup_input(_stream(t), "event_id")
    _, rolled = _first(t, rows, ["time", "bus_id", "event_id"], partials.HOURLY)
    return _naive(rounded(rolled, "avg_voltage"), "bucket").select(
        "bucket", "bus_id", "case_name", "avg_voltage", "min_voltage", "max_voltage",
        "measurement_count",
    )


@query("stream_daily", """
SELECT date_trunc('day', ts) AS day, user_id AS generator_id, max(value) AS peak_generation,
       round(sum(value), 4) AS total_generation_mwh
FROM events GROUP BY 1, 2""")
def stream_daily(t):
    """Daily statistics kept as mergeable parts while rows are stored."""
    daily = partials.Rollup(
        ("generator_id",),
        width="1 day",
        bucket="day",
        sums={"total_generation_mwh": "value"},
        highs={"peak_generation": "value"},
    )
    rows = _stream(t).select(
        F.col("ts").alias("time"), F.col("user_id").alias("generator_id"), "value", "event_id"
    )
    _, rolled = _first(t, rows, ["time", "generator_id", "event_id"], daily)
    return _naive(rounded(rolled, "total_generation_mwh"), "day").select(
        "day", "generator_id", "peak_generation", "total_generation_mwh"
    )


@query("refresh_rollup", """
WITH first AS (SELECT * FROM events WHERE event_type <> 'error' AND ts < TIMESTAMP '2024-01-20'),
src AS (
  SELECT * FROM first WHERE ts < TIMESTAMP '2024-01-17 12:00:00'
  UNION ALL SELECT * FROM events
  WHERE ts >= TIMESTAMP '2024-01-17 12:00:00' AND ts < TIMESTAMP '2024-01-20 11:00:00')
SELECT date_trunc('hour', ts) AS bucket, user_id AS bus_id, event_type AS case_name,
       round(avg(value), 4) AS avg_voltage, count(*) AS measurement_count
FROM src GROUP BY 1, 2, 3""")
def refresh_rollup(t):
    """Errors arrive late: the refresh picks up those of its window, not older ones."""
    path = fresh_path(t.spark, "rollup")
    start = as_of("2024-01-20 00:00:00")
    early = t.events.filter((F.col("event_type") != "error") & (F.col("ts") < start))
    st.refresh_rollup(rollups.hourly_rollup(_rollup_input(early)), path)
    bounds = st.refresh_bounds(as_of("2024-01-20 12:00:00"), start_hours=72, end_hours=1)
    window = st.refresh_window(_rollup_input(t.events), bounds)
    st.refresh_rollup(rollups.hourly_rollup(window), path, bounds)
    stored = t.spark.read.parquet(path)
    return rounded(stored, "avg_voltage").select(
        "bucket", "bus_id", "case_name", "avg_voltage", "measurement_count"
    )
