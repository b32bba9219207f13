"""Measurement streams and incremental rollups.

Times must be timestamps with zone here: a watermark rejects zone-less ones.
Every writer takes its checkpoint folder as an argument, so a restarted query
goes on where the last one stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridlake.operators.quality import Rule, split_rows
from gridlake.sinks.tables import stage

# Nominal voltage and the deviation that raises an alert; refresh
# windows of the two rollups as (start, end) offsets in hours.
NOMINAL_VOLTAGE = 1.0
ALERT_DEVIATION = 0.1
HOURLY_REFRESH = (3, 1)
DAILY_REFRESH = (72, 24)


def topic_stream(spark: SparkSession, servers: str, topic: str = "power_measurements") -> DataFrame:
    """Message texts of a topic, from the newest offset on."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .load()
    )
    return raw.select(F.col("value").cast("string").alias("value"))


FILES_PER_TRIGGER = 1000


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    form: str = "parquet",
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """Files below ``path``, a bounded number per batch."""
    reader = spark.readStream.schema(schema).format(form)
    return reader.option("maxFilesPerTrigger", files_per_trigger).load(path)


def decode(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Message fields next to the raw text; ``decoded`` is false for broken JSON."""
    marked = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    parsed = F.from_json(
        F.col(value), marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    )
    return messages.withColumn("_m", parsed).select(
        *[c for c in messages.columns],
        *[F.col(f"_m.{f.name}").alias(f.name) for f in schema.fields],
        (F.col("_m").isNotNull() & F.col("_m._broken").isNull()).alias("decoded"),
    )


def split_valid(decoded: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``valid``: decoded and breaking no rule."""
    checked = split_rows(decoded, rules)
    return checked.withColumn("valid", F.col("valid") & F.col("decoded"))


def dead_letters(decoded: DataFrame, value: str = "value") -> DataFrame:
    """Raw texts that did not decode."""
    return decoded.filter(~F.col("decoded")).select(value)


def to_measurements(valid: DataFrame, source: str = "SCADA") -> DataFrame:
    """Decoded messages as power measurements."""
    return valid.select(
        F.col("timestamp").alias("time"),
        "bus_id",
        "voltage_magnitude",
        "voltage_angle_rad",
        "active_power_mw",
        "frequency_hz",
        F.lit(source).alias("source"),
    )


def alerts(
    df: DataFrame,
    voltage: str = "voltage_magnitude",
    nominal: float = NOMINAL_VOLTAGE,
    limit: float = ALERT_DEVIATION,
) -> DataFrame:
    """Rows whose voltage is off nominal by more than the limit."""
    return df.filter(F.abs(F.col(voltage) - nominal) > limit)


def store_stream(
    stream: DataFrame, path: str, checkpoint: str, partition: Sequence[str] = ()
) -> StreamingQuery:
    """Append to Parquet, exactly once, until the input is drained."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition:
        writer = writer.partitionBy(*partition)
    return writer.start()


def request_reruns(
    alert_stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = ("bus_id",)
) -> StreamingQuery:
    """One re-run request row per batch and key.

    A batch writes into its own folder and replaces it when it is run again, so
    a repeated batch makes no second request.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        requests = batch.select(*keys).distinct().withColumn("batch_id", F.lit(batch_id))
        requests.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        alert_stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_bounds(
    as_of: Column, start_hours: int, end_hours: int, unit: str = "hour"
) -> tuple[Column, Column]:
    """First and one-past-last bucket start a refresh at ``as_of`` covers: the
    whole buckets between ``as_of - start`` and ``as_of - end``."""
    low = as_of - F.make_dt_interval(F.lit(0), F.lit(start_hours))
    high = as_of - F.make_dt_interval(F.lit(0), F.lit(end_hours))
    floor = F.date_trunc(unit, low)
    first = F.when(floor == low, floor).otherwise(floor + F.expr(f"INTERVAL 1 {unit}"))
    return first.cast("timestamp_ntz"), F.date_trunc(unit, high).cast("timestamp_ntz")


def refresh_window(df: DataFrame, bounds: tuple[Column, Column], time: str = "time") -> DataFrame:
    """Rows of the buckets a refresh covers."""
    first, last = bounds
    return df.filter((F.col(time) >= first) & (F.col(time) < last))


def refresh_rollup(
    rollup: DataFrame,
    path: str,
    bounds: tuple[Column, Column] | None = None,
    bucket: str = "bucket",
) -> None:
    """Store a rollup, or replace the buckets within ``bounds`` of a stored one.

    The table is partitioned by date. A refresh rewrites only the dates it
    touches and keeps their buckets outside the bounds, so older buckets, and
    late rows for them, are left alone. The new rows are written to a folder of
    their own first: nothing that is read is overwritten, and a commit that breaks
    off can be repeated. Dates of the bounds that end up without rows are removed.
    """
    date = F.to_date(bucket)
    rows = rollup.withColumn("bucket_date", date)
    gone: list[str] = []
    if bounds is not None:
        first, last = bounds
        stored = rollup.sparkSession.read.parquet(path).filter(
            F.col("bucket_date").between(F.to_date(first), F.to_date(last))
        )
        outside = stored.filter((F.col(bucket) < first) | (F.col(bucket) >= last))
        rows = stage(rows.unionByName(outside), "refresh")
        dates = stored.select("bucket_date").distinct().join(rows, "bucket_date", "left_anti")
        gone = [str(r["bucket_date"]) for r in dates.collect()]  # days of the bounds
    (
        rows.hint("rebalance", "bucket_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket_date")
        .parquet(path)
    )
    jvm = rollup.sparkSession.sparkContext._jvm
    settings = rollup.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for day in gone:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/bucket_date={day}")
        folder.getFileSystem(settings).delete(folder, True)
