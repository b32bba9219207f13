"""Forecast: features, training on feature cells, error bound."""

from pyspark.sql import functions as F

from gridlake.functions import forecast as fc
from gridlake.functions.scalars import hours_after
from gridlake.functions.time_features import time_features


def test_monday_is_zero(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 06:00:00' AS time")
    got = time_features(df).head()
    assert (got.hour, got.day_of_week, got.month) == (6, 0, 1)
    assert abs(got.hour_sin - 1) < 1e-12 and abs(got.hour_cos) < 1e-12


def test_forecast_follows_a_daily_shape(spark, tmp_path):
    hour = F.hour("time")
    history = spark.range(24 * 28).select(
        hours_after(F.col("id"), "2024-01-01 00:00:00").alias("time")
    ).withColumn("active_power_mw", 100 + 50 * F.sin((hour - 6) * 3.14159265 / 12))
    model = fc.train_forecast(history, trees=20)
    fc.save_model(model, str(tmp_path / "model"))
    times = spark.range(48).select(hours_after(F.col("id"), "2024-01-15 00:00:00").alias("time"))
    got = fc.forecast(fc.load_model(str(tmp_path / "model")), times).withColumn(
        "want", 100 + 50 * F.sin((hour - 6) * 3.14159265 / 12)
    )
    assert got.count() == 48
    assert got.agg(F.max(F.abs(F.col("forecasted_load_mw") - F.col("want")))).head()[0] < 15


def test_rolling_origin(spark):
    """Hour n of the day carries n; after the origin it carries n + 2, so every error is 2."""
    start = "2024-01-01 00:00:00"
    hours = spark.range(24 * 21).select(hours_after(F.col("id"), start).alias("time"), "id")
    shift = F.when(F.col("id") >= 24 * 14, 2.0).otherwise(0.0)
    history = hours.select("time", (F.hour("time") + shift).alias("active_power_mw"))
    history = history.union(spark.sql("SELECT timestamp_ntz'2024-01-16 05:00:00', CAST(NULL AS DOUBLE)"))
    origins = [F.lit("2024-01-15").cast("timestamp_ntz"), F.lit("2023-01-01").cast("timestamp_ntz")]
    got = fc.rolling_origin(history, origins, trees=5).orderBy("hour").collect()
    assert [(r.hour, r.held_out) for r in got] == [(h, 7) for h in range(24)]  # the null is no row
    assert all(abs(r.seasonal_mae - 2) < 1e-9 for r in got)
    assert all(abs(r.forest_mae - 2) < 1.5 for r in got)
    assert fc.rolling_origin(history, origins[1:]).count() == 0


def test_seasonal_means_fall_back(spark):
    cells = spark.createDataFrame([(5, 0, 10.0, 3.0), (5, 1, 20.0, 1.0), (6, 0, 0.0, 1.0)], "hour int, day_of_week int, label double, weight double")
    got = {(r.hour, r.day_of_week): r.seasonal for r in fc.seasonal_means(cells).collect()}
    assert len(got) == 168
    assert (got[5, 0], got[5, 1], got[5, 6], got[9, 3]) == (10.0, 20.0, 12.5, 10.0)
