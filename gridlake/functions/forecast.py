"""Load forecast: random forest on calendar features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.time_features import FEATURES, time_features
from gridlake.sinks.tables import stage


def feature_cells(
    history: DataFrame, time: str = "time", target: str = "active_power_mw", by: Sequence[str] = ()
) -> DataFrame:
    """Mean target and row count per distinct feature combination.

    Hour, weekday and month have at most 24 x 7 x 12 combinations, so the forest
    trains on that many weighted rows however long the history is; squared-error
    splits depend on the rows only through these means and counts.
    """
    return (
        time_features(history, time)
        .groupBy(*by, *FEATURES)
        .agg(F.avg(target).alias("label"), F.count(target).cast("double").alias("weight"))
        .filter(F.col("weight") > 0)
    )


def train_forecast(
    history: DataFrame,
    time: str = "time",
    target: str = "active_power_mw",
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
) -> PipelineModel:
    return fit_cells(feature_cells(history, time, target), trees, depth, seed)


def fit_cells(cells: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42) -> PipelineModel:
    """A forest from the result of :func:`feature_cells`."""
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        predictionCol="forecasted_load_mw",
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy="all",
        seed=seed,
    )
    return Pipeline(stages=[assembler, forest]).fit(cells)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def forecast(model: PipelineModel, times: DataFrame, time: str = "time") -> DataFrame:
    """Forecast for each given time.

    The model runs once per distinct feature combination; the times then look
    their value up by features.
    """
    featured = time_features(times, time)
    cells = model.transform(featured.select(*FEATURES).distinct()).select(
        "hour", "day_of_week", "month", "forecasted_load_mw"
    )
    return featured.join(F.broadcast(cells), ["hour", "day_of_week", "month"]).select(
        *times.columns, "forecasted_load_mw"
    )  # cells: at most 24 x 7 x 12 rows


def seasonal_means(cells: DataFrame) -> DataFrame:
    """``(hour, day_of_week, seasonal)``: the history's mean per hour and weekday.

    An hour without that weekday has the hour's mean over all days; an hour that the history
    lacks has the mean of everything. 168 rows where the history has any.
    """

    def mean(rows: DataFrame, *keys: str, name: str) -> DataFrame:
        weighted = F.sum(F.col("label") * F.col("weight")) / F.sum("weight")
        return rows.groupBy(*keys).agg(weighted.alias(name))

    numbers = cells.sparkSession.range(24 * 7)
    week = numbers.select(
        F.expr("CAST(id div 7 AS INT)").alias("hour"), F.expr("CAST(id % 7 AS INT)").alias("day_of_week")
    )
    overall = mean(cells.withColumn("_one", F.lit(1)), "_one", name="_all")
    return (
        week.withColumn("_one", F.lit(1))
        .join(overall, "_one")
        .join(mean(cells, "hour", name="_hour"), "hour", "left")
        .join(mean(cells, "hour", "day_of_week", name="_cell"), ["hour", "day_of_week"], "left")
        .select("hour", "day_of_week", F.coalesce("_cell", "_hour", "_all").alias("seasonal"))
    )


def rolling_origin(
    history: DataFrame,
    origins: Sequence[Column],
    horizon_days: int = 7,
    time: str = "time",
    target: str = "active_power_mw",
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Held-out errors: per origin and hour of day, the mean absolute error of a forest
    trained on everything before the origin, over the days after it, beside that of the
    seasonal mean of the same history.

    Rows without a target or a time take no part; an origin without history or without
    rows after it gives none. A forest is fitted per origin, on at most 24 x 7 x 12 rows.
    """
    rows = history.select(F.col(time).alias("time"), F.col(target).alias("_value")).dropna()
    found = None
    for origin in origins:
        cells = stage(feature_cells(rows.filter(F.col("time") < origin), "time", "_value"), "cells")
        after = rows.filter((F.col("time") >= origin) & (F.col("time") < origin + F.make_dt_interval(F.lit(horizon_days))))
        if cells.isEmpty():
            continue
        # The forecast joins by features, so the columns the errors need pass through it.
        predicted = time_features(forecast(fit_cells(cells, trees, depth, seed), after), "time")
        errors = (
            predicted.join(seasonal_means(cells), ["hour", "day_of_week"])
            .groupBy(origin.alias("origin"), "hour")
            .agg(
                F.count(F.lit(1)).alias("held_out"),
                F.avg(F.abs(F.col("_value") - F.col("forecasted_load_mw"))).alias("forest_mae"),
                F.avg(F.abs(F.col("_value") - F.col("seasonal"))).alias("seasonal_mae"),
            )
        )
        found = errors if found is None else found.unionByName(errors)
    if found is None:
        return history.sparkSession.createDataFrame(
            [], "origin timestamp_ntz, hour int, held_out long, forest_mae double, seasonal_mae double"
        )
    return found
