"""Calendar features for load forecasting."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalars import monday_based_weekday

FEATURES = ["hour", "day_of_week", "month", "hour_sin", "hour_cos"]


def time_features(df: DataFrame, time: str = "time") -> DataFrame:
    """Adds hour, weekday (Monday = 0), month and the hour on a circle."""
    t = F.col(time)
    angle = F.lit(2 * math.pi) * F.hour(t) / 24
    return df.withColumns(
        {
            "hour": F.hour(t),
            "day_of_week": monday_based_weekday(t),
            "month": F.month(t),
            "hour_sin": F.sin(angle),
            "hour_cos": F.cos(angle),
        }
    )
