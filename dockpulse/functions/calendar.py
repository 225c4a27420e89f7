"""Calendar and cyclic features, one definition for training and serving."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockpulse.functions.scalars import parse_timestamp


def local_time(ts_col: str | Column, tz: str | None = None) -> Column:
    """Wall-clock time; with ``tz``, UTC input is moved into that zone."""
    ts = parse_timestamp(ts_col)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts) if tz else ts


def calendar_features(df: DataFrame, ts_col: str, tz: str | None = None) -> DataFrame:
    """Add hour, weekday (0 = Monday), flags and their points on the circle."""
    ts = local_time(ts_col, tz)
    hour, day = F.col("hour"), F.col("day_of_week")
    turn = F.lit(2 * math.pi)
    return df.withColumns({"hour": F.hour(ts), "day_of_week": F.weekday(ts)}).withColumns(
        {
            "is_weekend": (day >= 5).cast("int"),
            "is_rush_hour": (hour.between(7, 9) | hour.between(17, 19)).cast("int"),
            "hour_sin": F.sin(turn * hour / 24),
            "hour_cos": F.cos(turn * hour / 24),
            "dow_sin": F.sin(turn * day / 7),
            "dow_cos": F.cos(turn * day / 7),
        }
    )
