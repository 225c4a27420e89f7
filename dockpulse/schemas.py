"""Record layouts shared by batch and stream jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: wire names and types that producers and clients rely on ---
OBSERVATION = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("parking_count", T.IntegerType()),
        T.StructField("rack_total", T.IntegerType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

FEED = T.StructType(
    [
        T.StructField(
            "rentBikeStatus",
            T.StructType(
                [
                    T.StructField(
                        "row",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("stationId", T.StringType()),
                                    T.StructField("stationName", T.StringType()),
                                    T.StructField("parkingBikeTotCnt", T.StringType()),
                                    T.StructField("rackTotCnt", T.StringType()),
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("parking_count", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("is_weekend", T.IntegerType()),
    ]
)

# Order of the model input; a saved model depends on it.
FEATURE_COLS = [
    "parking_count",
    "hour",
    "day_of_week",
    "is_weekend",
    "is_rush_hour",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    "parking_count_lag_1",
    "parking_count_lag_2",
    "parking_count_lag_3",
    "parking_count_ma_3",
    "parking_count_ma_6",
    "parking_count_diff_1",
]

LABEL = "target"
SUBWAY_MARKER = "역"
LOW_STOCK = 5
STREAM_LOW_STOCK = 10
RULE_FACTOR = 0.85
HISTORY_DEPTH = 6
MODEL_TAG = "xgboost"
RULE_TAG = "simple"
# --- end of fixed values ---
