"""Column expressions, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockpulse.schemas import MODEL_TAG, RULE_FACTOR, RULE_TAG

# Texts and patterns a client shows.
TIME_PATTERN = "M월 d일 HH:mm:ss"
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
BADGE_MODEL = "🤖 ML 예측"
BADGE_RULE = "📐 규칙 예측"
SYMBOL_UP, SYMBOL_DOWN = "▲", "▼"
CLASS_UP, CLASS_DOWN = "positive", "negative"
TREND_UP, TREND_DOWN = "증가", "감소"


def parse_timestamp(column: str | Column) -> Column:
    """Wall-clock time of ISO text; null when it cannot be read. An offset is ignored."""
    return _col(column).try_cast("timestamp_ntz")


def iso_text(column: str | Column) -> Column:
    return F.date_format(_col(column), ISO_PATTERN)


def rule_count(value: str | Column, factor: float = RULE_FACTOR) -> Column:
    """The rule forecast: a fixed share of the current count, cut to an integer."""
    return (_col(value) * F.lit(factor)).cast("int")


def rule_prediction(
    df: DataFrame, value: str = "parking_count", factor: float = RULE_FACTOR
) -> DataFrame:
    return df.withColumn("predicted_count", rule_count(value, factor))


def percent(part: str | Column, whole: str | Column) -> Column:
    """``part / whole * 100``, null for a zero or missing ``whole``."""
    return F.try_divide(_col(part), _col(whole)) * 100


def station_key(station_id: str | Column, *parts: str) -> Column:
    """``station:{id}:current`` and the like."""
    return F.concat_ws(":", F.lit("station"), _col(station_id), *[F.lit(p) for p in parts])


def key_station(key: str | Column) -> Column:
    """The station id inside a key; null when the key has no second part."""
    return F.get(F.split(_col(key), ":"), F.lit(1))


def key_codec(df: DataFrame, col: str = "station_id", kind: str = "current") -> DataFrame:
    """Add the state key of a station and the id read back from it."""
    return df.withColumn("state_key", station_key(col, kind)).withColumn(
        "key_id", key_station("state_key")
    )


def format_time(df: DataFrame, col: str, out: str = "time_text") -> DataFrame:
    return df.withColumn(out, F.date_format(parse_timestamp(col), TIME_PATTERN))


def change_badges(df: DataFrame, change: str = "change", model: str = "model") -> DataFrame:
    """Class, symbol, size and text of a change, and the label of the model that made it."""
    up = F.col(change) >= 0
    tag = F.coalesce(F.col(model), F.lit(RULE_TAG))
    return df.withColumns(
        {
            "change_class": F.when(up, CLASS_UP).otherwise(CLASS_DOWN),
            "change_symbol": F.when(up, SYMBOL_UP).otherwise(SYMBOL_DOWN),
            "change_size": F.abs(F.col(change)),
            "change_trend": F.when(up, TREND_UP).otherwise(TREND_DOWN),
            "model_label": F.when(tag == MODEL_TAG, BADGE_MODEL).otherwise(BADGE_RULE),
        }
    )


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
