"""The questions a client asks about the latest state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockpulse.functions.scalars import iso_text, percent
from dockpulse.schemas import LOW_STOCK


def station_list(current: DataFrame, prediction: DataFrame) -> DataFrame:
    """Stations that have both a current state and a prediction.

    Both sides hold one row per station; Spark picks the join by their size.
    """
    now = current.select(
        "station_id",
        "station_name",
        "parking_count",
        F.col("observed_at").alias("current_at"),
    )
    ahead = prediction.select(
        "station_id",
        "predicted_count",
        "model",
        F.col("observed_at").alias("predicted_at"),
    )
    return now.join(ahead, "station_id")


def listed(state: DataFrame) -> DataFrame:
    """The same from one table that holds both sides; rows without a prediction are left out."""
    return state.where(F.col("predicted_count").isNotNull()).select(
        "station_id",
        "station_name",
        "parking_count",
        F.col("observed_at").alias("current_at"),
        "predicted_count",
        "model",
        F.col("observed_at").alias("predicted_at"),
    )


def station_change(stations: DataFrame) -> DataFrame:
    return stations.withColumn("change", F.col("predicted_count") - F.col("parking_count"))


def station_detail(current: DataFrame, prediction: DataFrame, station_id) -> DataFrame:
    """One station with its change; no row when either side is missing."""
    wanted = F.col("station_id") == F.lit(station_id)
    return station_change(station_list(current.where(wanted), prediction.where(wanted)))


def station_documents(stations: DataFrame) -> DataFrame:
    """Each station as the nested JSON document a client reads, one per row."""
    ahead = ["predicted_count", "model", iso_text("predicted_at").alias("timestamp")]
    if "change" in stations.columns:
        ahead.append("change")
    document = F.struct(
        "station_id",
        "station_name",
        F.struct("parking_count", iso_text("current_at").alias("timestamp")).alias("current"),
        F.struct(*ahead).alias("prediction"),
    )
    return stations.select("station_id", F.to_json(document).alias("document"))


def fleet_totals(current: DataFrame, *by: str, low: int = LOW_STOCK) -> DataFrame:
    """The sums behind ``fleet_stats``; with ``by``, one row per value. Sums of parts can be added up."""
    bikes = F.coalesce(F.col("parking_count"), F.lit(0))
    return current.groupBy(*by).agg(
        F.count("*").alias("total_stations"),
        F.coalesce(F.sum(bikes), F.lit(0)).alias("total_bikes"),
        F.count_if(bikes < low).alias("low_stock_count"),
    )


def stats_of(totals: DataFrame) -> DataFrame:
    mean = F.coalesce(F.try_divide("total_bikes", "total_stations"), F.lit(0.0))
    return totals.select(
        "total_stations",
        "total_bikes",
        F.round(mean, 1).alias("average_bikes"),
        mean.alias("mean_bikes"),
        "low_stock_count",
    )


def fleet_stats(current: DataFrame, low: int = LOW_STOCK) -> DataFrame:
    """One row of totals over every current row, with or without a prediction."""
    return stats_of(fleet_totals(current, low=low))


def search_by_name(df: DataFrame, text: str, col: str = "station_name") -> DataFrame:
    """Rows whose name holds ``text`` in any case; empty text keeps all rows."""
    if not text:
        return df
    return df.where(F.contains(F.lower(F.col(col)), F.lower(F.lit(text))))


def usage_rate(df: DataFrame, key: str, value: str, total: str) -> DataFrame:
    """Mean of ``value / total * 100`` per key, highest first."""
    rate = F.avg(percent(value, total)).alias("usage_rate")
    return df.groupBy(key).agg(rate).orderBy(F.desc_nulls_last("usage_rate"), key)
