"""Latest state per station, and the snapshot made from it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockpulse.functions.calendar import calendar_features
from dockpulse.functions.scalars import iso_text
from dockpulse.operators.clean import dedupe_first


def latest_state(
    df: DataFrame,
    key: str = "station_id",
    order_cols: Sequence[str] = ("observed_at", "seq"),
    as_of: datetime | None = None,
) -> DataFrame:
    """The last row of each key by ``order_cols``; one row per key and task is shuffled.

    With ``as_of``, the state at that moment: later rows of the first order column do not count.
    """
    if as_of is not None:
        # As text, because a datetime literal would be moved into the session's time zone.
        df = df.where(F.col(order_cols[0]) <= F.lit(as_of.isoformat()).cast("timestamp_ntz"))
    return dedupe_first(df, [key], [F.col(c).desc_nulls_last() for c in order_cols])


def states_at(
    df: DataFrame,
    moments: Sequence[datetime],
    key: str = "station_id",
    order_cols: Sequence[str] = ("observed_at", "seq"),
) -> DataFrame:
    """The state at each of several moments, with the moment as ``as_of``, from one scan.

    A row counts from the first moment that is not before it. Of a key's rows that start at one moment the last
    is kept, which Spark does before the shuffle, so a key has at most one row a moment from then on,
    however hot it is. That row then stands until the moment at which the key's next row starts.
    """
    marks = sorted(set(moments))
    if not marks:
        return df.limit(0).withColumn("as_of", F.lit(None).cast("timestamp_ntz"))
    times = F.array(*[F.lit(m.isoformat()).cast("timestamp_ntz") for m in marks])
    at = F.col(order_cols[0])
    start = F.size(F.filter(times, lambda m: m < at))
    rows = df.where(at.isNotNull()).withColumn("_from", start).where(F.col("_from") < len(marks))
    last = dedupe_first(rows, [key, "_from"], [F.col(c).desc_nulls_last() for c in order_cols])
    until = F.lead("_from", 1, len(marks)).over(Window.partitionBy(key).orderBy("_from"))
    spans = last.withColumn("_until", until)
    shown = F.slice(times, F.col("_from") + 1, F.col("_until") - F.col("_from"))
    return spans.withColumn("as_of", F.explode(shown)).drop("_from", "_until")


def snapshot_features(
    current: DataFrame, tz: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One snapshot row per station that has a count, with the columns ``keep`` before it."""
    present = current.where(F.col("parking_count").isNotNull())
    return calendar_features(present, "observed_at", tz).select(
        *keep,
        "station_id",
        iso_text("observed_at").alias("timestamp"),
        "parking_count",
        "hour",
        "day_of_week",
        "is_weekend",
    )
