"""Row cleaning, de-duplication and merging of snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def is_clean() -> Column:
    """True for a row with a station and a count that is zero or more; never null."""
    return F.coalesce(F.col("station_id").isNotNull() & (F.col("parking_count") >= 0), F.lit(False))


def clean(df: DataFrame) -> DataFrame:
    """Keep rows with a station and a count of zero or more; name and time may be missing."""
    return df.where(is_clean())


def dedupe_first(
    df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key by ``order_cols``.

    Spark limits each group to one row per task before the shuffle, so that a key with
    very many copies does not gather in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def merge_snapshots(
    frames: Sequence[DataFrame],
    keys: Sequence[str] = ("station_id", "timestamp"),
    order_cols: Sequence[str] = ("parking_count",),
) -> DataFrame:
    """All snapshots as one table, without repeated keys, sorted by key."""
    whole = reduce(DataFrame.unionByName, frames)
    return dedupe_first(whole, keys, order_cols).orderBy(*keys)


def dedupe_stream(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeats of ``keys`` in a stream that arrive within ``delay`` (an addition).

    The first step drops repeats within a source partition, so a key with very many copies
    is spread over tasks; the second leaves one row per key.
    """
    marked = df.withWatermark(event_time, delay).withColumn("_part", F.spark_partition_id())
    once_per_part = marked.dropDuplicatesWithinWatermark([*keys, "_part"]).drop("_part")
    return once_per_part.dropDuplicatesWithinWatermark(list(keys))
