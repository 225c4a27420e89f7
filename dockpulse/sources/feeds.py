"""The nested feed document: one document holds a list of stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.functions.scalars import iso_text
from dockpulse.schemas import FEED


def read_feed(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """Landed feed documents, one file each; a stream takes ``maxFilesPerTrigger`` at a time.

    ``polled_at`` is when the file was landed, so that polls read together keep their own times.
    """
    reader = (spark.readStream if streaming else spark.read).schema(FEED)
    documents = reader.options(**{"multiLine": "true", **options}).json(path)
    return documents.select("*", F.col("_metadata.file_modification_time").alias("polled_at"))


def decode_feed(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Feed documents given as text, each parsed once."""
    others = [c for c in df.columns if c != value_col]
    return df.select(*others, F.inline(F.array(F.from_json(value_col, FEED))))


def explode_feed(
    df: DataFrame,
    name_contains: str | None = None,
    strict: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """One observation per listed station.

    A document without the list gives no rows. ``name_contains`` keeps stations by name, ``limit``
    reads only the first entries of each document. A count that is no integer drops the
    station; with ``strict`` it, or a missing name, drops the whole document. The time is that of
    the poll, ``polled_at``, and only without such a column the present.
    """
    others = [c for c in df.columns if c not in ("rentBikeStatus", "polled_at")]
    stamp = F.col("polled_at") if "polled_at" in df.columns else F.current_timestamp()
    df = df.withColumn("_stamp", stamp)
    rows = F.col("rentBikeStatus.row")
    if limit is not None:
        rows = F.slice(rows, 1, limit)
    if strict:
        df = df.where(F.forall(rows, lambda r: _readable(r, name_contains)))
    if name_contains:  # before the list becomes rows
        rows = F.filter(rows, lambda r: F.contains(r["stationName"], F.lit(name_contains)))
    out = df.select(*others, "_stamp", F.explode(rows).alias("_s"))
    out = out.where(_counts_readable(F.col("_s")))
    stations = out.select(
        *others,
        "_stamp",
        F.col("_s.stationId").alias("station_id"),
        F.col("_s.stationName").alias("station_name"),
        F.col("_s.parkingBikeTotCnt").try_cast("int").alias("parking_count"),
        F.col("_s.rackTotCnt").try_cast("int").alias("rack_total"),
    )
    if "timestamp" not in others:
        stations = stations.withColumn("timestamp", iso_text("_stamp"))
    return stations.drop("_stamp")


def _readable(row, name_contains):
    """False for a row that makes its whole document unusable."""
    fine = _counts_readable(row)
    if name_contains:
        fine = fine | ~F.contains(row["stationName"], F.lit(name_contains))
    return F.coalesce(row["stationName"].isNotNull() & fine, F.lit(False))


def _counts_readable(row):
    return (
        row["parkingBikeTotCnt"].try_cast("int").isNotNull()
        & row["rackTotCnt"].try_cast("int").isNotNull()
    )
