"""The given tables, and ``events`` read as observations of stations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.functions.scalars import iso_text
from dockpulse.session import hadoop_path

FILES = 100  # of a table's files in a micro-batch, unless the caller says otherwise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return as_observations(clean_events(spark, sf_dir), *extra)


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that are clean as observations: with a station, and a count of zero or more."""
    return table(spark, sf_dir, "events").where(
        F.col("user_id").isNotNull() & (F.col("value").try_cast("int") >= 0)
    )


def as_observations(events: DataFrame, *extra: str) -> DataFrame:
    """Each user as a station and each event as an observation of it, with ``extra`` columns."""
    return events.select(
        F.col("user_id").alias("station_id"),  # uncast, so that key filters reach the scan
        F.concat(F.lit("Dock "), F.col("user_id")).alias("station_name"),
        F.col("value").try_cast("int").alias("parking_count"),
        F.from_json("props", "k int")["k"].alias("rack_total"),
        F.col("ts").alias("observed_at"),
        F.col("event_id").alias("seq"),
        *extra,
    )


def observation_stream(
    spark: SparkSession, sf_dir: str, extra: Sequence[str] = (), **options
) -> DataFrame:
    """``events`` as a stream, ``maxFilesPerTrigger`` files of the table at a time, with ``extra`` columns."""
    events = table_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet", **options)
    return as_observations(events, *extra)


def table_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """A parquet table as a stream: a folder of part files, or one file.

    A table without any file raises, since a stream over it would end without a row or an error.
    """
    found, fs = hadoop_path(spark, path)
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).options(**{"maxFilesPerTrigger": FILES, **options})
    if not fs.getFileStatus(found).isDirectory():
        name = found.getName()
        return reader.option("pathGlobFilter", name).parquet(found.getParent().toString())
    files = fs.listFiles(found, True)
    while files.hasNext():
        if not files.next().getPath().getName().startswith(("_", ".")):
            return reader.parquet(path)
    raise FileNotFoundError(f"{path} holds no files")


def as_messages(df: DataFrame) -> DataFrame:
    """Observations with id and time as the texts that go on the wire."""
    return df.withColumns(
        {"station_id": F.col("station_id").cast("string"), "timestamp": iso_text("observed_at")}
    )
