"""Snapshot files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from dockpulse.schemas import SNAPSHOT


def read_snapshots(
    spark: SparkSession, glob: str | list[str], schema: StructType = SNAPSHOT
) -> DataFrame:
    """All snapshot files that match, with a fixed schema so that no pass infers one."""
    return spark.read.schema(schema).option("header", True).csv(glob)


def write_snapshot_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.option("header", True).mode(mode).csv(path)
