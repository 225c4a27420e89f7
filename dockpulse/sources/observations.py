"""Observation messages: streams or files in, JSON out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dockpulse.functions.scalars import parse_timestamp
from dockpulse.operators.clean import is_clean
from dockpulse.schemas import OBSERVATION


def read_observations(
    spark: SparkSession, fmt: str, streaming: bool = True, **options
) -> DataFrame:
    """Messages as a column ``value``, with columns that say where in the source they stand.

    From ``kafka`` these are ``source_part`` (the partition), ``seq`` (the offset) and ``arrived_at``;
    from files ``source_part`` and ``source_block``, the file and the start of its part that is read.

    ``fmt`` is ``kafka`` (which needs Spark's Kafka connector; a stream starts at the latest
    message unless told otherwise) or any file format with a ``value`` column, such as ``text``.
    """
    if fmt == "kafka" and streaming:
        options = {"startingOffsets": "latest", **options}
    path = options.pop("path", None)
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**options)
    if fmt not in ("kafka", "text"):
        reader = reader.schema("value string")
    raw = reader.load(path) if path else reader.load()
    if "offset" in raw.columns:
        arrived = F.col("timestamp").alias("arrived_at")
        part = F.format_string("%06d", "partition").alias("source_part")
        return raw.select("value", part, F.col("offset").alias("seq"), arrived)
    return raw.select(
        "value",
        F.col("_metadata.file_path").alias("source_part"),
        F.col("_metadata.file_block_start").alias("source_block"),
    )


def decode_json(
    df: DataFrame,
    schema: StructType = OBSERVATION,
    value_col: str = "value",
    quarantine: bool = False,
) -> DataFrame:
    """Messages as typed columns beside the other columns of ``df``.

    A message or field that cannot be read becomes null. With ``quarantine`` the raw message and
    the reason why cleaning would drop it (null if it would not) are kept as columns.
    """
    others = [c for c in df.columns if c != value_col]
    text = F.col(value_col).cast("string")
    # As a one-row generator the message is parsed once; as a struct it would be parsed per field.
    fields = F.inline(F.array(F.from_json(text, schema)))
    if not quarantine:
        return df.select(*others, fields)
    present = [F.col(name).cast("string") for name in schema.fieldNames()]
    reason = (
        F.when(is_clean(), None)
        .when(F.coalesce(*present).isNull(), "unreadable")
        .when(F.col("station_id").isNull(), "no station")
        .otherwise("bad count")
    )
    decoded = df.select(*others, text.alias("raw"), fields)
    return decoded.withColumn("reject_reason", reason)


def with_event_order(df: DataFrame) -> DataFrame:
    """Add the typed time, and a position from the row's content if the source gave none."""
    timed = df.withColumn("observed_at", parse_timestamp("timestamp"))
    if "seq" in df.columns:
        return timed
    return timed.withColumn("seq", F.xxhash64(*[F.col(c) for c in df.columns]))


def encode_json(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Each row as one JSON text in the column ``value``."""
    return df.select(json_text(cols or df.columns).alias("value"))


def keyed_json(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """The same with the station as ``key``."""
    key = F.col("station_id").cast("string").alias("key")
    return df.select(key, json_text(cols or df.columns).alias("value"))


def json_text(cols: list[str]) -> Column:
    return F.to_json(F.struct(*cols))


def publish(df: DataFrame, fmt: str, cols: list[str] | None = None, **options) -> None:
    """Write each row as one JSON message, to ``kafka`` or to files such as ``text``.

    In Kafka the key is the station, so that its messages keep their order in one partition.
    """
    path = options.pop("path", None)
    if fmt == "kafka":
        options = {"kafka.acks": "all", "kafka.retries": "3", **options}
    sent = keyed_json(df, cols) if fmt == "kafka" else encode_json(df, cols)
    sent.write.format(fmt).mode("append").options(**options).save(path)
