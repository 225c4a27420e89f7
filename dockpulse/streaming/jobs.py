"""Streaming queries: the station job and the three plain streams."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from dockpulse.functions.scalars import rule_prediction
from dockpulse.operators.clean import clean
from dockpulse.schemas import STREAM_LOW_STOCK
from dockpulse.session import hadoop_path
from dockpulse.streaming.upsert import kept, upsert_batch


def build_query(
    stream_df: DataFrame,
    sink: str | Callable[[DataFrame, int], None],
    trigger: str | None = "30 seconds",
    checkpoint: str | None = None,
    **options,
) -> StreamingQuery:
    """Start an append query into a format or a batch function.

    ``trigger=None`` takes all that is there and ends. Only console output may go without
    a checkpoint; a start over an old checkpoint carries on where it ended.
    """
    if checkpoint is None and sink != "console":
        raise ValueError("a checkpoint is needed, or a restart would lose messages")
    writer = stream_df.writeStream.outputMode("append")
    if callable(sink):
        writer = writer.foreachBatch(sink)
    else:
        defaults = {"truncate": "false"} if sink == "console" else {}
        writer = writer.format(sink).options(**{**defaults, **options})
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def station_job(
    observations: DataFrame,
    state_path: str,
    obs_path: str,
    checkpoint: str,
    model: PipelineModel | None = None,
    trigger: str | None = "30 seconds",
    order: str = "event",
    timeout: timedelta | None = None,
) -> StreamingQuery:
    """Clean, score and store a stream of decoded observations.

    ``order="arrival"`` lets the message that came last win, as the source numbered them. With
    ``timeout``, the history of a station that was silent for longer starts anew.
    """

    def on_batch(df: DataFrame, batch_id: int) -> None:
        query = query_id(df, checkpoint)
        upsert_batch(
            df, batch_id, state_path, obs_path, model, query, order=order, timeout=timeout
        )

    return build_query(clean(observations), on_batch, trigger, checkpoint)


def query_id(df: DataFrame, checkpoint: str) -> str:
    """The id Spark keeps with the checkpoint: batch numbers start again with a new one."""
    metadata = df.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata")
    return metadata.first()["id"]


def low_stock(decoded: DataFrame, below: int = STREAM_LOW_STOCK) -> DataFrame:
    return decoded.where(F.col("parking_count") < below)


def rule_stream(decoded: DataFrame) -> DataFrame:
    return rule_prediction(decoded).select(
        "station_id", "station_name", "parking_count", "predicted_count"
    )


RESULTS = {"raw": lambda decoded: decoded, "low_stock": low_stock, "rule": rule_stream}


def fan_out(
    decoded: DataFrame,
    folder: str,
    checkpoint: str,
    trigger: str | None = "30 seconds",
    results: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> StreamingQuery:
    """Several results of one stream from one query: a batch is read and decoded once.

    Each result goes to ``folder/<name>/batch=<query>-<number>``. The mark that Spark leaves in a
    folder once it is whole commits that result, so a batch that is run again writes only what was missing.
    ``read_result`` reads the folders that have the mark.
    """
    results = results or RESULTS

    def on_batch(df: DataFrame, batch_id: int) -> None:
        batch = f"{query_id(df, checkpoint)}-{batch_id}"
        missing = [n for n in results if not whole(df.sparkSession, f"{folder}/{n}/batch={batch}")]
        with kept(df) as rows:
            for name in missing:
                results[name](rows).write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch}")

    return build_query(decoded, on_batch, trigger, checkpoint)


def whole(spark: SparkSession, path: str) -> bool:
    mark, fs = hadoop_path(spark, f"{path}/_SUCCESS")
    return fs.exists(mark)


def read_result(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """The rows of one result of ``fan_out`` in committed batches; before the first one an empty table."""
    root, fs = hadoop_path(spark, f"{folder}/{name}")
    found = [s.getPath().toString() for s in fs.listStatus(root)] if fs.exists(root) else []
    paths = [p for p in found if whole(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def plain_streams(
    decoded: DataFrame,
    sink: str = "console",
    trigger: str | None = "30 seconds",
    folder: str | None = None,
) -> dict[str, StreamingQuery]:
    """Three queries over one stream: every row, low stock, and the rule forecast.

    A file sink writes below ``folder``. Wait with ``spark.streams.awaitAnyTermination()``.
    """
    started = {}
    for name, result in RESULTS.items():
        frame = result(decoded)
        options = {"path": f"{folder}/{name}"} if folder else {}
        checkpoint = f"{folder}/checkpoints/{name}" if folder else None
        started[name] = build_query(frame, sink, trigger, checkpoint, **options)
    return started
