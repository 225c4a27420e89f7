"""The jobs of a station fleet from end to end, each a few calls into the library."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.functions.calendar import calendar_features
from dockpulse.functions.scalars import change_badges, format_time
from dockpulse.operators import boosting, forecast, serving
from dockpulse.operators.clean import clean, dedupe_first, merge_snapshots
from dockpulse.operators.latest import snapshot_features
from dockpulse.operators.series import ts_features
from dockpulse.schemas import FEATURE_COLS, LABEL, SUBWAY_MARKER
from dockpulse.session import stage
from dockpulse.sources.feeds import explode_feed, read_feed
from dockpulse.sources.observations import encode_json, keyed_json, with_event_order
from dockpulse.sources.snapshots import read_snapshots, write_snapshot_csv
from dockpulse.streaming.compact import Compactor
from dockpulse.streaming.jobs import build_query
from dockpulse.streaming.store import StationStore


def publish_feed(
    spark: SparkSession,
    landing: str,
    sink: str,
    checkpoint: str,
    name_contains: str | None = SUBWAY_MARKER,
    trigger: str | None = "30 seconds",
    **options,
):
    """Stream landed feed documents into messages, one per station."""
    polls = read_feed(spark, landing, streaming=True, maxFilesPerTrigger=options.pop("files", 100))
    rows = explode_feed(polls, name_contains)
    messages = keyed_json(rows) if sink == "kafka" else encode_json(rows)
    return build_query(messages, sink, trigger, checkpoint, **options)


def collect_snapshot(spark: SparkSession, state: str, out: str) -> None:
    write_snapshot_csv(snapshot_features(StationStore(spark, state).current()), out)


def merge_files(spark: SparkSession, glob: str, out: str) -> None:
    write_snapshot_csv(merge_snapshots([read_snapshots(spark, glob)]), out)


class Trained(NamedTuple):
    model: PipelineModel
    metrics: DataFrame
    comparison: DataFrame
    importances: DataFrame
    rounds: DataFrame


def train(
    spark: SparkSession,
    glob: str,
    model_path: str,
    split: str = "hash",
    draw: str = "node",
    **trees,
) -> Trained:
    """Fit and save a forecast from snapshot files; errors of both parts, also by round.

    Columns are drawn for each ``node`` (Spark's own boosting), or for each ``tree`` (``fit_boosted``, which
    also penalises leaves and stops early). ``trees`` are the settings of either.
    """
    files = read_snapshots(spark, glob).select("station_id", "timestamp", "parking_count")
    seen = dedupe_first(clean(files), ["station_id", "timestamp"], ["parking_count"])
    seen = stage(seen, "snapshots")  # the texts are read once, not once per pass below
    wide = calendar_features(
        ts_features(with_event_order(seen), target_time=True), "observed_at"
    )
    kept = ["station_id", "observed_at", "target_at", *FEATURE_COLS, LABEL]
    rows = stage(wide.select(*kept), "training")
    parts = forecast.training_split(
        rows, ["station_id", "observed_at"], by=split, target_at="target_at"
    )
    if draw == "tree":
        model, by_round = boosting.fit_boosted(*parts, **trees)
    elif draw == "node":
        model, by_round = forecast.fit_forecaster(parts[0], **trees), None
    else:
        raise ValueError(f"draw must be 'node' or 'tree', not {draw!r}")
    forecast.save_model(model, model_path)
    errors = [
        forecast.model_metrics(model.transform(part)).withColumn("part", F.lit(name))
        for name, part in zip(("train", "test"), parts)
    ]
    return Trained(
        model,
        errors[0].unionByName(errors[1]),
        forecast.baseline_compare(model.transform(parts[1])),
        forecast.importances(model),
        _node_rounds(spark, model, parts) if by_round is None else _tree_rounds(by_round),
    )


def _node_rounds(spark: SparkSession, model: PipelineModel, parts: tuple) -> DataFrame:
    return spark.createDataFrame(
        [
            (name, i, error)
            for name, part in zip(("train", "test"), parts)
            for i, error in forecast.error_by_round(model, part)
        ],
        "part string, round int, rmse double",
    )


def _tree_rounds(rounds: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(p).alias("part"), "round", F.col(f"{p}_rmse").alias("rmse")) for p in ("train", "test")]
    return rounds.select(F.inline(F.array(*pairs)))


def stations(spark: SparkSession, state: str, text: str = "") -> DataFrame:
    """Every station with its forecast, change and labels; ``text`` searches the names."""
    listed = serving.listed(StationStore(spark, state).read())
    shown = change_badges(serving.station_change(serving.search_by_name(listed, text)))
    return format_time(shown, "current_at")


def station(spark: SparkSession, state: str, station_id: str) -> DataFrame:
    """One station, from the one bucket of the state that holds it."""
    return serving.station_change(serving.listed(StationStore(spark, state).station(station_id)))


def compact(
    spark: SparkSession, state: str, observations: str, before: str | None = None
) -> list[str]:
    """Rewrite the scored observations of the days before ``before`` into few files; those days."""
    return Compactor(spark, observations).run(StationStore(spark, state), before)


def stats(spark: SparkSession, state: str) -> DataFrame:
    return StationStore(spark, state).stats()
