"""Streaming jobs that take the whole event table, and what they leave behind."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockpulse.functions.scalars import parse_timestamp
from dockpulse.operators import forecast
from dockpulse.operators.clean import dedupe_stream
from dockpulse.plans.forecasting import training_rows
from dockpulse.plans.ingest import WIRE
from dockpulse.plans.registry import ISO, RAW, RULE, TEXT_ID, query
from dockpulse.plans.stations import LATEST, SERIES_COLS, SERIES_NAMES, SERVE, STATS, W
from dockpulse.schemas import MODEL_TAG
from dockpulse.session import shared_path, stage
from dockpulse.sources import observations as messages
from dockpulse.sources.warehouse import (
    as_messages,
    as_observations,
    observation_stream,
    table,
    table_stream,
)
from dockpulse.streaming import jobs
from dockpulse.streaming.compact import Compactor
from dockpulse.streaming.store import StationStore
from dockpulse.streaming.upsert import read_scored


def decoded_stream(spark, sf_dir):
    """Events sent as JSON messages and decoded again, as a stream."""
    rows = as_messages(observation_stream(spark, sf_dir))
    sent = rows.select(messages.json_text(WIRE).cast("binary").alias("value"), "seq")
    return messages.decode_json(sent)


def run_station_job(spark, sf_dir):
    folder = shared_path(spark, "stations")
    job = jobs.station_job(
        decoded_stream(spark, sf_dir),
        state_path=f"{folder}/state",
        obs_path=f"{folder}/observations",
        checkpoint=f"{folder}/checkpoint",
        trigger=None,
    )
    job.awaitTermination()
    return folder


def run_in_slices(spark, sf_dir, slices=3, timeout=None, after=None):
    """The events sent in slices of time; the job runs after each, over one checkpoint, and then ``after``."""
    folder = shared_path(spark, "slices")
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    rows = as_messages(as_observations(events))
    sent = rows.select(messages.json_text(WIRE).cast("binary").alias("value"), "seq", "observed_at")
    for i in range(slices if first else 0):
        low, high = (first + (last - first) * k / slices for k in (i, i + 1))
        until = F.col("observed_at") < high if i + 1 < slices else F.col("observed_at") <= last
        part = sent.where((F.col("observed_at") >= low) & until).drop("observed_at")
        part.write.mode("append").parquet(f"{folder}/messages")
        jobs.station_job(
            messages.decode_json(table_stream(spark, f"{folder}/messages")),
            state_path=f"{folder}/state",
            obs_path=f"{folder}/observations",
            checkpoint=f"{folder}/checkpoint",
            trigger=None,
            timeout=timeout,
        ).awaitTermination()
        if after:
            after(folder)
    return folder


def run_to_files(spark, frame, name):
    folder = shared_path(spark, name)
    job = jobs.build_query(
        frame, "parquet", None, f"{folder}/checkpoint", path=f"{folder}/rows"
    )
    job.awaitTermination()
    return spark.read.schema(frame.schema).parquet(f"{folder}/rows")


SCORED = f"""WITH {SERVE} SELECT {TEXT_ID}, seq, parking_count, {SERIES_COLS}, history,
      {RULE} AS predicted_count, 'simple' AS model
    FROM serve"""


@query(SCORED)
def stream_scored_observations(spark, sf_dir):
    """Every observation with the features and forecast it got in the stream."""
    return scored_columns(read_scored(spark, f"{run_station_job(spark, sf_dir)}/observations"))


@query(SCORED)
def stream_carried_history(spark, sf_dir):
    """The same from three runs of the job: each goes on with the history that the last one left."""
    return scored_columns(read_scored(spark, f"{run_in_slices(spark, sf_dir)}/observations"))


@query(SCORED)
def stream_compacted_observations(spark, sf_dir):
    """The same after compaction: first of every day, then of the days that a later run added rows to."""
    def compacted(folder):
        store = StationStore(spark, f"{folder}/state")
        Compactor(spark, f"{folder}/observations").run(store, least=1)

    folder = run_in_slices(spark, sf_dir, after=compacted)
    return scored_columns(read_scored(spark, f"{folder}/observations"))


SILENT = timedelta(hours=4)
_AFTER_GAPS = SERVE.split(", back AS")[1].replace("PARTITION BY station_id", "PARTITION BY station_id, part")


@query(
    f"""WITH {SERVE.split(", back AS")[0]}, gaps AS (
      SELECT *, coalesce(observed_at - lag(observed_at) {W} > INTERVAL 4 HOUR, FALSE) AS gap FROM obs),
    parts AS (SELECT * EXCLUDE (gap), sum(CAST(gap AS INT)) {W} AS part FROM gaps), back AS
    {_AFTER_GAPS.replace("FROM obs)", "FROM parts)")}
    SELECT {TEXT_ID}, seq, parking_count, {SERIES_COLS}, history,
      {RULE} AS predicted_count, 'simple' AS model
    FROM serve"""
)
def stream_expiring_history(spark, sf_dir):
    """Three runs of the job in which a station that was silent for four hours starts a new history."""
    return scored_columns(read_scored(spark, f"{run_in_slices(spark, sf_dir, timeout=SILENT)}/observations"))


def scored_columns(scored):
    return scored.select(
        "station_id",
        "seq",
        "parking_count",
        *SERIES_NAMES,
        F.array_join("history", ",").alias("history"),
        "predicted_count",
        "model",
    )


@query(
    f"""WITH {SERVE}, latest AS (
      SELECT *, {ISO} AS timestamp, row_number() OVER (PARTITION BY station_id
        ORDER BY observed_at DESC, seq DESC) AS rn FROM serve)
    SELECT {TEXT_ID}, station_name, parking_count, rack_total, timestamp,
      {RULE} AS predicted_count, 'simple' AS model, history
    FROM latest WHERE rn = 1"""
)
def stream_station_state(spark, sf_dir):
    """The state of every station once the stream has ended."""
    state = StationStore(spark, f"{run_station_job(spark, sf_dir)}/state").read()
    return state.drop("observed_at", "seq").withColumn("history", F.array_join("history", ","))


@query(
    f"""WITH {RAW} SELECT seq, {TEXT_ID}, station_name, parking_count, rack_total,
      {ISO} AS timestamp FROM raw WHERE parking_count < 10"""
)
def stream_low_stock(spark, sf_dir):
    return run_to_files(spark, jobs.low_stock(decoded_stream(spark, sf_dir)), "low-stock")


@query(
    f"""WITH {RAW} SELECT {TEXT_ID}, station_name, parking_count, {RULE} AS predicted_count
    FROM raw"""
)
def stream_rule_prediction(spark, sf_dir):
    return run_to_files(spark, jobs.rule_stream(decoded_stream(spark, sf_dir)), "rule")


@query(
    f"""WITH {RAW}, results AS (
      SELECT 'raw' AS result, station_id, station_name, parking_count, NULL AS predicted FROM raw
      UNION ALL SELECT 'low_stock', station_id, station_name, parking_count, NULL FROM raw
        WHERE parking_count < 10
      UNION ALL SELECT 'rule', station_id, station_name, parking_count, {RULE} FROM raw)
    SELECT result, {TEXT_ID}, station_name, parking_count, CAST(predicted AS INT) AS predicted_count
    FROM results"""
)
def stream_three_results(spark, sf_dir):
    """Every row, low stock and the rule forecast, from one read of the stream."""
    folder = shared_path(spark, "results")
    decoded = decoded_stream(spark, sf_dir)
    jobs.fan_out(decoded, f"{folder}/rows", f"{folder}/checkpoint", None).awaitTermination()
    parts = []
    for name, result in jobs.RESULTS.items():
        rows = jobs.read_result(spark, f"{folder}/rows", name, result(decoded).schema)
        if "predicted_count" not in rows.columns:
            rows = rows.withColumn("predicted_count", F.lit(None).cast("int"))
        shown = ["station_id", "station_name", "parking_count", "predicted_count"]
        parts.append(rows.select(F.lit(name).alias("result"), *shown))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"WITH {LATEST} {STATS}")
def stream_fleet_stats(spark, sf_dir):
    """The statistics that three runs of the job kept beside the state; the state is not scanned for them."""
    return StationStore(spark, f"{run_in_slices(spark, sf_dir)}/state").stats()


_UNTIMED = SERVE.replace(
    "ts AS observed_at", "CASE WHEN event_type <> 'error' THEN ts END AS observed_at"
).replace("ORDER BY observed_at, seq", "ORDER BY observed_at NULLS FIRST, seq")


@query(
    f"""WITH {_UNTIMED}
    SELECT {TEXT_ID}, seq, parking_count, {SERIES_COLS}, history,
      CASE WHEN event_type = 'error' THEN 'simple' ELSE 'xgboost' END AS model,
      CASE WHEN event_type = 'error' THEN {RULE} END AS rule_count, TRUE AS as_in_batch
    FROM serve"""
)
def stream_model_fallback(spark, sf_dir):
    """A stream with a fitted model. Messages of ``error`` events have no readable time: they get the rule.

    ``as_in_batch``: the model gives the same forecast for the stored features outside the stream.
    """
    folder = shared_path(spark, "scored-by-model")
    model = forecast.fit_forecaster(stage(training_rows(spark, sf_dir), "training"), maxIter=10)
    rows = as_messages(observation_stream(spark, sf_dir, extra=["event_type"]))
    time = F.when(F.col("event_type") == "error", "at noon").otherwise(F.col("timestamp"))
    sent = rows.withColumn("timestamp", time).select(messages.json_text(WIRE).alias("value"), "seq")
    jobs.station_job(
        messages.decode_json(sent),
        state_path=f"{folder}/state",
        obs_path=f"{folder}/observations",
        checkpoint=f"{folder}/checkpoint",
        model=model,
        trigger=None,
    ).awaitTermination()
    scored = read_scored(spark, f"{folder}/observations")
    scored = scored.withColumns({"streamed": F.col("predicted_count"), "tag": F.col("model")})
    again = forecast.score_with_fallback(model, scored.drop("predicted_count", "model"))
    same = F.col("predicted_count").eqNullSafe(F.col("streamed")) & (F.col("model") == F.col("tag"))
    return again.select(
        "station_id",
        "seq",
        "parking_count",
        *SERIES_NAMES,
        F.array_join("history", ",").alias("history"),
        F.col("tag").alias("model"),
        F.when(F.col("tag") != MODEL_TAG, F.col("streamed")).alias("rule_count"),
        same.alias("as_in_batch"),
    )


@query(f"WITH {RAW} SELECT {TEXT_ID}, seq, parking_count FROM raw")
def stream_deduplicated(spark, sf_dir, slices=3):
    """Each event once, from slices of time that repeat all that came before and their own; a restart after each."""
    folder = shared_path(spark, "once")
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    rows = as_messages(as_observations(events))
    sent = rows.select(messages.json_text([*WIRE, "seq"]).alias("value"), "observed_at")
    layout = "station_id string, parking_count int, timestamp string, seq long"
    for i in range(slices if first else 0):
        part = sent.where(F.col("observed_at") <= first + (last - first) * (i + 1) / slices).drop("observed_at")
        part.unionByName(part).write.mode("append").parquet(f"{folder}/messages")
        decoded = messages.decode_json(
            table_stream(spark, f"{folder}/messages"), T._parse_datatype_string(layout)
        )
        timed = decoded.withColumn("at", parse_timestamp("timestamp").cast("timestamp"))
        once = dedupe_stream(timed, ["seq"], "at", f"{(last - first).days + 2} days")
        jobs.build_query(
            once.select("station_id", "seq", "parking_count"),
            "parquet",
            None,
            f"{folder}/checkpoint",
            path=f"{folder}/rows",
        ).awaitTermination()
    return spark.read.schema("station_id string, seq long, parking_count int").parquet(f"{folder}/rows")
