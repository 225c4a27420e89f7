"""Series features, latest state and the serving questions, over events as observations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockpulse.functions import calendar, scalars
from dockpulse.operators import clean, latest, series, serving
from dockpulse.operators.names import NameIndex
from dockpulse.plans.registry import CALENDAR, ISO, OBS, RULE, TEXT_ID, query
from dockpulse.schemas import LOW_STOCK, RULE_TAG
from dockpulse.session import shared_path, using
from dockpulse.sources.warehouse import as_messages, as_observations, clean_events, observations
from dockpulse.streaming import jobs

W = "OVER (PARTITION BY station_id ORDER BY observed_at, seq)"


def _frame(rows: int) -> str:
    return (
        "OVER (PARTITION BY station_id ORDER BY observed_at, seq "
        f"ROWS BETWEEN {rows} PRECEDING AND CURRENT ROW)"
    )


TRAIN = f"""{OBS}, wide AS (
  SELECT station_id, seq, observed_at, parking_count,
    lag(parking_count, 1) {W} AS parking_count_lag_1,
    lag(parking_count, 2) {W} AS parking_count_lag_2,
    lag(parking_count, 3) {W} AS parking_count_lag_3,
    avg(parking_count) {_frame(2)} AS parking_count_ma_3,
    avg(parking_count) {_frame(5)} AS parking_count_ma_6,
    parking_count - lag(parking_count, 1) {W} AS parking_count_diff_1,
    parking_count - lag(parking_count, 2) {W} AS parking_count_diff_2,
    lead(parking_count, 2) {W} AS target
  FROM obs), train AS (
  SELECT * FROM wide WHERE station_id IS NOT NULL AND observed_at IS NOT NULL
    AND parking_count IS NOT NULL AND parking_count_lag_3 IS NOT NULL AND target IS NOT NULL)"""

_LAGS = ",\n    ".join(f"coalesce(lag(parking_count, {k}) {W}, 0) AS l{k}" for k in range(1, 6))

SERVE = f"""{OBS}, back AS (
  SELECT *, {_LAGS},
    lag(parking_count, 1) {W} AS h1, lag(parking_count, 2) {W} AS h2,
    lag(parking_count, 3) {W} AS h3, lag(parking_count, 4) {W} AS h4,
    lag(parking_count, 5) {W} AS h5
  FROM obs), serve AS (
  SELECT *, l1 AS parking_count_lag_1, l2 AS parking_count_lag_2, l3 AS parking_count_lag_3,
    (parking_count + l1 + l2) / 3 AS parking_count_ma_3,
    (parking_count + l1 + l2 + l3 + l4 + l5) / 6 AS parking_count_ma_6,
    parking_count - l1 AS parking_count_diff_1,
    concat_ws(',', parking_count, h1, h2, h3, h4, h5) AS history
  FROM back)"""

SERIES_COLS = """parking_count_lag_1, parking_count_lag_2, parking_count_lag_3,
  parking_count_ma_3, parking_count_ma_6, parking_count_diff_1"""
SERIES_NAMES = [c.strip() for c in SERIES_COLS.split(",")]

LATEST = f"""{OBS}, latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id
    ORDER BY observed_at DESC, seq DESC) AS rn FROM obs) WHERE rn = 1)"""

# every station with the rule's forecast from its last observation
LISTED = f"""{LATEST}, listed AS (
  SELECT station_id, station_name, parking_count, observed_at AS current_at,
         {RULE} AS predicted_count, 'simple' AS model, observed_at AS predicted_at
  FROM latest)"""


def last_events(events):
    """The last event of each station, before anything is decoded or computed from it."""
    return latest.latest_state(events, "user_id", ("ts", "event_id"))


def current_state(spark, sf_dir):
    return as_observations(last_events(clean_events(spark, sf_dir)))


def scored_state(spark, sf_dir):
    """The last observation of every station with the rule's forecast from it."""
    scored = scalars.rule_prediction(current_state(spark, sf_dir))
    return scored.withColumn("model", F.lit(RULE_TAG))


def listed_stations(spark, sf_dir):
    return serving.listed(scored_state(spark, sf_dir))


@query(
    f"""WITH {TRAIN} SELECT station_id, seq, observed_at, parking_count, {SERIES_COLS},
    parking_count_diff_2, target FROM train"""
)
def ts_features_train(spark, sf_dir):
    obs = observations(spark, sf_dir).select("station_id", "seq", "observed_at", "parking_count")
    return series.ts_features(obs, mode="train")


@query(
    f"""WITH {TRAIN} SELECT station_id, seq, observed_at, parking_count, {SERIES_COLS},
    parking_count_diff_2, target FROM train"""
)
def ts_features_split(spark, sf_dir):
    """The same training features with the larger stations cut into pieces."""
    settings = {"spark.dockpulse.hotKeyRows": "60", "spark.dockpulse.pieceRows": "1000"}
    with using(spark, settings):
        return ts_features_train(spark, sf_dir)


@query(
    f"""WITH {SERVE} SELECT station_id, seq, observed_at, parking_count, {SERIES_COLS}
    FROM serve"""
)
def ts_features_serve(spark, sf_dir):
    obs = observations(spark, sf_dir).select("station_id", "seq", "observed_at", "parking_count")
    return series.ts_features(obs, mode="serve")


@query(f"WITH {SERVE} SELECT station_id, seq, history FROM serve")
def history_register(spark, sf_dir):
    kept = series.history_register(
        observations(spark, sf_dir).select("station_id", "seq", "observed_at", "parking_count")
    )
    return kept.select("station_id", "seq", F.array_join("history", ",").alias("history"))


@query(f"WITH {OBS} SELECT seq, {CALENDAR} FROM obs")
def calendar_features(spark, sf_dir):
    obs = observations(spark, sf_dir).select("seq", "observed_at")
    return calendar.calendar_features(obs, "observed_at").drop("observed_at")


@query(f"WITH {OBS} SELECT seq, parking_count, {RULE} AS predicted_count FROM obs")
def rule_prediction(spark, sf_dir):
    return scalars.rule_prediction(observations(spark, sf_dir)).select(
        "seq", "parking_count", "predicted_count"
    )


@query(f"WITH {OBS} SELECT station_id, seq, parking_count FROM obs WHERE parking_count < 10")
def low_stock_filter(spark, sf_dir):
    return jobs.low_stock(observations(spark, sf_dir)).select("station_id", "seq", "parking_count")


@query(
    f"""WITH {LATEST} SELECT station_id, station_name, parking_count, rack_total, observed_at, seq
    FROM latest"""
)
def latest_state(spark, sf_dir):
    return current_state(spark, sf_dir)


STATS = f"""SELECT count(*) AS total_stations,
      CAST(sum(parking_count) AS BIGINT) AS total_bikes,
      round(sum(parking_count) / count(*), 1) AS average_bikes,
      CAST(sum(parking_count) AS DOUBLE) / count(*) AS mean_bikes,
      CAST(count_if(parking_count < {LOW_STOCK}) AS BIGINT) AS low_stock_count
    FROM latest"""


@query(f"WITH {LATEST} {STATS}")
def fleet_stats(spark, sf_dir):
    return serving.fleet_stats(current_state(spark, sf_dir))


@query(f"WITH {LISTED} SELECT * FROM listed")
def station_list(spark, sf_dir):
    return listed_stations(spark, sf_dir)


@query(
    f"""WITH {LISTED} SELECT *, predicted_count - parking_count AS change
    FROM listed WHERE station_id = 42"""
)
def station_detail(spark, sf_dir):
    listed = serving.listed(scored_state(spark, sf_dir).where("station_id = 42"))
    return serving.station_change(listed)


@query(f"WITH {LISTED} SELECT *, predicted_count - parking_count AS change FROM listed")
def station_change(spark, sf_dir):
    return serving.station_change(listed_stations(spark, sf_dir))


@query(
    f"""WITH {LISTED}, changed AS (
      SELECT *, predicted_count - parking_count AS change FROM listed)
    SELECT station_id, change,
      CASE WHEN change >= 0 THEN 'positive' ELSE 'negative' END AS change_class,
      CASE WHEN change >= 0 THEN '▲' ELSE '▼' END AS change_symbol,
      abs(change) AS change_size,
      CASE WHEN change >= 0 THEN '증가' ELSE '감소' END AS change_trend,
      CASE WHEN model = 'xgboost' THEN '🤖 ML 예측' ELSE '📐 규칙 예측' END AS model_label
    FROM changed"""
)
def change_badges(spark, sf_dir):
    changed = serving.station_change(listed_stations(spark, sf_dir))
    return scalars.change_badges(changed).select(
        "station_id",
        "change",
        "change_class",
        "change_symbol",
        "change_size",
        "change_trend",
        "model_label",
    )


@query(
    f"""WITH {LISTED} SELECT station_id,
      '{{"station_id":' || station_id || ',"station_name":"' || station_name
      || '","current":{{"parking_count":' || parking_count || ',"timestamp":"'
      || strftime(current_at, '%Y-%m-%dT%H:%M:%S.%f')
      || '"}},"prediction":{{"predicted_count":' || predicted_count
      || ',"model":"' || model || '","timestamp":"'
      || strftime(predicted_at, '%Y-%m-%dT%H:%M:%S.%f')
      || '","change":' || (predicted_count - parking_count) || '}}}}' AS document
    FROM listed"""
)
def station_documents(spark, sf_dir):
    changed = serving.station_change(listed_stations(spark, sf_dir))
    return serving.station_documents(changed)


@query(
    f"""WITH {LATEST} SELECT station_id, {ISO} AS timestamp, parking_count,
      CAST(hour(observed_at) AS INT) AS hour,
      CAST(isodow(observed_at) - 1 AS INT) AS day_of_week,
      CAST(isodow(observed_at) >= 6 AS INT) AS is_weekend
    FROM latest"""
)
def snapshot_features(spark, sf_dir):
    return latest.snapshot_features(current_state(spark, sf_dir))


@query(
    f"""WITH {OBS} SELECT station_id, observed_at, parking_count, seq FROM (
      SELECT *, row_number() OVER (PARTITION BY station_id, CAST(observed_at AS DATE)
        ORDER BY observed_at, seq) AS rn FROM obs) WHERE rn = 1"""
)
def dedupe_first(spark, sf_dir):
    """The first observation of each station and day."""
    obs = observations(spark, sf_dir).select("station_id", "observed_at", "parking_count", "seq")
    daily = obs.withColumn("day", F.to_date("observed_at"))
    return clean.dedupe_first(daily, ["station_id", "day"], ["observed_at", "seq"]).drop("day")


@query(
    f"""WITH {OBS} SELECT DISTINCT {TEXT_ID}, {ISO} AS timestamp, parking_count
    FROM obs ORDER BY station_id, timestamp"""
)
def merge_snapshots(spark, sf_dir):
    """All observations, once more those of low stock, and each only once."""
    rows = observations(spark, sf_dir).select("station_id", "observed_at", "parking_count")
    merged = clean.merge_snapshots([rows, jobs.low_stock(rows)], ("station_id", "observed_at"))
    # Text is made last: times are compared and sorted as numbers.
    return as_messages(merged).drop("observed_at")


@query(
    f"""WITH {OBS} SELECT seq, strftime(observed_at, '%-m월 %-d일 %H:%M:%S') AS time_text
    FROM obs"""
)
def format_time(spark, sf_dir):
    obs = observations(spark, sf_dir).select("seq", "observed_at")
    return scalars.format_time(obs, "observed_at").select("seq", "time_text")


@query(
    f"""WITH {OBS} SELECT seq, 'station:' || station_id || ':current' AS state_key,
      CAST(station_id AS VARCHAR) AS key_id FROM obs"""
)
def key_codec(spark, sf_dir):
    return scalars.key_codec(observations(spark, sf_dir)).select("seq", "state_key", "key_id")


@query(
    f"""WITH {OBS}, sides AS (
      SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY observed_at DESC, seq DESC) AS rn,
        row_number() OVER (PARTITION BY station_id, event_type <> 'error'
          ORDER BY observed_at DESC, seq DESC) AS good FROM obs)
    SELECT CAST(c.station_id AS VARCHAR) AS station_id, c.station_name, c.parking_count, c.observed_at AS current_at,
      CAST(trunc(p.parking_count * CAST(0.85 AS DOUBLE)) AS INT) AS predicted_count, 'simple' AS model,
      p.observed_at AS predicted_at,
      CAST(trunc(p.parking_count * CAST(0.85 AS DOUBLE)) AS INT) - c.parking_count AS change
    FROM sides AS c JOIN sides AS p ON p.station_id = c.station_id AND p.event_type <> 'error' AND p.good = 1
    WHERE c.rn = 1"""
)
def station_two_sides(spark, sf_dir):
    """Current states joined with forecasts that were made apart: from each station's last row that is no error."""
    rows = observations(spark, sf_dir, "event_type")
    current = latest.latest_state(rows)
    made = latest.latest_state(rows.where(F.col("event_type") != "error"))
    ahead = scalars.rule_prediction(made).withColumn("model", F.lit(RULE_TAG))
    found = serving.station_change(serving.station_list(current, ahead))
    return found.withColumn("station_id", F.col("station_id").cast("string"))


SEARCHED = ["OCK 12", "k 3", "7", "no such dock"]


@query(
    f"""WITH {LATEST}
    SELECT text, station_id, station_name, parking_count
    FROM latest, (SELECT unnest({SEARCHED}) AS text)
    WHERE contains(lower(station_name), lower(text))"""
)
def station_search(spark, sf_dir):
    """Current stations by parts of their names, through an index of the names."""
    state = current_state(spark, sf_dir).select("station_id", "station_name", "parking_count")
    index = NameIndex.build(state, shared_path(spark, "names"), ["station_id"])
    parts = [index.search(text).select(F.lit(text).alias("text"), "*") for text in SEARCHED]
    return reduce(DataFrame.unionByName, parts)
