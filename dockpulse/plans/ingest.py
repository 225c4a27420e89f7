"""Messages, feed documents and snapshot files made from events, and read back."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from dockpulse.operators import clean, latest
from dockpulse.plans.registry import ISO, OBS, TEXT_ID, query
from dockpulse.schemas import SUBWAY_MARKER
from dockpulse.session import shared_path
from dockpulse.sources import feeds, snapshots
from dockpulse.sources import observations as messages
from dockpulse.sources.warehouse import as_messages, observations

WIRE = ["station_id", "station_name", "parking_count", "rack_total", "timestamp"]
OTHERS = [c for c in WIRE if c != "parking_count"]


def mixed_messages(spark, sf_dir):
    """Good and bad messages: the type of an event decides what is wrong with its message."""
    count = F.col("parking_count")

    def with_count(value):
        return F.to_json(F.struct(*OTHERS, value.alias("parking_count")))

    kind = F.col("event_type")
    value = (
        F.when(kind == "error", F.lit("no json"))
        .when(kind == "signup", with_count(count.cast("string")))
        .when(kind == "view", with_count(-count - 1))
        .when(kind == "purchase", F.to_json(F.struct(*WIRE, F.lit("x").alias("unknown_key"))))
        .otherwise(messages.json_text(WIRE))
    )
    return as_messages(observations(spark, sf_dir, "event_type")).select(
        "seq", value.alias("value")
    )


@query(
    f"""WITH {OBS} SELECT seq, {TEXT_ID}, station_name, parking_count, rack_total,
      {ISO} AS timestamp
    FROM obs WHERE event_type IN ('click', 'purchase') AND parking_count >= 0"""
)
def json_decode_clean(spark, sf_dir):
    return clean.clean(messages.decode_json(mixed_messages(spark, sf_dir)))


@query(
    f"""WITH {OBS} SELECT seq,
      CASE WHEN event_type = 'error' THEN 'unreadable'
           WHEN event_type IN ('signup', 'view') OR parking_count < 0 THEN 'bad count'
      END AS reject_reason
    FROM obs"""
)
def json_quarantine(spark, sf_dir):
    return messages.decode_json(mixed_messages(spark, sf_dir), quarantine=True).select(
        "seq", "reject_reason"
    )


@query(
    f"""WITH {OBS} SELECT seq, {TEXT_ID}, station_name, parking_count, rack_total,
      {ISO} AS timestamp,
      '{{"station_id":"' || station_id || '","station_name":"' || station_name
      || '","parking_count":' || parking_count || ',"rack_total":' || rack_total
      || ',"timestamp":"' || {ISO} || '"}}' AS raw
    FROM obs"""
)
def json_roundtrip(spark, sf_dir):
    """Rows as JSON bytes, and decoded again beside their text."""
    sent = as_messages(observations(spark, sf_dir)).select(
        "seq", messages.json_text(WIRE).cast("binary").alias("value")
    )
    return messages.decode_json(sent, quarantine=True).drop("reject_reason")


@query(
    f"""WITH {OBS} SELECT seq, {TEXT_ID}, station_name || '역' AS station_name,
      parking_count, rack_total
    FROM obs WHERE event_type <> 'error'"""
)
def explode_feed(spark, sf_dir):
    """A feed document per event: a stop, one off the line, one with a bad count.

    The document of an error event lacks the list.
    """

    def entry(name, count):
        return F.struct(
            F.col("station_id").cast("string").alias("stationId"),
            name.alias("stationName"),
            count.alias("parkingBikeTotCnt"),
            F.col("rack_total").cast("string").alias("rackTotCnt"),
        )

    name, count = F.col("station_name"), F.col("parking_count").cast("string")
    stop = F.concat(name, F.lit(SUBWAY_MARKER))
    rows = F.array(entry(stop, count), entry(name, count), entry(stop, F.lit("n/a")))
    inner = F.when(F.col("event_type") != "error", F.struct(rows.alias("row")))
    documents = observations(spark, sf_dir, "event_type").select(
        "seq", F.to_json(F.struct(inner.alias("rentBikeStatus"))).alias("value")
    )
    stations = feeds.explode_feed(feeds.decode_feed(documents), name_contains=SUBWAY_MARKER)
    return stations.drop("timestamp")


AS_OF = datetime(2024, 1, 16)
MOMENTS = [datetime(2024, 1, 1) + timedelta(hours=60 * i + 12) for i in range(12)]


def _snapshot_sql(where: str) -> str:
    return f"""SELECT {TEXT_ID}, {ISO} AS timestamp, parking_count,
      CAST(hour(observed_at) AS INT) AS hour,
      CAST(isodow(observed_at) - 1 AS INT) AS day_of_week,
      CAST(isodow(observed_at) >= 6 AS INT) AS is_weekend
    FROM (SELECT *, row_number() OVER (PARTITION BY station_id
      ORDER BY observed_at DESC, seq DESC) AS rn FROM obs WHERE {where}) WHERE rn = 1"""


@query(
    f"""WITH {OBS} {_snapshot_sql(f"observed_at <= TIMESTAMP '{AS_OF}'")}
    UNION {_snapshot_sql("true")}"""
)
def snapshot_csv_merge(spark, sf_dir):
    """Snapshots of two moments as CSV files, read by a glob and merged."""
    obs = observations(spark, sf_dir)
    folder = shared_path(spark, "snapshots")
    for i, moment in enumerate((AS_OF, None)):
        snapshot = latest.snapshot_features(latest.latest_state(obs, as_of=moment))
        snapshots.write_snapshot_csv(snapshot, f"{folder}/snapshot_{i}.csv")
    return clean.merge_snapshots([snapshots.read_snapshots(spark, f"{folder}/snapshot_*.csv")])


_MOMENTS_SQL = ", ".join(f"(TIMESTAMP '{m}')" for m in MOMENTS)


@query(
    f"""WITH {OBS}, moments(as_of) AS (VALUES {_MOMENTS_SQL}), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY as_of, station_id
        ORDER BY observed_at DESC, seq DESC) AS rn FROM obs JOIN moments ON observed_at <= as_of)
    SELECT as_of, {TEXT_ID}, {ISO} AS timestamp, parking_count,
      CAST(hour(observed_at) AS INT) AS hour,
      CAST(isodow(observed_at) - 1 AS INT) AS day_of_week,
      CAST(isodow(observed_at) >= 6 AS INT) AS is_weekend
    FROM ranked WHERE rn = 1"""
)
def snapshot_sweep(spark, sf_dir):
    """The snapshots of twelve moments from one pass over the events."""
    states = latest.states_at(observations(spark, sf_dir), MOMENTS)
    wide = latest.snapshot_features(states, keep=["as_of"])
    return wide.withColumn("station_id", F.col("station_id").cast("string"))
