"""Queries by name, and beside each the same question in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# events as observations of stations, in SQL: as they are, and cleaned
RAW = """raw AS (
  SELECT user_id AS station_id, 'Dock ' || user_id AS station_name,
         TRY_CAST(trunc(value) AS INT) AS parking_count, CAST(props->>'k' AS INT) AS rack_total,
         ts AS observed_at, event_id AS seq, event_type
  FROM events)"""
OBS = f"""{RAW}, obs AS (
  SELECT * FROM raw WHERE station_id IS NOT NULL AND parking_count >= 0)"""

CALENDAR = """CAST(hour(observed_at) AS INT) AS hour,
  CAST(isodow(observed_at) - 1 AS INT) AS day_of_week,
  CAST(isodow(observed_at) >= 6 AS INT) AS is_weekend,
  CAST(hour(observed_at) BETWEEN 7 AND 9 OR hour(observed_at) BETWEEN 17 AND 19 AS INT)
    AS is_rush_hour,
  sin(2 * pi() * hour(observed_at) / 24) AS hour_sin,
  cos(2 * pi() * hour(observed_at) / 24) AS hour_cos,
  sin(2 * pi() * (isodow(observed_at) - 1) / 7) AS dow_sin,
  cos(2 * pi() * (isodow(observed_at) - 1) / 7) AS dow_cos"""

RULE = "CAST(trunc(parking_count * CAST(0.85 AS DOUBLE)) AS INT)"
TEXT_ID = "CAST(station_id AS VARCHAR) AS station_id"
ISO = "strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%f')"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register
