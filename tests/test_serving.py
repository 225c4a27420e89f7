"""Serving questions and scalar functions."""

import json
import random
from datetime import timedelta

import pytest
from conftest import START, rows, series
from pyspark.sql import functions as F

from dockpulse.functions.scalars import change_badges, format_time, key_codec, rule_prediction
from dockpulse.operators import latest
from dockpulse.operators.serving import (
    fleet_stats,
    search_by_name,
    station_change,
    station_detail,
    station_documents,
    station_list,
)


@pytest.fixture(scope="module")
def current(spark):
    data = [("1", "Elm Station", 10), ("2", "솔밭역", 3), ("3", "Oak", 0), ("4", "Yew", 44)]
    return spark.createDataFrame(
        data, "station_id string, station_name string, parking_count int"
    ).withColumn("observed_at", F.lit(START).cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def prediction(spark):
    data = [("1", 8, "simple"), ("2", 5, "xgboost"), ("3", 0, None), ("9", 1, "simple")]
    return spark.createDataFrame(
        data, "station_id string, predicted_count int, model string"
    ).withColumn("observed_at", F.lit(START).cast("timestamp_ntz"))


def test_list_needs_both_sides(current, prediction):
    assert rows(station_list(current, prediction), "station_id") == [("1",), ("2",), ("3",)]


def test_detail(current, prediction):
    row = station_detail(current, prediction, "1").first()
    assert (row["parking_count"], row["predicted_count"], row["change"]) == (10, 8, -2)
    assert station_detail(current, prediction, "4").isEmpty()
    assert station_detail(current, prediction, "none").isEmpty()


def test_documents(current, prediction):
    stations = station_change(station_list(current, prediction)).where("station_id = '2'")
    document = json.loads(station_documents(stations).first()["document"])
    assert document == {
        "station_id": "2",
        "station_name": "솔밭역",
        "current": {"parking_count": 3, "timestamp": "2025-12-26T08:00:00.000000"},
        "prediction": {
            "predicted_count": 5,
            "model": "xgboost",
            "timestamp": "2025-12-26T08:00:00.000000",
            "change": 2,
        },
    }


def test_stats_count_every_current_row(current):
    row = fleet_stats(current).first()
    assert tuple(row) == (4, 57, 14.3, 14.25, 2)


def test_stats_of_nothing(current):
    assert tuple(fleet_stats(current.where("false")).first()) == (0, 0, 0.0, 0.0, 0)


@pytest.mark.parametrize("text,found", [("", 4), ("STATION", 1), ("역", 1), ("o", 2), ("zzz", 0), ("%", 0)])
def test_search(current, text, found):
    assert search_by_name(current, text).count() == found


def test_badges(current, prediction):
    out = change_badges(station_change(station_list(current, prediction)))
    got = rows(out, "station_id", "change_class", "change_symbol", "change_size", "model_label")
    assert got == [
        ("1", "negative", "▼", 2, "📐 규칙 예측"),
        ("2", "positive", "▲", 2, "🤖 ML 예측"),
        ("3", "positive", "▲", 0, "📐 규칙 예측"),
    ]


def test_time_text(current):
    assert format_time(current, "observed_at").first()["time_text"] == "12월 26일 08:00:00"


def test_keys(current):
    row = key_codec(current).orderBy("station_id").first()
    assert (row["state_key"], row["key_id"]) == ("station:1:current", "1")


def test_rule_cuts_toward_zero_and_never_exceeds_the_count(spark):
    df = rule_prediction(spark.range(5000).select(F.col("id").cast("int").alias("parking_count")))
    assert df.where("predicted_count > parking_count").isEmpty()
    got = {r["parking_count"]: r["predicted_count"] for r in df.where("parking_count < 8").collect()}
    assert got == {n: int(n * 0.85) for n in range(8)}


def test_states_at_several_moments_are_those_of_each(spark):
    rng = random.Random(4)
    seen = series(spark, [rng.randrange(9) for _ in range(40)], "a").unionByName(series(spark, [1, 2], "b", 30))
    seen = seen.unionByName(seen.limit(5)).unionByName(series(spark, [7], "c").withColumn("observed_at", F.lit(None).cast("timestamp_ntz")))
    moments = [START + timedelta(seconds=s) for s in (-5, 0, 15, 30, 30, 400, 900, 905, 5000)]
    found = latest.states_at(seen, moments)
    expected = []
    for moment in sorted(set(moments)):
        expected += [(moment, *r) for r in rows(latest.latest_state(seen, as_of=moment), "station_id", "parking_count", "seq")]
    assert rows(found, "as_of", "station_id", "parking_count", "seq") == sorted(expected, key=str)
    assert latest.states_at(seen, []).isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("WindowGroupLimit") == 2
