"""Messages, feed documents and snapshot files."""

import json

import pytest
from conftest import rows, series
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockpulse.operators.clean import clean, dedupe_first, merge_snapshots
from dockpulse.operators.latest import latest_state, snapshot_features
from dockpulse.sources.feeds import decode_feed, explode_feed, read_feed
from dockpulse.sources.observations import (
    decode_json,
    encode_json,
    publish,
    read_observations,
    with_event_order,
)
from dockpulse.sources.snapshots import read_snapshots, write_snapshot_csv

MESSAGES = [
    ('{"station_id":"a","parking_count":3,"rack_total":9}', "a", 3, None),
    ('{"station_id":7,"parking_count":3}', "7", 3, None),
    ('{"station_id":"a","parking_count":0,"new":1}', "a", 0, None),
    ('{"station_id":"a","parking_count":"15"}', "a", None, "bad count"),
    ('{"station_id":"a","parking_count":15.0}', "a", None, "bad count"),
    ('{"station_id":"a","parking_count":15.7}', "a", None, "bad count"),
    ('{"station_id":"a","parking_count":9999999999}', "a", None, "bad count"),
    ('{"station_id":"b","parking_count":-1}', "b", -1, "bad count"),
    ('{"parking_count":4}', None, 4, "no station"),
    ("nope", None, None, "unreadable"),
    ('[{"station_id":"a"}]', None, None, "unreadable"),
    ("", None, None, "unreadable"),
    (None, None, None, "unreadable"),
]


@pytest.mark.parametrize("text,station,count,reason", MESSAGES)
def test_message(spark, text, station, count, reason):
    df = spark.createDataFrame([(text,)], "value string")
    row = decode_json(df, quarantine=True).first()
    assert (row["station_id"], row["parking_count"]) == (station, count)
    assert (row["reject_reason"], row["raw"]) == (reason, text)
    assert clean(decode_json(df)).count() == (reason is None)


def test_a_message_is_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "value string")
    plan = clean(decode_json(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_binary_messages_keep_other_columns(spark):
    df = spark.createDataFrame([(bytearray('{"station_id":"역"}'.encode()), 5)], "value binary, seq long")
    row = decode_json(df).first()
    assert (row["station_id"], row["seq"]) == ("역", 5)


def test_encode_keeps_other_scripts(spark):
    df = spark.createDataFrame([("a", "솔밭 역", 3)], "station_id string, station_name string, n int")
    value = encode_json(df).first()["value"]
    assert value == '{"station_id":"a","station_name":"솔밭 역","n":3}'


def test_publish_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([("a", 3), ("b", 4)], "station_id string, parking_count int")
    publish(df, "text", path=str(tmp_path / "out"))
    back = read_observations(spark, "text", streaming=False, path=str(tmp_path / "out"))
    assert rows(decode_json(back), "station_id", "parking_count") == [("a", 3), ("b", 4)]


def test_order_without_a_position_comes_from_the_content(spark):
    df = spark.createDataFrame([("a", "2025-12-26T08:00:00")], "station_id string, timestamp string")
    first, again = with_event_order(df).first(), with_event_order(df).first()
    assert first["seq"] == again["seq"] and first["observed_at"].hour == 8


# --- feed ---


def station(name, count="3", racks="9", sid="ST-1"):
    return {
        "stationId": sid,
        "stationName": name,
        "parkingBikeTotCnt": count,
        "rackTotCnt": racks,
    }


def feed(spark, *documents):
    texts = [(json.dumps(d, ensure_ascii=False),) for d in documents]
    return decode_feed(spark.createDataFrame(texts, "value string"))


def listed(*entries):
    return {"rentBikeStatus": {"row": list(entries)}}


def test_feed_rows_are_renamed_and_typed(spark):
    row = explode_feed(feed(spark, listed(station("Elm")))).first()
    assert (row["station_id"], row["station_name"]) == ("ST-1", "Elm")
    assert (row["parking_count"], row["rack_total"]) == (3, 9)
    assert len(row["timestamp"]) == 26 and row["timestamp"][10] == "T"


@pytest.mark.parametrize("document", [{}, {"rentBikeStatus": {}}, listed(), {"other": 1}])
def test_feed_without_rows(spark, document):
    assert explode_feed(feed(spark, document)).isEmpty()


def test_feed_name_filter(spark):
    df = feed(spark, listed(station("솔밭역 1"), station("Park")))
    assert rows(explode_feed(df, "역"), "station_name") == [("솔밭역 1",)]


@pytest.mark.parametrize("bad", ["x", "15.0", "", None])
def test_feed_bad_count_drops_the_station_or_the_document(spark, bad):
    df = feed(spark, listed(station("A역"), station("B역", bad)), listed(station("C역")))
    assert rows(explode_feed(df), "station_name") == [("A역",), ("C역",)]
    assert rows(explode_feed(df, strict=True), "station_name") == [("C역",)]


def test_feed_strict_ignores_stations_outside_the_filter(spark):
    df = feed(spark, listed(station("A역"), station("B", "x")))
    assert rows(explode_feed(df, "역", strict=True), "station_name") == [("A역",)]


def test_feed_limit_is_per_document(spark):
    entries = [station(f"s{i}") for i in range(5)]
    df = feed(spark, listed(*entries), listed(*entries))
    assert explode_feed(df, limit=2).count() == 4


def test_landed_feed_files(spark, tmp_path):
    (tmp_path / "poll.json").write_text(json.dumps(listed(station("Elm")), indent=2))
    assert explode_feed(read_feed(spark, str(tmp_path))).count() == 1


# --- snapshots ---


def test_snapshot_files_are_merged_by_glob(spark, tmp_path):
    current = latest_state(series(spark, [4, 9], "a").unionByName(series(spark, [7], "b")))
    snapshot = snapshot_features(current)
    for i in range(3):
        write_snapshot_csv(snapshot, str(tmp_path / f"snapshot_{i}.csv"))
    read = read_snapshots(spark, str(tmp_path / "snapshot_*.csv"))
    assert read.count() == 6
    merged = merge_snapshots([read])
    assert [tuple(r) for r in merged.collect()] == [
        ("a", "2025-12-26T08:00:30.000000", 9, 8, 4, 0),
        ("b", "2025-12-26T08:00:00.000000", 7, 8, 4, 0),
    ]
    assert dict(read.dtypes)["parking_count"] == "int"


def test_snapshot_skips_missing_counts(spark):
    assert snapshot_features(latest_state(series(spark, [4, None]))).isEmpty()


# --- de-duplication and latest state ---

PAIRS = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3)), min_size=1, max_size=30)
PROPERTY = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def numbered(spark, pairs):
    data = [(k, v, i) for i, (k, v) in enumerate(pairs)]
    return spark.createDataFrame(data, "k string, v int, seq long").repartition(3)


@PROPERTY
@given(PAIRS)
def test_dedupe_keeps_the_first_and_is_idempotent(spark, pairs):
    once = dedupe_first(numbered(spark, pairs), ["k", "v"], ["seq"])
    expected = {}
    for i, pair in enumerate(pairs):
        expected.setdefault(pair, i)
    assert {(r["k"], r["v"]): r["seq"] for r in once.collect()} == expected
    assert rows(dedupe_first(once, ["k", "v"], ["seq"])) == rows(once)


@PROPERTY
@given(PAIRS)
def test_latest_keeps_the_last(spark, pairs):
    last = latest_state(numbered(spark, pairs), "k", ["v", "seq"])
    expected = {}
    for i, (k, v) in enumerate(pairs):
        expected[k] = max(expected.get(k, (-1, -1)), (v, i))
    assert {r["k"]: (r["v"], r["seq"]) for r in last.collect()} == expected


def test_latest_state_takes_missing_times_last(spark):
    df = series(spark, [1, 2])
    lost = df.withColumn("observed_at", F.when(F.col("seq") == 0, F.col("observed_at")))
    assert latest_state(lost).first()["parking_count"] == 1


def test_merge_does_not_depend_on_the_order_of_files(spark):
    a = spark.createDataFrame([("x", "t1", 1), ("y", "t1", 2)], "station_id string, timestamp string, parking_count int")
    b = spark.createDataFrame([("x", "t1", 1), ("x", "t2", 5)], a.schema)
    assert rows(merge_snapshots([a, b])) == rows(merge_snapshots([b, a]))


@pytest.mark.parametrize("make", [
    lambda d: latest_state(d),
    lambda d: dedupe_first(d, ["station_id", "observed_at"], ["seq"]),
])
def test_groups_are_cut_before_the_shuffle(spark, make):
    plan = make(series(spark, [1, 2, 3]))._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_feed_strict_needs_every_name(spark):
    df = feed(spark, listed(station("A역"), station(None)), listed(station("B역")))
    assert rows(explode_feed(df, "역", strict=True), "station_name") == [("B역",)]


def test_a_document_is_parsed_once(spark):
    df = feed(spark, listed(station("A")))
    plan = explode_feed(df, "A")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
