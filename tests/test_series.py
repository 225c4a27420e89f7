"""Series features against hand-made values and the plain window."""

import math
from datetime import timedelta

import pytest
from conftest import START, rows, series
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dockpulse.functions.calendar import calendar_features
from dockpulse.operators import ordered
from dockpulse.operators.series import history_register, ts_features
from dockpulse.schemas import FEATURE_COLS, LABEL
from dockpulse.session import stage

LAGS = [f"parking_count_lag_{k}" for k in (1, 2, 3)]
SERIES = [*LAGS, "parking_count_ma_3", "parking_count_ma_6", "parking_count_diff_1"]


def close(left, right):
    return len(left) == len(right) and all(
        (a is None and b is None) or (a == b) or math.isclose(a, b, abs_tol=1e-9)
        for x, y in zip(left, right)
        for a, b in zip(x, y)
    )


def random_walks(spark, sizes):
    frames = []
    for i, size in enumerate(sizes):
        values = [(7 * i + 13 * j * j + j) % 31 for j in range(size)]
        frames.append(series(spark, values, f"s{i}"))
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    return whole


def test_train_features_by_hand(spark):
    df = series(spark, [4, 10, 1, 7, 7, 0], "a").unionByName(series(spark, [9, 9, 9, 9, 9], "b"))
    cols = ["station_id", "seq", *SERIES, "parking_count_diff_2", LABEL, "target_at"]
    made = ts_features(df, mode="train", target_time=True).select(cols)
    later = START + timedelta(seconds=150)
    assert close(rows(made), [("a", 3, 1, 10, 4, 6.0, 5.5, 6, -3, 0, later)])


def test_train_means_use_present_rows(spark):
    df = series(spark, [5, 7, None, 9, 1, 1, 1])
    wide = ts_features(df, mode="serve")  # all rows are kept
    assert wide.count() == 7
    from dockpulse.operators.series import previous_counts, train_columns

    order = ("observed_at", "seq")
    made = train_columns(previous_counts(df, "station_id", order, "parking_count", 5), "parking_count")
    got = [tuple(r) for r in made.orderBy("seq").select("parking_count_ma_3", LAGS[0]).collect()]
    assert got[:4] == [(5.0, None), (6.0, 5), (6.0, 7), (8.0, None)]


def test_serve_features_fill_with_zero(spark):
    last = ts_features(series(spark, [10, 7, 3]), mode="serve").orderBy("seq").collect()[-1]
    assert [last[c] for c in SERIES] == [7, 10, 0, 20 / 3, 20 / 6, -4]


def test_modes_agree_where_there_are_five_predecessors(spark):
    df = random_walks(spark, [20, 9])
    train = ts_features(df, mode="train").select("station_id", "seq", *SERIES)
    late = train.where("seq >= 5")
    serve = ts_features(df, mode="serve").select("station_id", "seq", *SERIES)
    assert late.count() > 0
    assert late.exceptAll(serve.select(*[F.col(c) for c in train.columns])).isEmpty()


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        ts_features(series(spark, [1]), mode="other")


def test_history_is_newest_first_and_six_long(spark):
    out = history_register(series(spark, list(range(1, 9)))).orderBy("seq").collect()
    assert out[0]["history"] == [1]
    assert out[-1]["history"] == [8, 7, 6, 5, 4, 3]


# --- hot keys ---


def split_equals_plain(spark, df, make):
    spark.conf.set("spark.dockpulse.hotKeyRows", "1000000")
    plain = rows(make(df), *sorted(make(df).columns))
    spark.conf.set("spark.dockpulse.hotKeyRows", "5")
    out = make(df)
    return plain == rows(out, *sorted(out.columns))


MAKERS = [
    lambda d: ts_features(d, mode="train"),
    lambda d: ts_features(d, mode="serve"),
    history_register,
]


@pytest.mark.parametrize("make", MAKERS)
def test_split_keys_give_the_plain_result(spark, small_pieces, make):
    df = random_walks(spark, [60, 3, 5, 6, 25, 1])
    assert split_equals_plain(spark, df, make)


def test_split_keys_with_equal_times(spark, small_pieces):
    """One moment may hold most of a key: the rest of the order cuts it."""
    df = random_walks(spark, [40, 4]).withColumn("observed_at", F.lit(START).cast("timestamp_ntz"))
    assert split_equals_plain(spark, df, MAKERS[0])


def test_split_missing_key_is_a_key(spark, small_pieces):
    df = random_walks(spark, [30, 4]).withColumn(
        "station_id", F.when(F.col("station_id") != "s0", F.col("station_id"))
    )
    assert split_equals_plain(spark, df, MAKERS[1])


def test_pieces_of_one_row_reach_far_neighbours(spark, small_pieces):
    spark.conf.set("spark.dockpulse.pieceRows", "1")
    assert split_equals_plain(spark, random_walks(spark, [23, 2]), MAKERS[0])


def test_many_hot_keys(spark, small_pieces):
    sizes = [6 + i % 5 for i in range(40)] + [1, 2, 3]
    assert split_equals_plain(spark, random_walks(spark, sizes), MAKERS[0])


def test_pieces_grow_where_there_would_be_too_many(spark, small_pieces, monkeypatch):
    monkeypatch.setattr(ordered, "MOST_PIECES", 2)
    assert split_equals_plain(spark, random_walks(spark, [30, 25, 2]), MAKERS[0])


def test_a_hot_key_is_spread_over_pieces(spark, small_pieces):
    """No piece of the layout holds much more than its share of the rows."""
    seen = []

    def keep(df, name):
        laid = stage(df, name)
        if name == "pieces":
            seen.append(laid)
        return laid

    patched = pytest.MonkeyPatch()
    patched.setattr(ordered, "stage", keep)
    try:
        ts_features(random_walks(spark, [200]), mode="serve").collect()
    finally:
        patched.undo()
    sizes = [r["count"] for r in seen[0].groupBy("_piece").count().collect()]
    assert sum(sizes) == 200 and len(sizes) > 20 and max(sizes) < 20


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.integers(0, 18), min_size=1, max_size=4), st.integers(1, 6))
def test_split_property(spark, small_pieces, sizes, piece):
    spark.conf.set("spark.dockpulse.pieceRows", str(piece))
    df = random_walks(spark, [s + 1 for s in sizes])
    assert split_equals_plain(spark, df, MAKERS[0])


# --- plans ---


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_need_one_exchange_one_sort_one_window(spark):
    df = stage(random_walks(spark, [5, 6]))
    out = calendar_features(ts_features(df, mode="train"), "observed_at")
    text = plan(out.select(*FEATURE_COLS, LABEL))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("+- Sort [") == 1
    assert text.count("Window [") == 1


def test_scan_reads_only_the_columns_that_are_used(spark):
    df = stage(random_walks(spark, [5]).withColumn("station_name", F.lit("x")))
    out = ts_features(df, mode="train").select("seq", LABEL)
    assert "station_name" not in plan(out).split("ReadSchema")[1]


# --- calendar ---


def test_calendar_of_a_friday_morning(spark):
    row = calendar_features(series(spark, [1]), "observed_at").first()
    assert (row["hour"], row["day_of_week"], row["is_weekend"], row["is_rush_hour"]) == (8, 4, 0, 1)
    assert math.isclose(row["hour_sin"], math.sin(2 * math.pi * 8 / 24))


def test_calendar_circle_rush_hours_and_weekend(spark):
    hours = spark.range(24 * 7).select(
        F.expr("timestamp_ntz'2024-01-01 00:30:00' + make_dt_interval(0, cast(id as int))").alias("t")
    )
    out = calendar_features(hours, "t")
    off = F.abs(F.pow("hour_sin", F.lit(2)) + F.pow("hour_cos", F.lit(2)) - 1)
    assert out.where(off > 1e-12).isEmpty()
    rush = {r["hour"] for r in out.where("is_rush_hour = 1").collect()}
    assert rush == {7, 8, 9, 17, 18, 19}
    assert {r["day_of_week"] for r in out.where("is_weekend = 1").collect()} == {5, 6}


def test_calendar_in_another_zone(spark):
    row = calendar_features(series(spark, [1]), "observed_at", "Asia/Tokyo").first()
    assert row["hour"] == 17


def test_calendar_of_text_times(spark):
    df = spark.createDataFrame(
        [("2025-12-26T08:10:07.480080",), ("2025-12-26T08:10:07+09:00",), ("junk",), (None,)],
        "t string",
    )
    assert [r["hour"] for r in calendar_features(df, "t").collect()] == [8, 8, None, None]
