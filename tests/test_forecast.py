"""Split, fit, score, evaluate and keep a forecast."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from dockpulse.functions.calendar import calendar_features
from dockpulse.operators import forecast
from dockpulse.operators.series import ts_features
from dockpulse.schemas import FEATURE_COLS, LABEL
from dockpulse.session import stage


@pytest.fixture(scope="module")
def training(spark):
    """Ten stations whose counts follow the hour: the last values foretell the next."""
    step, station = F.floor(F.col("id") / 10), F.col("id") % 10
    noise = F.pmod(F.xxhash64("id"), F.lit(3))
    wave = 20 + 15 * F.sin(2 * math.pi * step / 96) + noise
    minutes = "make_dt_interval(0, 0, cast(seq * 15 as int))"
    obs = spark.range(1920).select(
        station.cast("string").alias("station_id"),
        wave.cast("int").alias("parking_count"),
        step.alias("seq"),
    )
    obs = obs.withColumn("observed_at", F.expr(f"timestamp_ntz'2025-12-01 00:00:00' + {minutes}"))
    return stage(calendar_features(ts_features(obs, mode="train"), "observed_at"), "fixture")


@pytest.fixture(scope="module")
def parts(training):
    return forecast.training_split(training, ["station_id", "seq"])


@pytest.fixture(scope="module")
def model(parts):
    return forecast.fit_forecaster(parts[0], maxIter=15)


def test_split_is_whole_stable_and_near_its_share(training, parts):
    train, test = parts
    assert train.count() + test.count() == training.count()
    assert train.join(test, ["station_id", "seq"], "left_semi").isEmpty()
    assert 0.15 < test.count() / training.count() < 0.25
    _, again = forecast.training_split(training.repartition(7), ["station_id", "seq"])
    assert again.exceptAll(test).isEmpty() and again.count() == test.count()


def test_time_split_tests_on_the_latest(training):
    train, test = forecast.training_split(training, ["observed_at"], by="time")
    last = train.agg(F.max("observed_at")).first()[0]
    assert test.agg(F.min("observed_at")).first()[0] > last
    assert 0.15 < test.count() / training.count() < 0.25


def test_random_split_and_unknown_split(training):
    train, test = forecast.training_split(training, ["seq"], by="random")
    assert train.count() + test.count() == training.count()
    with pytest.raises(ValueError):
        forecast.training_split(training, ["seq"], by="other")


def test_defaults_of_the_trees():
    assert forecast.TREES["maxIter"] == 100 and forecast.TREES["maxDepth"] == 5


def test_model_beats_the_rule(model, parts):
    row = forecast.baseline_compare(model.transform(parts[1])).first()
    assert row["model_mae"] < row["simple_mae"]
    assert row["improvement_pct"] > 0


def test_scores_are_whole_counts_with_the_model_tag(model, parts):
    scored = forecast.score_with_fallback(model, parts[1])
    assert dict(scored.dtypes)["predicted_count"] == "int"
    assert scored.where("predicted_count < 0 OR model <> 'xgboost'").isEmpty()
    assert set(scored.columns) == {*parts[1].columns, "predicted_count", "model"}


def test_rows_without_a_feature_get_the_rule(model, parts):
    holed = parts[1].withColumn("hour_sin", F.lit(None).cast("double"))
    scored = forecast.score_with_fallback(model, holed)
    assert scored.count() == parts[1].count()
    assert scored.where("model <> 'simple'").isEmpty()
    assert scored.where(F.col("predicted_count") != (F.col("parking_count") * 0.85).cast("int")).isEmpty()


def test_without_a_model_all_rows_get_the_rule(parts):
    assert forecast.score_with_fallback(None, parts[1]).where("model <> 'simple'").isEmpty()


def test_saved_model_scores_the_same(spark, model, parts, tmp_path):
    forecast.save_model(model, str(tmp_path / "m"))
    forecast.save_model(model, str(tmp_path / "m"))
    loaded = forecast.load_model(str(tmp_path / "m"))
    assert loaded.stages[0].getInputCols() == FEATURE_COLS
    a = forecast.score_with_fallback(model, parts[1])
    assert a.exceptAll(forecast.score_with_fallback(loaded, parts[1])).isEmpty()


def test_importances(model):
    top = forecast.importances(model, 5).collect()
    assert [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)
    assert len(top) == 5
    whole = forecast.importances(model)
    assert {r["feature"] for r in whole.collect()} == set(FEATURE_COLS)
    assert math.isclose(whole.agg(F.sum("importance")).first()[0], 1.0)


def test_error_falls_with_the_rounds(model, parts):
    errors = forecast.error_by_round(model, parts[0], every=5)
    assert [i for i, _ in errors] == [0, 5, 10, 14]
    assert errors[-1][1] < errors[0][1]


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1), (5.0, 2.0, 10)], "target double, prediction double, parking_count int")
    row = forecast.model_metrics(df, LABEL).first()
    assert (row["n"], row["mae"]) == (2, 2.0)
    assert math.isclose(row["rmse"], math.sqrt(5))
    both = forecast.baseline_compare(df).first()
    assert math.isclose(both["simple_mae"], (0.15 + 3.5) / 2)
    assert math.isclose(both["persistence_mae"], 2.5)
    assert math.isclose(both["improvement_pct"], (1.825 - 2) / 1.825 * 100)


def test_not_a_number_gets_the_rule(model, parts):
    odd = parts[1].limit(5).withColumn("hour_sin", F.lit(float("nan")))
    assert {r["model"] for r in forecast.score_with_fallback(model, odd).collect()} == {"simple"}


def test_time_split_leaves_out_rows_that_see_the_tested_part(spark):
    rows = spark.range(100).selectExpr(
        "timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT)) AS observed_at",
        "timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, CAST(id + 2 AS INT)) AS target_at",
    )
    train, test = forecast.training_split(rows, ["observed_at"], by="time", target_at="target_at")
    assert train.count() + test.count() == 98
    assert train.agg(F.max("target_at")).first()[0] < test.agg(F.min("observed_at")).first()[0]


@pytest.mark.parametrize("refined", [1, 10_000])
def test_exact_split_takes_the_share_rounded_up(spark, monkeypatch, refined):
    monkeypatch.setattr(forecast, "REFINED_ROWS", refined)
    for n in (0, 1, 4, 5, 6, 35, 101):
        rows = spark.range(n).select((F.col("id") % 3).alias("station_id"), F.col("id").alias("seq"))
        train, test = forecast.training_split(rows, ["station_id", "seq"], by="exact")
        place = {i: int(hashlib.md5(f"{i % 3}|{i}".encode()).hexdigest()[:15], 16) for i in range(n)}
        first = sorted(range(n), key=lambda i: (place[i], i % 3, i))[: -(-n // 5)]
        assert sorted(r["seq"] for r in test.collect()) == sorted(first)
        assert train.count() == n - len(first)


def test_rows_of_one_place_are_split_by_their_keys(spark):
    rows = spark.range(50).withColumnRenamed("id", "seq")
    mark = forecast.smallest(rows, F.lit(7).cast("long"), 60, ["seq"], 0.1)
    assert sorted(r["seq"] for r in rows.where(mark).collect()) == [0, 1, 2, 3, 4]


def test_trees_read_equal_parts(spark, training, monkeypatch):
    """Also where the rows lie unevenly, with parts of few rows, and without an effect on other reads."""
    monkeypatch.setattr(forecast, "DEALT_ROWS", 100)
    lopsided = training.where("seq < 150").coalesce(1).union(training.where("seq >= 150").repartition(8))
    read, fit = [], forecast.GBTRegressor._fit

    def seen(self, df):
        read.append(sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("part")).count().collect()))
        return fit(self, df)

    monkeypatch.setattr(forecast.GBTRegressor, "_fit", seen)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    rows = lopsided.count()
    for most, parts in ((4_000_000, 4), (rows // 5, 8)):
        monkeypatch.setattr(forecast, "PART_ROWS", most)
        model = forecast.fit_forecaster(lopsided, maxIter=2)
        sizes = read.pop()
        assert sum(sizes) == rows and len(sizes) == parts
        assert sizes[-1] - sizes[0] <= 2 * 9  # each source part deals its last round on its own
        assert forecast.score_with_fallback(model, training).where("model <> 'xgboost'").isEmpty()
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_few_rows_are_fitted_where_they_are(spark, training):
    with forecast.dealt(training) as same:
        assert same is training
