"""Boosting with columns drawn per tree and penalised leaves."""

import math

import pytest
from pyspark.sql import functions as F

from dockpulse.operators import boosting, forecast

ROWS = [(0.0, 1.0), (0.0, 3.0), (1.0, 8.0), (1.0, 12.0), (1.0, 10.0)]


def by_hand(rounds, rate, penalty):
    """Two leaves, x = 0 and x = 1, whose residuals are taken off again and again."""
    base = sum(y for _, y in ROWS) / len(ROWS)
    added, errors = {0.0: 0.0, 1.0: 0.0}, []
    for _ in range(rounds):
        for x in added:
            left = [y - base - added[x] for v, y in ROWS if v == x]
            added[x] += rate * sum(left) / (len(left) + penalty)
        squares = [(y - base - added[x]) ** 2 for x, y in ROWS]
        errors.append(math.sqrt(sum(squares) / len(squares)))
    return {x: base + a for x, a in added.items()}, errors


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "x double, target double")


@pytest.mark.parametrize("penalty", [0.0, 1.0])
def test_two_trees_by_hand(table, penalty):
    fit = boosting.fit_boosted(
        table, table, ["x"], rounds=2, depth=1, rate=0.5, rows=1.0, columns=1.0, penalty=penalty
    )
    values, errors = by_hand(2, 0.5, penalty)
    scored = fit.model.transform(table)
    assert scored.columns == ["x", "target", "features", "prediction"]
    assert all(math.isclose(r["prediction"], values[r["x"]]) for r in scored.collect())
    lines = fit.rounds.orderBy("round").collect()
    assert [r["round"] for r in lines] == [1, 2] and all(r["kept"] for r in lines)
    for line, error in zip(lines, errors):
        assert math.isclose(line["train_rmse"], error) and math.isclose(line["test_rmse"], error)


@pytest.fixture(scope="module")
def noisy(spark):
    """Two features that tell and two that do not; every fifth row is tested."""
    noise = [((F.pmod(F.xxhash64("id", F.lit(i)), F.lit(100))) / 100).alias(f"z{i}") for i in range(2)]
    rows = spark.range(600).select(
        "id", (F.col("id") % 7).alias("a"), (F.col("id") % 11).cast("double").alias("b"), *noise
    )
    rows = rows.withColumn("target", 3 * F.col("a") - 2 * F.col("b") + F.col("z0"))
    return rows.where("id % 5 > 0"), rows.where("id % 5 = 0")


@pytest.fixture(scope="module")
def fit(noisy):
    return boosting.fit_boosted(*noisy, ["a", "b", "z0", "z1"], rounds=12, depth=3, rate=0.5, columns=0.5)


def test_errors_are_those_of_the_model(noisy, fit):
    last = fit.rounds.where("kept").orderBy(F.desc("round")).first()
    for name, part in zip(("train_rmse", "test_rmse"), noisy):
        error = forecast.model_metrics(fit.model.transform(part)).first()["rmse"]
        assert math.isclose(error, last[name], rel_tol=1e-9)
    errors = [r["test_rmse"] for r in fit.rounds.orderBy("round").collect()]
    assert last["test_rmse"] == min(errors) and errors[-1] < errors[0] / 2


def test_each_tree_sees_its_own_columns(fit):
    drawn = [tuple(s.getIndices()) for s in fit.model.stages[1:-1:2]]
    assert all(len(d) == 2 for d in drawn) and len(set(drawn)) > 1


def test_importances_make_up_the_whole(fit):
    shares = {r["feature"]: r["importance"] for r in forecast.importances(fit.model).collect()}
    assert math.isclose(sum(shares.values()), 1.0)
    assert min(shares["a"], shares["b"]) > max(shares["z0"], shares["z1"])


def test_saved_model_scores_the_same_and_odd_rows_get_the_rule(spark, noisy, fit, tmp_path):
    forecast.save_model(fit.model, str(tmp_path / "m"))
    rows = noisy[1].withColumn("parking_count", F.lit(20))
    holed = rows.withColumn("z1", F.when(F.col("id") % 2 == 0, F.col("z1")))
    loaded = forecast.load_model(str(tmp_path / "m"))
    scored = forecast.score_with_fallback(loaded, holed)
    assert scored.where("model = 'simple' AND z1 IS NOT NULL OR model <> 'simple' AND z1 IS NULL").isEmpty()
    assert scored.exceptAll(forecast.score_with_fallback(fit.model, holed)).isEmpty()
    assert set(scored.columns) == {*holed.columns, "predicted_count", "model"}


def test_early_stop_keeps_the_best_round(spark):
    train = spark.createDataFrame([(float(i), float(i)) for i in range(40)], "x double, target double")
    test = train.select("x", F.lit(19.5).alias("target"))  # the mean is best, and every tree leads away
    fit = boosting.fit_boosted(train, test, ["x"], rounds=20, depth=2, patience=3)
    assert fit.rounds.count() == 4 and fit.rounds.where("kept").count() == 1
    whole = boosting.fit_boosted(train, test, ["x"], rounds=6, depth=2, patience=None)
    assert whole.rounds.where("kept").count() == 6


def test_rows_that_are_no_numbers_count_nowhere(spark, table):
    odd = [(None, 1.0), (float("nan"), 1.0), (float("inf"), 1.0), (0.0, None), (0.0, float("-inf"))]
    mixed = table.union(spark.createDataFrame(odd, table.schema))
    settings = {"rounds": 2, "depth": 1, "rate": 0.5, "rows": 1.0, "columns": 1.0, "patience": None}
    a = boosting.fit_boosted(mixed, mixed, ["x"], **settings).rounds.orderBy("round").collect()
    b = boosting.fit_boosted(table, table, ["x"], **settings).rounds.orderBy("round").collect()
    assert [r["round"] for r in a] == [1, 2]
    assert all(math.isclose(p["train_rmse"], q["train_rmse"]) for p, q in zip(a, b))
    nothing = table.where("false")
    alone = boosting.fit_boosted(table, nothing, ["x"], **settings).rounds
    assert alone.where("test_rmse IS NOT NULL").isEmpty() and alone.where("kept").count() == 2
    with pytest.raises(ValueError):
        boosting.fit_boosted(nothing, table, ["x"])
