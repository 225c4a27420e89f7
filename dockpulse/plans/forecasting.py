"""Training rows, metrics and the boosted-tree forecast over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockpulse.functions.calendar import calendar_features
from dockpulse.functions.scalars import rule_count
from dockpulse.operators import boosting, forecast
from dockpulse.operators.series import ts_features
from dockpulse.plans.registry import CALENDAR, RULE, query
from dockpulse.plans.stations import SERIES_COLS, TRAIN
from dockpulse.schemas import FEATURE_COLS, LABEL, MODEL_TAG
from dockpulse.session import shared_path, stage
from dockpulse.sources.warehouse import observations


def training_rows(spark, sf_dir, target_time=False):
    obs = observations(spark, sf_dir).select("station_id", "seq", "observed_at", "parking_count")
    return calendar_features(ts_features(obs, target_time=target_time), "observed_at")


@query(
    f"""WITH {TRAIN} SELECT seq, parking_count, {CALENDAR}, {SERIES_COLS}, target FROM train"""
)
def training_matrix(spark, sf_dir):
    return training_rows(spark, sf_dir).select("seq", *FEATURE_COLS, LABEL)


@query(
    f"""WITH {TRAIN}, e AS (SELECT CAST(target - {RULE} AS DOUBLE) AS d FROM train)
    SELECT count(*) AS n, sqrt(avg(d * d)) AS rmse, avg(abs(d)) AS mae FROM e"""
)
def model_metrics(spark, sf_dir):
    """Errors of the rule, taken as the model."""
    rows = training_rows(spark, sf_dir).withColumn("prediction", rule_count("parking_count"))
    return forecast.model_metrics(rows)


@query(
    f"""WITH {TRAIN}, e AS (
      SELECT avg(abs(target - parking_count_ma_3)) AS m,
             avg(abs(target - parking_count * CAST(0.85 AS DOUBLE))) AS s,
             avg(abs(target - parking_count)) AS p
      FROM train)
    SELECT round(m, 6) AS model_mae, round(s, 6) AS simple_mae, round(p, 6) AS persistence_mae,
           round((s - m) / s * 100, 6) AS improvement_pct FROM e"""
)
def baseline_compare(spark, sf_dir):
    """The mean of three observations, taken as the model, against the rule."""
    rows = training_rows(spark, sf_dir).withColumn("prediction", F.col("parking_count_ma_3"))
    errors = forecast.baseline_compare(rows)
    return errors.select(*[F.round(c, 6).alias(c) for c in errors.columns])


@query(
    f"""WITH {TRAIN}, span AS (
      SELECT epoch_us(min(observed_at)) AS lo, epoch_us(max(observed_at)) AS hi FROM train)
    SELECT seq, epoch_us(observed_at) >
      CAST(trunc(hi - (hi - lo) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS is_test
    FROM train, span"""
)
def training_split_by_time(spark, sf_dir):
    """Which side of the split each training row is on."""
    rows = stage(training_rows(spark, sf_dir).select("seq", "observed_at"), "training")
    train, test = forecast.training_split(rows, ["observed_at"], by="time")
    return _sides(train, test)


@query()
def training_split_by_key(spark, sf_dir):
    rows = training_rows(spark, sf_dir).select("station_id", "seq")
    train, test = forecast.training_split(stage(rows, "training"), ["station_id", "seq"])
    return _sides(train, test)


def _sides(train, test):
    held = test.select("seq", F.lit(True).alias("is_test"))
    return train.select("seq", F.lit(False).alias("is_test")).unionByName(held)


@query(
    f"""WITH {TRAIN} SELECT seq,
      CAST('0x' || substr(md5(station_id || '|' || seq), 1, 8) AS BIGINT) % 1000000 < 200000
        AS is_test
    FROM train"""
)
def training_split_by_md5(spark, sf_dir):
    rows = training_rows(spark, sf_dir).select("station_id", "seq")
    train, test = forecast.training_split(stage(rows, "training"), ["station_id", "seq"], by="md5")
    return _sides(train, test)


@query(
    f"""WITH {TRAIN}, placed AS (
      SELECT seq, station_id, CAST('0x' || substr(md5(station_id || '|' || seq), 1, 15) AS BIGINT) AS place
      FROM train)
    SELECT seq, row_number() OVER (ORDER BY place, station_id, seq)
      <= (count(*) OVER () + 4) // 5 AS is_test
    FROM placed"""
)
def training_split_exact(spark, sf_dir):
    """One training row in five, rounded up, is tested, to the row."""
    rows = training_rows(spark, sf_dir).select("station_id", "seq")
    train, test = forecast.training_split(stage(rows, "training"), ["station_id", "seq"], by="exact")
    return _sides(train, test)


def fitted(spark, sf_dir):
    """Model of the earlier part of the period, and the scored later part.

    Fitted once for each folder of tables in a session: the saved model and the staged test rows
    serve the queries that come after.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _FITTED:
        rows = training_rows(spark, sf_dir, target_time=True)
        rows = stage(rows.select("seq", "observed_at", "target_at", *FEATURE_COLS, LABEL), "training")
        train, test = forecast.training_split(
            rows, ["observed_at"], by="time", target_at="target_at"
        )
        model, path = forecast.fit_forecaster(train), shared_path(spark, "model")
        forecast.save_model(model, path)
        scored = forecast.score_with_fallback(model, test)
        _FITTED[known] = path, stage(scored, "scored")
    path, scored = _FITTED[known]
    return forecast.load_model(path), scored


_FITTED: dict[tuple[str, str], tuple] = {}


@query()
def gbt_forecast(spark, sf_dir):
    """Scored rows of the last part of the period, of a model fitted on the part before."""
    return fitted(spark, sf_dir)[1].select(
        "seq", "parking_count", LABEL, "predicted_count", "model"
    )


@query()
def top_k_importance(spark, sf_dir):
    return forecast.importances(fitted(spark, sf_dir)[0], 5)


@query(
    f"""WITH {TRAIN}, span AS (
      SELECT epoch_us(min(observed_at)) AS lo, epoch_us(max(observed_at)) AS hi FROM train),
    test AS (
      SELECT target, parking_count FROM train, span WHERE epoch_us(observed_at) >
        CAST(trunc(hi - (hi - lo) * CAST(0.2 AS DOUBLE)) AS BIGINT))
    SELECT count(*) AS n, round(avg(abs(target - {RULE})), 6) AS rule_mae,
      round(avg(abs(target - parking_count)), 6) AS persistence_mae,
      TRUE AS beats_rule, TRUE AS all_by_model, TRUE AS all_valid, TRUE AS saved_model_agrees
    FROM test"""
)
def gbt_evaluation(spark, sf_dir):
    """The fitted model on the last part of the period, beside the rule and "no change".

    It has less error than the rule, forecasts every row with a count of zero or more, and gives
    the same forecasts once saved and loaded.
    """
    model, scored = fitted(spark, sf_dir)
    again = forecast.score_with_fallback(model, scored.drop("predicted_count", "model"))
    both = scored.join(
        again.select("seq", F.col("predicted_count").alias("again")), "seq"
    )
    count, actual = F.col("predicted_count"), F.col(LABEL)
    rule = F.avg(F.abs(actual - rule_count("parking_count")))
    return both.agg(
        F.count("*").alias("n"),
        F.round(rule, 6).alias("rule_mae"),
        F.round(F.avg(F.abs(actual - F.col("parking_count"))), 6).alias("persistence_mae"),
        (F.avg(F.abs(actual - count)) < rule).alias("beats_rule"),
        F.every(F.col("model") == MODEL_TAG).alias("all_by_model"),
        F.every(F.coalesce(count >= 0, F.lit(False))).alias("all_valid"),
        F.every(count == F.col("again")).alias("saved_model_agrees"),
    )


@query(
    f"""WITH {TRAIN} SELECT CAST(15 AS BIGINT) AS n, TRUE AS all_shares, CAST(1 AS DOUBLE) AS total
    FROM train LIMIT 1"""
)
def importance_check(spark, sf_dir):
    """Every feature has a share of the importance, and the shares make up the whole."""
    shares = forecast.importances(fitted(spark, sf_dir)[0])
    return shares.agg(
        F.count_distinct("feature").alias("n"),
        F.every(F.col("importance").between(0, 1)).alias("all_shares"),
        F.round(F.sum("importance"), 6).alias("total"),
    )


def boosted(spark, sf_dir):
    """Trees with columns of their own on the earlier part of the period, the errors by round, and the later part.

    Fitted once for each folder of tables in a session.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _BOOSTED:
        rows = training_rows(spark, sf_dir, target_time=True)
        rows = stage(rows.select("seq", "observed_at", "target_at", *FEATURE_COLS, LABEL), "training")
        train, test = forecast.training_split(rows, ["observed_at"], by="time", target_at="target_at")
        fit = boosting.fit_boosted(train, test, patience=5)
        scored = forecast.score_with_fallback(fit.model, test)
        _BOOSTED[known] = stage(fit.rounds.coalesce(1), "rounds"), stage(scored, "scored")
    return _BOOSTED[known]


_BOOSTED: dict[tuple[str, str], tuple] = {}


@query()
def boosting_rounds(spark, sf_dir):
    """Errors on both parts after every round, and which rounds the model keeps."""
    return boosted(spark, sf_dir)[0]


@query(
    f"""WITH {TRAIN}, span AS (
      SELECT epoch_us(min(observed_at)) AS lo, epoch_us(max(observed_at)) AS hi FROM train),
    test AS (
      SELECT target, parking_count FROM train, span WHERE epoch_us(observed_at) >
        CAST(trunc(hi - (hi - lo) * CAST(0.2 AS DOUBLE)) AS BIGINT))
    SELECT count(*) AS n, round(avg(abs(target - {RULE})), 6) AS rule_mae,
      round(avg(abs(target - parking_count)), 6) AS persistence_mae,
      TRUE AS beats_both, TRUE AS best_round_kept, TRUE AS all_by_model
    FROM test"""
)
def boosting_evaluation(spark, sf_dir):
    """The model has less error than the rule and than "no change", and ends with its best round."""
    rounds, scored = boosted(spark, sf_dir)
    actual, now = F.col(LABEL), F.col("parking_count")
    rule, same = F.avg(F.abs(actual - rule_count("parking_count"))), F.avg(F.abs(actual - now))
    model = F.avg(F.abs(actual - F.col("predicted_count")))
    best = rounds.agg(
        (F.max(F.when(F.col("kept"), F.col("round"))) == F.min_by("round", F.struct("test_rmse", "round"))).alias(
            "best_round_kept"
        )
    )
    errors = scored.agg(
        F.count("*").alias("n"),
        F.round(rule, 6).alias("rule_mae"),
        F.round(same, 6).alias("persistence_mae"),
        ((model < rule) & (model < same)).alias("beats_both"),
        F.every(F.col("model") == MODEL_TAG).alias("all_by_model"),
    )
    return errors.withColumn("best_round_kept", F.lit(best.first()[0]))
