"""Training, evaluation and use of the boosted-tree forecast, with the rule as fallback."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockpulse.functions.scalars import rule_count
from dockpulse.operators.boosting import TARGET, boosted_importances
from dockpulse.schemas import FEATURE_COLS, LABEL, MODEL_TAG, RULE_FACTOR, RULE_TAG
from dockpulse.session import dropping_stages, shared_dir, stage, using

# Settings of the boosted trees.
TREES = {
    "maxIter": 100,
    "maxDepth": 5,
    "stepSize": 0.1,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": 42,
}
# End of fixed values.


def training_split(
    df: DataFrame,
    keys: Sequence[str],
    test: float = 0.2,
    seed: int = 42,
    by: str = "hash",
    target_at: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows.

    ``hash`` puts a row on the same side in every run and on every cluster size, and so does
    ``md5``, which other systems can compute as well. ``time`` tests on the last part of the
    period, by the last of ``keys``; rows before it whose target, by the time in ``target_at``,
    lies in it are on neither side. ``random`` draws each row. ``exact`` tests on the ``ceil(test * n)``
    rows that come first by md5 and then by ``keys``, which must be unique.
    """
    if by == "random":
        train, held = df.randomSplit([1 - test, test], seed)
        return train, held
    if by == "hash":
        slot = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1_000_000))
        is_test = slot < round(test * 1_000_000)
    elif by == "md5":
        digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
        slot = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 1_000_000
        is_test = slot < round(test * 1_000_000)
    elif by == "exact":
        digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
        place = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
        is_test = smallest(df, place, 60, keys, test)
    elif by == "time":
        micros = F.unix_micros(F.col(keys[-1]).cast("timestamp"))
        first, last = df.agg(F.min(micros), F.max(micros)).first()
        if last is None:
            return df, df
        cut = F.lit(int(last - (last - first) * test))
        is_test = micros > cut
        if target_at is not None:
            held = df.where(is_test)
            ahead = F.unix_micros(F.col(target_at).cast("timestamp"))
            return df.where(~is_test & (ahead <= cut)), held
    else:
        raise ValueError(f"by must be 'hash', 'md5', 'random' or 'time', not {by!r}")
    return df.where(~is_test), df.where(is_test)


REFINE_BITS, REFINED_ROWS = 12, 10_000


def smallest(df: DataFrame, place: Column, bits: int, keys: Sequence[str], share: float) -> Column:
    """Which rows are among the ``ceil(share * n)`` that come first by ``place`` (``bits`` wide) and ``keys``.

    Each round counts the rows of ``2 ** REFINE_BITS`` equal parts of the range that holds the boundary and goes
    on in the part with the boundary, until that has few rows. Only these are sorted.
    """
    rows = df.select(place.alias("place"), *keys)
    low, width, left = 0, bits, None
    while True:
        inside = rows.where((F.col("place") >= low) & (F.col("place") < low + (1 << width)))
        shift = max(0, width - REFINE_BITS)
        part = F.shiftright(F.col("place") - F.lit(low), shift)
        counts = sorted(tuple(r) for r in inside.groupBy(part.alias("part")).count().collect())
        if left is None:
            left = math.ceil(round(share * sum(n for _, n in counts), 9))
        if left == 0:
            return F.lit(False)
        for found, n in counts:  # noqa: B007
            if left <= n:
                break
            left -= n
        low, width = low + (found << shift), shift
        if n <= REFINED_ROWS or width == 0:
            break
    inside = rows.where((F.col("place") >= low) & (F.col("place") < low + (1 << width)))
    order = ["place", *keys]
    last = inside.orderBy(*order).limit(left).agg(F.max(F.struct(*order)).alias("last")).first()["last"]
    edge = F.struct(*[F.lit(last[c]).cast(rows.schema[c].dataType) for c in order])
    return F.struct(place.alias("place"), *[F.col(k) for k in keys]) <= edge


DEALT_ROWS = 200_000  # fewer are fitted where they are
PART_ROWS = 4_000_000


@contextmanager
def dealt(rows: DataFrame) -> Iterator[DataFrame]:
    """The rows in equal parts, as many for each core, of ``PART_ROWS`` at most.

    The trees read them five times each, and each time lasts as long as the core with most rows. Spark cuts files
    into parts by bytes: a part more than there are cores doubles the time. Staged, because rows of a lost part must
    come back in the same order.
    """
    spark, n = rows.sparkSession, rows.count()
    if n < DEALT_ROWS:
        yield rows
        return
    cores = spark.sparkContext.defaultParallelism
    parts = cores * math.ceil(n / (cores * PART_ROWS))
    a_file_each = {f"spark.sql.files.{name}": "1t" for name in ("maxPartitionBytes", "openCostInBytes")}
    with dropping_stages(spark):
        even = stage(rows.repartition(parts), "dealt")
        with using(spark, a_file_each):
            yield even


def fit_forecaster(
    train: DataFrame,
    features: Sequence[str] = FEATURE_COLS,
    label: str = LABEL,
    target: str = "prediction",
    **gbt,
) -> PipelineModel:
    """Boosted trees over ``features`` in the given order, which the model keeps."""
    shared_dir(train.sparkSession)  # the trainer cuts its lineage there
    # Rows with a missing feature are not scored by the model, but must not stop the job.
    assemble = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="keep"
    )
    trees = GBTRegressor(
        featuresCol="features", labelCol=label, predictionCol=target, **{**TREES, **gbt}
    )
    rows = train.dropna(subset=[*features, label]).select(*features, label)
    with dealt(rows) as even:
        return Pipeline(stages=[assemble, trees]).fit(even)


def score_with_fallback(
    model: PipelineModel | None,
    df: DataFrame,
    value: str = "parking_count",
    factor: float = RULE_FACTOR,
) -> DataFrame:
    """Add ``predicted_count`` and ``model``.

    The forecast is cut to an integer of zero or more. Rows with a feature that is missing or
    no number, and all rows when there is no model, get the rule.
    """
    rule = rule_count(value, factor)
    if model is None:
        return df.withColumns({"predicted_count": rule, "model": F.lit(RULE_TAG)})
    assemble, last = model.stages[0], model.stages[-1]
    out = TARGET if isinstance(last, SQLTransformer) else last.getPredictionCol()
    missing = F.lit(False)
    kinds = dict(df.dtypes)
    for name in assemble.getInputCols():
        missing = missing | F.col(name).isNull()
        if kinds.get(name) in ("double", "float"):
            missing = missing | F.isnan(name)
    forecast = F.greatest(F.lit(0), F.col(out).cast("int"))
    return (
        model.transform(df)
        .withColumns(
            {
                "predicted_count": F.when(missing, rule).otherwise(forecast),
                "model": F.when(missing, RULE_TAG).otherwise(MODEL_TAG),
            }
        )
        .drop(out, assemble.getOutputCol())
    )


def model_metrics(
    df: DataFrame, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """One row: number of rows, root mean square error and mean absolute error."""
    error = F.col(label) - F.col(prediction)
    return df.agg(
        F.count(error).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )


def baseline_compare(
    df: DataFrame,
    label: str = LABEL,
    prediction: str = "prediction",
    value: str = "parking_count",
    factor: float = RULE_FACTOR,
) -> DataFrame:
    """One row: the model's error beside the rule's and that of "no change"."""
    actual = F.col(label)
    errors = df.agg(
        F.avg(F.abs(actual - F.col(prediction))).alias("model_mae"),
        F.avg(F.abs(actual - F.col(value) * F.lit(factor))).alias("simple_mae"),
        F.avg(F.abs(actual - F.col(value))).alias("persistence_mae"),
    )
    gain = F.try_divide(F.col("simple_mae") - F.col("model_mae"), F.col("simple_mae")) * 100
    return errors.withColumn("improvement_pct", gain)


def error_by_round(model: PipelineModel, df: DataFrame, every: int = 10) -> list[tuple[int, float]]:
    """Root mean square error after every ``every`` trees, and after the last."""
    assemble, trees = model.stages[0], model.stages[-1]
    rows = assemble.transform(df.dropna(subset=assemble.getInputCols()))
    errors = [e**0.5 for e in trees.evaluateEachIteration(rows, "squared")]
    last = len(errors) - 1
    return [(i, e) for i, e in enumerate(errors) if i % every == 0 or i == last]


def importances(model: PipelineModel, k: int | None = None) -> DataFrame:
    """Features by importance, highest first; a table as long as the feature list."""
    spark = SparkSession.active()
    names = model.stages[0].getInputCols()
    if isinstance(model.stages[-1], SQLTransformer):
        values = boosted_importances(model)
    else:
        values = model.stages[-1].featureImportances.toArray().tolist()
    table = spark.createDataFrame(list(zip(names, values)), "feature string, importance double")
    ranked = table.orderBy(F.desc("importance"), "feature")
    return ranked if k is None else ranked.limit(k)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
