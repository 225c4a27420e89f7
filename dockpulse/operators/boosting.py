"""Boosting over Spark's trees: columns drawn per tree, penalised leaves, errors while fitting, early stop."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockpulse.schemas import FEATURE_COLS, LABEL
from dockpulse.session import dropping_stages, stage

CUT_EVERY = 5  # rounds between two written tables: plans stay short, and a lost task repeats few trees
TARGET = "prediction"


class Boosted(NamedTuple):
    """``model`` is a plain pipeline, saved and loaded like any other; ``rounds`` has a row per round."""

    model: PipelineModel
    rounds: DataFrame


def fit_boosted(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str] = FEATURE_COLS,
    label: str = LABEL,
    rounds: int = 100,
    depth: int = 5,
    rate: float = 0.1,
    rows: float = 0.8,
    columns: float = 0.8,
    penalty: float = 1.0,
    patience: int | None = 10,
    seed: int = 42,
) -> Boosted:
    """Boosted trees for squared error, with the errors of both parts after every round.

    Each round draws a share ``rows`` of the training rows and a share ``columns`` of the features (rounded
    down, at least one), and grows a tree on what is left to explain. A leaf adds
    ``rate * sum of residuals / (drawn rows + penalty)``. ``rounds`` has round (from 1), trees, the errors
    train_rmse and test_rmse, and whether the tree is kept: with ``patience`` the fit ends after so many rounds without
    a smaller test error, and the trees after the best round are left out. Rows with a missing or infinite feature or
    label count nowhere; without a training row a ValueError is raised, and without a test row there is no early stop.

    A round reads the data for its tree and once more: the sums of a leaf give its weight and both errors.
    """
    spark, draw = train.sparkSession, random.Random(seed)
    assemble = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    with dropping_stages(spark):
        both = _usable(train, features, label, True).unionByName(_usable(test, features, label, False))
        numbered = both.withColumn("row", F.monotonically_increasing_id())
        data = stage(assemble.transform(numbered).select("features", "label", "is_train", "row"), "boosting")
        count, base = data.where("is_train").agg(F.count("*"), F.avg("label")).first()
        if not count:
            raise ValueError("no training row has every feature and a label")
        data = data.withColumn("left", F.col("label") - F.lit(base))
        stages, weights, history, best = [], [], [], (math.inf, 0)
        for k in range(rounds):
            chosen = sorted(draw.sample(range(len(features)), max(1, int(columns * len(features)))))
            slicer = VectorSlicer(inputCol="features", outputCol=f"drawn_{k}", indices=chosen)
            lot = F.pmod(F.xxhash64("row", F.lit(seed + k)), F.lit(1_000_000))
            data = data.withColumn("drawn", F.col("is_train") & (lot < round(rows * 1_000_000)))
            data = slicer.transform(data)
            grower = DecisionTreeRegressor(
                featuresCol=f"drawn_{k}", labelCol="left", predictionCol=f"mean_{k}",
                leafCol=f"leaf_{k}", maxDepth=depth, seed=seed + k,
            )
            tree = grower.fit(data.where("drawn"))
            data = tree.transform(data).drop(f"drawn_{k}", f"mean_{k}")
            found = leaf_sums(data, f"leaf_{k}").collect()  # at most two rows a leaf
            weight = leaf_weights(found, tree.numNodes // 2 + 1, rate, penalty)
            stages += [slicer, tree]
            weights.append(weight)
            errors = [_rmse(found, weight, part) for part in (True, False)]
            history.append((k + 1, *errors))
            if errors[1] is None or errors[1] < best[0]:
                best = (math.inf if errors[1] is None else errors[1], k + 1)
            if patience is not None and k + 1 - best[1] >= patience:
                break
            data = data.withColumn("left", F.col("left") - chosen_weight(weight, f"leaf_{k}"))
            data = data.drop(f"leaf_{k}", "drawn")
            if (k + 1) % CUT_EVERY == 0:
                data = stage(data, "boosting")
    last = best[1] if patience is not None else len(history)
    model = PipelineModel([assemble, *stages[: 2 * last], _add_up(base, weights[:last])])
    lines = [(k, *errors, k <= last) for k, *errors in history]
    layout = "round int, train_rmse double, test_rmse double, kept boolean"
    return Boosted(model, spark.createDataFrame(lines, layout))


def _usable(df: DataFrame, features: Sequence[str], label: str, is_train: bool) -> DataFrame:
    """Features and label as finite doubles, and the part a row belongs to."""
    numbers = [F.col(c).cast("double").alias(c) for c in features]
    rows = df.select(*numbers, F.col(label).cast("double").alias("label"), F.lit(is_train).alias("is_train"))
    for name in (*features, "label"):
        rows = rows.where(F.abs(F.col(name)) < math.inf)  # false for null, infinite and, as the largest, NaN
    return rows


def leaf_sums(data: DataFrame, leaf: str) -> DataFrame:
    """Per leaf and part: rows, residuals and their squares over all rows, and the first two over drawn rows."""
    left, drawn = F.col("left"), F.col("drawn")
    return data.groupBy(F.col(leaf).cast("int").alias("leaf"), "is_train").agg(
        F.count("*").alias("n"),
        F.sum("left").alias("sum"),
        F.sum(left * left).alias("squares"),
        F.count_if(drawn).alias("drawn_n"),
        F.sum(F.when(drawn, left).otherwise(0.0)).alias("drawn_sum"),
    )


def leaf_weights(found: list, leaves: int, rate: float, penalty: float) -> list[float]:
    weights = [0.0] * leaves
    for row in found:
        if row["is_train"] and row["drawn_n"]:
            weights[row["leaf"]] = rate * row["drawn_sum"] / (row["drawn_n"] + penalty)
    return weights


def _rmse(found: list, weights: list[float], is_train: bool) -> float | None:
    """Error of a part once each leaf's weight is taken off its residuals, from the leaf's sums."""
    part = [r for r in found if r["is_train"] == is_train]
    n = sum(r["n"] for r in part)
    if not n:
        return None
    after = [
        r["squares"] - 2 * weights[r["leaf"]] * r["sum"] + r["n"] * weights[r["leaf"]] ** 2 for r in part
    ]
    return math.sqrt(max(0.0, math.fsum(after)) / n)


def chosen_weight(weights: list[float], leaf: str) -> Column:
    return F.array(*map(F.lit, weights))[F.col(leaf).cast("int")]


def _add_up(base: float, weights: list[list[float]]) -> SQLTransformer:
    """The last stage of the model: the sum of the leaves' weights, as the one column that is added."""
    chosen = [
        f"array({', '.join(f'{w!r}D' for w in tree)})[CAST(leaf_{k} AS INT)]" for k, tree in enumerate(weights)
    ]
    made = [name for k in range(len(weights)) for name in (f"drawn_{k}", f"mean_{k}", f"leaf_{k}")]
    kept = f"* EXCEPT ({', '.join(made)})" if made else "*"
    total = " + ".join([f"{base!r}D", *chosen])
    return SQLTransformer(statement=f"SELECT {kept}, {total} AS {TARGET} FROM __THIS__")


def boosted_importances(model: PipelineModel) -> list[float]:
    """Share of each input column in the gain, averaged over the trees that split."""
    shares = [0.0] * len(model.stages[0].getInputCols())
    pairs = list(zip(model.stages[1:-1:2], model.stages[2:-1:2]))
    for slicer, tree in pairs:
        for column, share in zip(slicer.getIndices(), tree.featureImportances.toArray().tolist()):
            shares[column] += share
    whole = math.fsum(shares)
    return [s / whole for s in shares] if whole else shares
