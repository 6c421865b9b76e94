"""Expected goals: shot features, a logistic model, its prediction as a column."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geometry import shot_angle, shot_distance
from ..sources.files import read_shots

FEATURES = ("distance_m", "angle_rad", "inverse_distance")
LEAST_SHOTS, WANTED_SHOTS = 100, 250


def shot_features(shots: DataFrame) -> DataFrame:
    """shots (start_x, start_y) with distance to the goal, its angle, and 1 / distance (of
    1 metre or more)."""
    d = shot_distance()
    return shots.withColumns({"distance_m": d, "angle_rad": shot_angle(), "inverse_distance": 1 / F.greatest(d, F.lit(1.0))})


def fit(shots: DataFrame, target: str = "is_goal", n_shots: int | None = None) -> LogisticRegressionModel:
    """A logistic regression on the features, with an L2 penalty of weight 1 on the sum of
    losses. Shots with an unknown place or outcome are left out."""
    known = shot_features(shots).where(F.col("distance_m").isNotNull() & F.col(target).isNotNull())
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(known.withColumn("label", F.col(target).cast("double")))
    n = n_shots or known.count()
    return LogisticRegression(maxIter=1000, tol=1e-10, regParam=1 / max(1, n), elasticNetParam=0.0, standardization=False).fit(rows)


def coefficients(model: LogisticRegressionModel) -> tuple[float, ...]:
    """Intercept, then a weight for each feature."""
    return (float(model.intercept), *(float(w) for w in model.coefficients))


def score(weights: Sequence[float]) -> Column:
    """The probability of a goal by weights as from coefficients(), as a column expression."""
    total = F.lit(float(weights[0]))
    for name, w in zip(FEATURES, weights[1:], strict=True):
        total = total + F.lit(float(w)) * F.col(name)
    return 1 / (1 + F.exp(-total))


def predict(shots: DataFrame, weights: Sequence[float]) -> DataFrame:
    return shot_features(shots).withColumn("xg", score(weights))


def offset_intercept(shots: DataFrame, weights: Sequence[float], target: str = "is_goal", rounds: int = 50) -> tuple[float, ...]:
    """weights with an intercept under which shots score as often as they do, the shape
    unchanged. Each round is one aggregation."""
    base, intercept = shot_features(shots).where(F.col("distance_m").isNotNull() & F.col(target).isNotNull()), float(weights[0])
    for _ in range(rounds):
        p = score((intercept, *weights[1:]))
        row = base.agg(F.sum(F.col(target) - p).alias("miss"), F.sum(p * (1 - p)).alias("curve")).first()
        if not row.curve:
            break
        step = row.miss / row.curve
        intercept += max(-2.0, min(2.0, step))
        if math.fabs(step) < 1e-9:
            break
    return (intercept, *map(float, weights[1:]))


def fit_local(spark: SparkSession, shots_path: str, model_path: str, base: Sequence[float] | None = None, mode: str = "refit") -> tuple[float, ...]:
    """Recalibrate on local shots and save the model: a full refit, or with mode `offset`
    the base's shape with a new intercept. Fewer than LEAST_SHOTS shots are an error."""
    shots = read_shots(spark, shots_path)
    n = shots.count()
    if n < LEAST_SHOTS:
        raise ValueError(f"only {n} local shots: {LEAST_SHOTS} are needed, about {WANTED_SHOTS} for a stable recalibration")
    if mode == "offset":
        if base is None:
            raise ValueError("an offset needs a base model's weights")
        weights = offset_intercept(shots, base)
        rows = [("intercept", weights[0]), *zip(FEATURES, weights[1:], strict=True)]
        spark.createDataFrame(rows, "name string, weight double").coalesce(1).write.mode("overwrite").parquet(model_path)
        return weights
    model = fit(shots, n_shots=n)
    model.write().overwrite().save(model_path)
    return coefficients(model)
