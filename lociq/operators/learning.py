"""Grouped cross-validation, tuning and evaluation of classifiers over region features, with MLlib."""

from __future__ import annotations

import itertools
import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.operators.intervals import row_numbers


MOST_GROUPS = 100_000  # groups whose counts may come to the driver


def grouped_folds(df: DataFrame, group: str, label: str, folds: int = 5, most: int = MOST_GROUPS) -> DataFrame:
    """Add a fold to each row so that a group stays whole and folds have similar numbers of either label. Rows of a null group are left out.

    The largest group goes first, to the fold with the fewest positives, then the fewest rows; for that the counts by group come to the driver. Beyond ``most`` groups they stay where they
    are: groups are ranked by positives and rows and dealt back and forth over the folds.
    """
    counts = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.when(F.col(label) > 0, 1)).alias("pos"), F.count("*").alias("n"))
    order = [F.desc("pos"), F.desc("n"), F.col(group)]
    few = counts.orderBy(*order).limit(most + 1).collect()
    if len(few) > most:
        turn = F.pmod(F.col("_i") - 1, F.lit(2 * folds))
        dealt = row_numbers(counts, order, "_i").select(group, F.when(turn < folds, turn).otherwise(2 * folds - 1 - turn).cast("int").alias("fold"))
        return df.join(dealt, group)
    load = [[0, 0, k] for k in range(folds)]
    rows = []
    for r in few:
        fold = min(load)
        fold[0] += r["pos"]
        fold[1] += r["n"]
        rows.append((r[group], fold[2]))
    kind = df.schema[group].dataType.simpleString()
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, f"`{group}` {kind}, fold int")), group)  # at most ``most`` rows


def donor_split(df: DataFrame, fold: int, train_donors: list, test_donors: list, donor: str = "donor_id") -> tuple[DataFrame, DataFrame]:
    """Training and test rows: other folds of the training donors, this fold of the test donors."""
    if set(train_donors) & set(test_donors):
        raise ValueError("donors for training and test overlap")
    train = df.where((F.col("fold") != fold) & F.col(donor).isin(train_donors))
    test = df.where((F.col("fold") == fold) & F.col(donor).isin(test_donors))
    if train.isEmpty() or test.isEmpty():
        raise ValueError("a split is empty")
    return train, test


def product_split(df: DataFrame, a: str, a_value, b: str, b_value) -> tuple[DataFrame, DataFrame]:
    """Training rows that differ in both keys, test rows that agree in both."""
    return df.where((F.col(a) != a_value) & (F.col(b) != b_value)), df.where((F.col(a) == a_value) & (F.col(b) == b_value))


def candidates(seed: int = 123) -> list[tuple[str, object]]:
    """Estimators and settings to try."""
    common = {"labelCol": "label", "featuresCol": "features"}
    out: list[tuple[str, object]] = [(f"logistic_{a}_{r}", LogisticRegression(regParam=r, elasticNetParam=a, maxIter=50, **common)) for a in (0.0, 1.0) for r in (0.01, 0.1)]
    out += [("forest", RandomForestClassifier(numTrees=20, maxDepth=5, seed=seed, **common))]
    return out + [(f"boosted_{d}", GBTClassifier(maxIter=10, maxDepth=d, seed=seed, **common)) for d in (2, 4)]


def pipeline(features: list[str], estimator) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="raw", handleInvalid="skip"), StandardScaler(inputCol="raw", outputCol="features", withMean=True), estimator])


def fit_of_kinds(df: DataFrame, features: list[str], estimator, label: str = "label") -> PipelineModel:
    """Fit ``pipeline`` on all rows, of which those that agree in features and label go into the estimator as one with their number as its weight.

    The estimator's passes then grow with the number of different rows. Candidate splits of trees come from all rows instead of Spark's sample of 10,000.
    """
    ready = Pipeline(stages=pipeline(features, estimator).getStages()[:-1]).fit(df)
    kinds = ready.transform(df.groupBy(*features, label).agg(F.count("*").cast("double").alias("_weight"))).cache()
    try:
        return PipelineModel([*ready.stages, estimator.copy({estimator.weightCol: "_weight"}).fit(kinds)])
    finally:
        kinds.unpersist()


def average_precision(scored: DataFrame) -> float:
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderPR").evaluate(scored)


def tune(train: DataFrame, valid: DataFrame, features: list[str], tries: list[tuple[str, object]] | None = None):
    """The candidate of the best average precision on ``valid``: name, fitted model, and all scores."""
    best, scores = None, {}
    for name, estimator in tries or candidates():
        model = pipeline(features, estimator).fit(train)
        scores[name] = average_precision(model.transform(valid))
        if best is None or scores[name] > best[0]:
            best = (scores[name], name, model)
    return best[1], best[2], scores


def cross_predict(df: DataFrame, features: list[str], estimator, folds: int) -> DataFrame:
    """Each row's probability by the model of the folds without it."""
    out = None
    for k in range(folds):
        model = pipeline(features, estimator).fit(df.where(F.col("fold") != k))
        part = model.transform(df.where(F.col("fold") == k)).withColumn("test_proba", vector_to_array("probability")[1]).drop("raw", "features", "rawPrediction", "probability", "prediction")
        out = part if out is None else out.unionByName(part)
    return out


def principal_components(df: DataFrame, column: str, k: int):
    """Standardised principal components of a vector column."""
    return Pipeline(stages=[StandardScaler(inputCol=column, outputCol="scaled", withMean=True), PCA(k=k, inputCol="scaled", outputCol="pc")]).fit(df)


def feature_names(columns: list[str], any_of: tuple[str, ...], none_of: tuple[str, ...] = ()) -> list[str]:
    """Columns whose name holds one of ``any_of`` and none of ``none_of``, in their order."""
    return [c for c in columns if any(x in c for x in any_of) and not any(x in c for x in none_of)]


def feature_sets(base: list[str], background: list[str], prefixes: list[str], extra: list[str]) -> dict[str, list[str]]:
    """Three growing sets: the base features, these with background features of each prefix, and those with extra ones."""
    wide = base + [f"{p}_{f}" for p in prefixes for f in background]
    return {"set1": list(base), "set2": wide, "set3": wide + extra}


def settings(space: dict[str, list]) -> list[dict]:
    """All settings of a search space."""
    return [dict(zip(space, values, strict=True)) for values in itertools.product(*space.values())]


def sampled(space: dict[str, list], n: int, seed: int = 123) -> list[dict]:
    """At most ``n`` settings of a search space, drawn without repeats."""
    every = settings(space)
    return random.Random(seed).sample(every, min(n, len(every)))


def attributions(model, df: DataFrame, features: list[str]) -> DataFrame:
    """What each feature adds to a linear model's log odds against the mean row (for a linear model the Shapley value), as columns phi_<feature>, and the mean's log odds as phi_0."""
    linear = model.stages[-1]
    scale = model.stages[1]
    means, spreads = scale.mean.toArray().tolist(), scale.std.toArray().tolist()
    weights = [float(w) for w in linear.coefficients]
    phi = [(F.lit(w / s if s else 0.0) * (F.col(f).cast("double") - m)).alias(f"phi_{f}") for f, w, m, s in zip(features, weights, means, spreads, strict=True)]
    return df.select("*", *phi, F.lit(float(linear.intercept)).alias("phi_0"))
