"""Linear classifiers on Spark ML, with term-table features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import LABELS
from .terms import attach, class_sizes

ELASTIC = {"l1": 1.0, "l2": 0.0, "elasticnet": 0.5}


def balanced_weights(train: DataFrame) -> DataFrame:
    """``label, n_docs, weight`` with weight = n / (classes * n_label)."""
    sizes = class_sizes(train)
    total = sizes.agg(F.sum("n_docs").alias("n"), F.count(F.lit(1)).alias("k"))
    return attach(sizes, total).select(
        "label", "n_docs", (F.col("n") / (F.col("k") * F.col("n_docs"))).alias("weight"))


def fit_logistic(train: DataFrame, penalty: str = "l2", balanced: bool = False, c: float = 1.0,
                 features: str = "features", labels: Sequence[str] = LABELS,
                 max_iter: int = 1000, tol: float = 1e-6) -> LogisticRegressionModel:
    """Logistic regression with inverse penalty strength ``c``.

    Spark minimises mean loss + regParam * penalty, so regParam = 1 / (c * n).
    Coefficients are positive for the second label in sorted order.
    """
    if penalty not in ELASTIC:
        raise ValueError(f"unknown penalty: {penalty}")
    second = sorted(labels)[1]
    y = F.when(F.col("label") == second, 1.0).otherwise(0.0)
    rows = train.withColumn("_y", y).select(features, "label", "_y")
    n = rows.count()
    if balanced:
        rows = rows.join(F.broadcast(balanced_weights(train.select("label")).select("label", "weight")), "label")
    lr = LogisticRegression(
        featuresCol=features, labelCol="_y", regParam=1.0 / (c * n), elasticNetParam=ELASTIC[penalty],
        standardization=False, maxIter=max_iter, tol=tol, family="binomial")
    if balanced:
        lr = lr.setWeightCol("weight")
    # input block size bounds the memory of a task; rows stream from the cache
    return lr.fit(rows)


def predict(model: LogisticRegressionModel, df: DataFrame, keep: Sequence[str],
            labels: Sequence[str] = LABELS) -> DataFrame:
    """``prediction, confidence, class_probabilities, score`` (score of the second label)."""
    first, second = sorted(labels)
    scored = model.transform(df).withColumn("_p", vector_to_array("probability"))
    p = F.col("_p")
    return scored.select(
        *keep, F.when(p[1] > p[0], second).otherwise(first).alias("prediction"),
        F.round(F.greatest(p[0], p[1]), 6).alias("confidence"),
        F.create_map(F.lit(first), F.round(p[0], 6), F.lit(second), F.round(p[1], 6)).alias("class_probabilities"),
        p[1].alias("score"))


def coefficients(spark: SparkSession, model: LogisticRegressionModel, names: Sequence[str]) -> DataFrame:
    """``term, coef`` of a fitted model (one row per feature)."""
    return spark.createDataFrame(list(zip(names, model.coefficients.toArray().tolist())), "term string, coef double")


def top_features(coefs: DataFrame, n: int = 20) -> DataFrame:
    return (coefs.withColumn("_abs", F.abs("coef")).orderBy(F.desc("_abs"), "term").limit(n)
            .select(F.col("term").alias("feature"), "coef"))
