"""Multinomial Naive Bayes over a long ``(doc_id, label, term, weight)`` table.

A fitted model is one row per vocabulary term holding the log-probability of
the term under each class, so its size is bounded by the vocabulary limit and
it can be broadcast.  Scoring is a join on the term and a sum per document;
several smoothing values are scored in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import LABELS
from .terms import attach, top_per_group

EPS = 1e-12


def fit(train: DataFrame, vocab: DataFrame, alphas: Sequence[float] = (1.0,),
        labels: Sequence[str] = LABELS, value: str = "weight") -> DataFrame:
    """``term`` and ``lp_<i>_<label>``: log P(term | class) under ``alphas[i]``.

    Terms that a class never uses still get their smoothed probability.
    """
    labels = sorted(labels)
    sums = train.groupBy("term").agg(*[
        F.sum(F.when(F.col("label") == c, F.col(value)).otherwise(0.0)).alias(f"s_{c}") for c in labels])
    grid = vocab.select("term").join(sums, "term", "left").fillna(0.0)
    totals = grid.groupBy().agg(
        F.count(F.lit(1)).alias("v"), *[F.sum(f"s_{c}").alias(f"t_{c}") for c in labels])
    return attach(grid, totals).select("term", *[
        F.log((F.col(f"s_{c}") + a) / (F.col(f"t_{c}") + a * F.col("v")) + EPS).alias(f"lp_{i}_{c}")
        for i, a in enumerate(alphas) for c in labels])


def log_priors(train_docs: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """One row with ``prior_<label>`` = ln P(class)."""
    return train_docs.agg(*[
        F.log(F.avg((F.col("label") == c).cast("double")) + EPS).alias(f"prior_{c}") for c in labels])


def score(docs: DataFrame, rows: DataFrame, model: DataFrame, train_docs: DataFrame,
          alphas: Sequence[float] = (1.0,), labels: Sequence[str] = LABELS,
          value: str = "weight", keep: Sequence[str] = ()) -> DataFrame:
    """One row per document and alpha: ``scores`` (per class), ``prediction``.

    ``docs`` lists the documents to score; those without a known term fall
    back to the prior.  Ties go to the first class.
    """
    labels = sorted(labels)
    sums = rows.join(F.broadcast(model), "term").groupBy("doc_id").agg(*[
        F.sum(F.col(value) * F.col(f"lp_{i}_{c}")).alias(f"l_{i}_{c}")
        for i in range(len(alphas)) for c in labels])
    joined = attach(docs.select("doc_id", *keep).join(sums, "doc_id", "left"), log_priors(train_docs, labels))

    def one(i: int, a: float) -> Column:
        return F.struct(F.lit(float(a)).alias("alpha"), *[
            (F.col(f"prior_{c}") + F.coalesce(F.col(f"l_{i}_{c}"), F.lit(0.0))).alias(f"score_{c}")
            for c in labels])

    out = joined.select("doc_id", *keep, F.explode(F.array(*[
        one(i, a) for i, a in enumerate(alphas)])).alias("r")).select("doc_id", *keep, "r.*")
    return out.withColumn("prediction", arg_max(labels))


def arg_max(labels: Sequence[str], prefix: str = "score_") -> Column:
    """The label with the highest rounded score; the first one on ties."""
    labels = sorted(labels)
    best = F.greatest(*[F.round(F.col(f"{prefix}{c}"), 6) for c in labels])
    return reduce(lambda acc, c: acc.when(F.round(F.col(f"{prefix}{c}"), 6) == best, F.lit(c)),
                  labels[1:], F.when(F.round(F.col(f"{prefix}{labels[0]}"), 6) == best, F.lit(labels[0])))


def probabilities(scored: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Adds ``p_<label>``: the softmax of the log scores."""
    labels = sorted(labels)
    top = F.greatest(*[F.col(f"score_{c}") for c in labels])
    exps = {c: F.exp(F.col(f"score_{c}") - top) for c in labels}
    total = reduce(lambda a, b: a + b, exps.values())
    return scored.select("*", *[(exps[c] / total).alias(f"p_{c}") for c in labels])


def explain(rows: DataFrame, model: DataFrame, predicted: DataFrame, n: int = 10,
            labels: Sequence[str] = LABELS, value: str = "weight") -> DataFrame:
    """The ``n`` terms that moved each document most, by absolute contribution.

    A contribution is the term's weight times its log-odds; the sign is seen
    from the predicted class.
    """
    first, second = sorted(labels)
    odds = model.select("term", (F.col(f"lp_0_{second}") - F.col(f"lp_0_{first}")).alias("coef"))
    return contributions(rows, odds, predicted, n, second, value)


def contributions(rows: DataFrame, coefficients: DataFrame, predicted: DataFrame, n: int,
                  positive: str, value: str = "weight") -> DataFrame:
    """Shared by Naive Bayes and linear models; coefficients are vocabulary-sized."""
    sign = F.when(F.col("prediction") == positive, 1.0).otherwise(-1.0)
    parts = (rows.filter(F.col(value) > 0).join(F.broadcast(coefficients), "term")
             .join(predicted.select("doc_id", "prediction"), "doc_id")
             .select("doc_id", F.col("term").alias("feature"),
                     F.round(F.col(value) * F.col("coef") * sign, 6).alias("contribution"))
             .withColumn("_abs", F.abs("contribution")))
    return top_per_group(parts, ["doc_id"], "_abs", ["feature"], n).drop("_abs")
