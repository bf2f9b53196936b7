"""Classifier evaluation from a ``label, prediction[, score]`` table.

Everything starts from one partial aggregation: confusion counts, or counts
per distinct score, which then run as sums over parts (see ``ordered``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import LABELS
from ..functions.numbers import ratio
from .ordered import running_sums
from .sampling import sample_exact
from .terms import attach


def confusion(pred: DataFrame, labels: Sequence[str] = LABELS, by: Sequence[str] = ()) -> DataFrame:
    """Counts for every (label, prediction) cell, zeros included."""
    labels = sorted(labels)
    cells = pred.groupBy(*by).agg(*[
        F.sum(((F.col("label") == a) & (F.col("prediction") == b)).cast("long")).alias(f"_{i}_{j}")
        for i, a in enumerate(labels) for j, b in enumerate(labels)])
    rows = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"),
                              F.coalesce(F.col(f"_{i}_{j}"), F.lit(0).cast("long")).alias("n"))
                     for i, a in enumerate(labels) for j, b in enumerate(labels)])
    return cells.select(*by, F.explode(rows).alias("c")).select(*by, "c.*")


def class_report(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """precision, recall, f1, support per class (zero where undefined)."""
    per_actual = [*by, "label"]
    actual = cells.groupBy(*per_actual).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("hits"))
    predicted = cells.groupBy(*by, F.col("prediction").alias("label")).agg(F.sum("n").alias("claimed"))
    both = actual.join(predicted, [*by, "label"])
    p, r = ratio(F.col("hits"), F.col("claimed")), ratio(F.col("hits"), F.col("support"))
    return both.select(*by, "label", p.alias("precision"), r.alias("recall"),
                       ratio(2 * p * r, p + r).alias("f1"), "support", "hits")


def weighted_metrics(report: DataFrame, by: Sequence[str] = (), digits: int | None = 6) -> DataFrame:
    """accuracy and support-weighted precision, recall, f1, as they are or to so many digits."""
    total = F.sum("support")

    def shown(value: Column) -> Column:
        return value if digits is None else F.round(value, digits)

    def weighted(name: str) -> Column:
        return shown(ratio(F.sum(F.col(name) * F.col("support")), total)).alias(name)

    return report.groupBy(*by).agg(
        shown(ratio(F.sum("hits"), total)).alias("accuracy"),
        weighted("precision"), weighted("recall"), weighted("f1"), total.alias("support"))


def evaluate(pred: DataFrame, labels: Sequence[str] = LABELS, by: Sequence[str] = ()) -> DataFrame:
    return weighted_metrics(class_report(confusion(pred, labels, by), by), by)


def full_report(pred: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Class rows, then accuracy, macro and weighted averages, long form."""
    report = class_report(confusion(pred, labels))
    names = ("precision", "recall", "f1")
    n = F.sum("support")
    acc = ratio(F.sum("hits"), n)
    summary = report.groupBy().agg(
        F.struct(*[acc.alias(c) for c in names]).alias("accuracy"),
        F.struct(*[F.avg(c).alias(c) for c in names]).alias("macro"),
        F.struct(*[ratio(F.sum(F.col(c) * F.col("support")), n).alias(c) for c in names]).alias("weighted"),
        n.alias("support"))
    lines = summary.select(F.explode(F.array(*[
        F.struct(F.lit(title).alias("row"), *[F.col(f"{col}.{c}").alias(c) for c in names],
                 F.col("support").alias("support"))
        for title, col in (("accuracy", "accuracy"), ("macro avg", "macro"), ("weighted avg", "weighted"))
    ])).alias("s")).select("s.*")
    rows = report.select(F.col("label").alias("row"), *names, "support").unionByName(lines)
    return rows.select("row", *[F.round(c, 6).alias(c) for c in names], "support")


def roc_points(scored: DataFrame, positive: str = LABELS[1], by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score, highest first: rates of false and true positives from there up.

    Next to ``fpr`` and ``tpr`` stand the counts they come from: ``pos`` and ``neg`` at
    the threshold, ``before_pos`` and ``before_neg`` above it.  Scores count as they are,
    unrounded; rates are 0 where a class is missing.  Null scores are left out.
    """
    by = list(by)
    hit = (F.col("label") == positive).cast("long")
    steps = scored.filter("score IS NOT NULL").groupBy(*by, F.col("score").alias("threshold")).agg(
        F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg"))
    ran = running_sums(steps, ["pos", "neg"], [F.desc("threshold")], by)
    totals = ran.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    both = ran.join(totals, [ran[c].eqNullSafe(totals[f"_{c}"]) for c in by]) if by else attach(ran, totals)
    return both.select(
        *by, "threshold", "pos", "neg", "before_pos", "before_neg",
        ratio(F.col("before_neg") + F.col("neg"), F.col("_neg")).alias("fpr"),
        ratio(F.col("before_pos") + F.col("pos"), F.col("_pos")).alias("tpr"))


def auc(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC points: pairs ranked right, ties half, in whole numbers up to the last division."""
    pairs = F.sum(F.col("neg").cast("decimal(19,0)") * (2 * F.col("before_pos") + F.col("pos")).cast("decimal(19,0)"))
    every = 2.0 * F.sum("pos") * F.sum("neg")
    return points.groupBy(*by).agg(ratio(pairs.cast("double"), every).alias("auc"))


def error_summary(pred: DataFrame, sample: int = 30, seed: int = 42) -> DataFrame:
    """Wrong predictions in total and by direction; directions also on a sample."""
    wrong = F.col("label") != F.col("prediction")
    fake_for_real = wrong & (F.col("label") == "real") & (F.col("prediction") == "fake")
    totals = pred.agg(
        F.count(F.lit(1)).alias("evaluated"), F.sum(wrong.cast("long")).alias("wrong"),
        F.sum(fake_for_real.cast("long")).alias("false_positive"))
    drawn = sample_exact(pred.filter(wrong), sample, seed=seed).agg(
        F.count(F.lit(1)).alias("sampled"),
        F.coalesce(F.sum(fake_for_real.cast("long")), F.lit(0)).alias("sampled_false_positive"))
    both = attach(totals, drawn)
    return both.select(
        "evaluated", "wrong", F.round(ratio(F.col("wrong"), F.col("evaluated")), 6).alias("rate"),
        "false_positive", (F.col("wrong") - F.col("false_positive")).alias("false_negative"),
        "sampled", "sampled_false_positive",
        (F.col("sampled") - F.col("sampled_false_positive")).alias("sampled_false_negative"))
