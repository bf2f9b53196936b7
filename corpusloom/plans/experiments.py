"""Fit and evaluate configured pipelines; experiment groups as result tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PolynomialExpansion
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import LABELS
from ..functions.tokens import tokenize
from ..operators import linear, metrics, registry, terms
from ..operators.corpus import combine
from ..operators.stages import CountBayes, LeadingDirections, Projection
from ..operators.vectors import apply_stages, fit_vectoriser
from ..session import beside, settle
from ..sources import runs
from .config import Setup
from .preprocess import lexicon_of, preprocess

FAMILIES = ("naive_bayes", "logistic_regression", "polynomial_lr")


@dataclass
class Corpus:
    """Split labelled corpus; token tables are built once per preprocessing."""

    docs: DataFrame  # doc_id, label, part and the text column
    text: str = "text"
    cleaned: str | None = None
    _tables: dict[tuple, tuple[DataFrame, DataFrame]] = field(default_factory=dict)

    def lexicon(self, setup: Setup) -> DataFrame:
        """The words that served the lemmatiser as lexicon; a model that was trained on it scores with it."""
        return lexicon_of(self.docs, setup, self.text, self.cleaned)

    def tables(self, setup: Setup) -> tuple[DataFrame, DataFrame]:
        """``(doc_id, label, part, tokens)`` and its train/test postings."""
        if setup.tokens not in self._tables:
            done = preprocess(self.docs.select("doc_id", "label", "part", self.cleaned or self.text), setup, text=self.text, cleaned=self.cleaned, removed=False)
            toks = settle(done.select("doc_id", "label", "part",
                                      tokenize(F.col("processed_text"), "word").alias("tokens")))
            post = settle(terms.postings(toks, keep=["label", "part"]))
            self._tables[setup.tokens] = (toks, post)
        return self._tables[setup.tokens]


@dataclass
class Fitted:
    """What evaluation and serving need from a fitted configuration."""

    setup: Setup
    predictions: DataFrame  # doc_id, label, prediction, score
    pipeline: PipelineModel
    names: list[str]
    train_predictions: DataFrame
    explained_variance: list[float] = field(default_factory=list)


def build_pipeline(setup: Setup, toks: DataFrame, post: DataFrame, labels: Sequence[str] = LABELS) -> tuple[PipelineModel, list[str]]:
    """Vectoriser and classifier as one Spark ML pipeline over ``tokens``, for every family.

    All stages can be saved and run row by row, so the same pipeline serves batches and
    streams.  The last stage gives ``probability``, sorted by label.
    """
    family, variant = setup.model.family, setup.model.variant
    if family not in FAMILIES:
        raise ValueError(f"unsupported model family: {family}")
    train, train_post = toks.filter(F.col("part") == "train"), post.filter(F.col("part") == "train")
    stages, names = fit_vectoriser(train_post, train, setup.features.max_features, setup.features.vectorizer,
                                   setup.features.smooth_idf, setup.features.sublinear_tf)
    rows = apply_stages(train, stages, ["doc_id", "label", "features"]).persist()
    if family == "naive_bayes":
        alpha = float(variant.removeprefix("alpha_")) if variant.startswith("alpha_") else 1.0
        last = [CountBayes(smoothing=alpha, classes=list(labels), size=len(names)).fit(rows)]
    elif family == "polynomial_lr":
        plane = LeadingDirections(inputCol="features", outputCol="plane", size=len(names)).fit(rows)
        wide = [plane] + ([PolynomialExpansion(degree=setup.model.degree, inputCol="plane", outputCol="monomials")] if setup.model.degree > 1 else [])
        column = "monomials" if setup.model.degree > 1 else "plane"
        last = [*wide, linear.fit_logistic(apply_stages(rows, wide, ["doc_id", "label", column]), features=column, labels=labels)]
    else:
        last = [linear.fit_logistic(rows, variant, balanced=True, labels=labels)]
    rows.unpersist()
    return PipelineModel([*stages, *last]), names


def fit(setup: Setup, corpus: Corpus, labels: Sequence[str] = LABELS) -> Fitted:
    """Trains on part ``train`` and predicts part ``test``."""
    if setup.model.family not in FAMILIES:
        raise ValueError(f"unsupported model family: {setup.model.family}")
    toks, post = corpus.tables(setup)
    train, test = (toks.filter(F.col("part") == p) for p in ("train", "test"))
    pipeline, names = build_pipeline(setup, toks, post, labels)

    def predicted(side: DataFrame) -> DataFrame:
        columns = ["doc_id", "label", pipeline.stages[-1].getFeaturesCol()]
        return linear.predict(pipeline.stages[-1], apply_stages(side, pipeline.stages[:-1], columns), ["doc_id", "label"], labels)

    shares = next((s.explained_variance_ratio for s in pipeline.stages if isinstance(s, Projection)), [])
    return Fitted(setup, predicted(test), pipeline, names, predicted(train), shares)


def summarise(fitted: Fitted) -> DataFrame:
    """One row: what was configured, its metrics, and those of each class."""
    setup = fitted.setup
    predicted = settle(fitted.predictions.select("doc_id", "label", "prediction", "score"))
    cells = metrics.class_report(metrics.confusion(predicted))
    scores = metrics.weighted_metrics(cells, digits=None)
    per_class = cells.agg(*[F.max(F.when(F.col("label") == c, F.col(m))).alias(f"{m}_{c}")
                            for c in sorted(LABELS) for m in ("precision", "recall", "f1", "support")])
    area = metrics.auc(metrics.roc_points(predicted)).withColumnRenamed("auc", "roc_auc")
    return terms.attach(terms.attach(scores, area), per_class).select(
        F.lit(setup.name).alias("name"), F.lit(setup.model.family).alias("family"),
        F.lit(setup.model.variant).alias("variant"), F.lit(setup.features.vectorizer).alias("vectorizer"),
        F.lit(setup.tokens.stopword_list).alias("stopword_list"), F.lit(setup.tokens.normalization).alias("normalization"),
        F.lit(setup.tokens.min_token_length).alias("min_token_length"), F.lit(setup.features.max_features).alias("max_features"),
        F.col("f1").alias("weighted_f1"), "accuracy", "roc_auc", *per_class.columns)


def log_runs(spark: SparkSession, store: str, experiment: str, corpus: Corpus, done: Sequence[tuple[Setup, Row]]) -> list[str]:
    """Logs summarised setups as runs of ``experiment`` and returns their ids."""
    sizes = {r.part: r["count"] for r in corpus.docs.groupBy("part").count().collect()}  # train and test
    sources = corpus.docs.select("source") if "source" in corpus.docs.columns else corpus.docs.select(F.lit("corpus").alias("source"))
    named = registry.run_sources(sources).first().sources
    rows = []
    for setup, scores in done:
        values = {k: float(v) for k, v in scores.asDict().items() if isinstance(v, (int, float)) and not hasattr(setup.tokens, k) and not hasattr(setup.features, k)}
        values.pop("run_order", None)
        rows.append((f"{runs.slug(experiment)}-{runs.slug(setup.name)}-{uuid.uuid4().hex[:12]}", setup,
                     runs.params_of(setup, named, sizes.get("train", 0), sizes.get("test", 0)), values))
    runs.append_runs(spark, store, experiment, rows)
    return [r[0] for r in rows]


def run_group(setups: Sequence[Setup], corpus: Corpus, store: str | None = None, experiment: str = "group",
              register: bool = False) -> DataFrame:
    """Metric rows of every configuration, in order (``run_order``).

    With ``store`` each configuration is logged as a run; with ``register`` the best of
    each family is also stored as a model and registered as its next version.
    """
    for setup in setups:
        corpus.tables(setup)  # shared ones are built before the fits need them
    fitted = beside(lambda c: fit(c, corpus), setups)
    rows = combine([r.withColumn("run_order", F.lit(i)) for i, r in enumerate(beside(summarise, fitted))])
    if store is None:
        return rows
    spark, rows = corpus.docs.sparkSession, settle(rows)
    scores = sorted(rows.collect(), key=lambda r: r.run_order)  # one row a configuration
    ids = log_runs(spark, store, experiment, corpus, [(f.setup, r) for f, r in zip(fitted, scores, strict=True)])
    if register:
        for best in registry.best_per_family(rows, score="weighted_f1").collect():
            model, at = f"{experiment}/{best.family}", best.run_order
            version = runs.append_version(spark, store, model, ids[at], scores[at].asDict())
            runs.save_model(fitted[at].pipeline, runs.model_path(store, model, version))
    return rows
