"""Estimators and models that Spark ML lacks, as pipeline stages that can be saved; they run without Python workers."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCol, HasLabelCol, HasOutputCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import LABELS
from .bayes import EPS
from .projection import fit_pca
from .vectors import with_products


class _BayesParams(HasFeaturesCol, HasLabelCol, HasProbabilityCol, HasRawPredictionCol):
    classes = Param(Params._dummy(), "classes", "labels in sorted order", TypeConverters.toListString)
    smoothing = Param(Params._dummy(), "smoothing", "count added to every term", TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "length of the feature vectors", TypeConverters.toInt)


class CountBayes(Estimator, _BayesParams, DefaultParamsReadable, DefaultParamsWritable):
    """Multinomial Naive Bayes over non-negative sparse vectors.

    The fit is one aggregation: a sum of vectors per class, as many numbers as classes
    times features.
    """

    @keyword_only
    def __init__(self, featuresCol: str = "features", labelCol: str = "label", smoothing: float = 1.0,
                 classes: Sequence[str] = LABELS, size: int = 0) -> None:
        super().__init__()
        kwargs = dict(self._input_kwargs)
        kwargs["classes"] = sorted(kwargs.get("classes", LABELS))
        self._setDefault(featuresCol="features", labelCol="label", smoothing=1.0, size=0)
        self._set(**kwargs)

    def _fit(self, df: DataFrame) -> CountBayesModel:
        alpha, size = self.getOrDefault("smoothing"), self.getOrDefault("size")
        labels = self.getOrDefault("classes")
        rows = df.groupBy(F.col(self.getLabelCol()).alias("label")).agg(
            F.count(F.lit(1)).alias("n"), Summarizer.sum(F.col(self.getFeaturesCol())).alias("s")).collect()
        sums = {r.label: (r.n, r.s.toArray()) for r in rows}
        total = sum(n for n, _ in sums.values())
        priors, weights = [], []
        for label in labels:
            n, s = sums.get(label, (0, np.zeros(size or max((len(v) for _, v in sums.values()), default=0))))
            priors.append(math.log((n / total if total else 0.0) + EPS))
            weights.append(np.log((s + alpha) / (s.sum() + alpha * len(s)) + EPS).tolist())
        model = CountBayesModel(featuresCol=self.getFeaturesCol(), classes=labels, priors=priors, weights=sum(weights, []))
        return self._copyValues(model)


class CountBayesModel(Model, _BayesParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``rawPrediction`` (log scores) and ``probability`` (their softmax), in the order of ``classes``."""

    priors = Param(Params._dummy(), "priors", "log priors", TypeConverters.toListFloat)
    weights = Param(Params._dummy(), "weights", "log probabilities, class after class", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, featuresCol: str = "features", classes: Sequence[str] | None = None,
                 priors: Sequence[float] | None = None, weights: Sequence[float] | None = None) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", probabilityCol="probability", rawPredictionCol="rawPrediction")
        self._set(**self._input_kwargs)

    @property
    def term_weights(self) -> np.ndarray:
        """Log probabilities, one row a class."""
        return np.array(self.getOrDefault("weights")).reshape(len(self.getOrDefault("classes")), -1)

    @property
    def coefficients(self):
        """Log odds of the second class against the first."""
        first, second = self.term_weights
        return Vectors.dense(second - first)

    def _transform(self, df: DataFrame) -> DataFrame:
        raw, priors = f"_{self.uid}", self.getOrDefault("priors")
        done = with_products(df, self.getFeaturesCol(), self.term_weights.tolist(), raw)
        scores = [F.col(raw)[i] + F.lit(p) for i, p in enumerate(priors)]
        top = F.greatest(*scores) if len(scores) > 1 else scores[0]
        odds = [F.exp(s - top) for s in scores]
        whole = sum(odds[1:], odds[0])
        return (done.withColumn(self.getRawPredictionCol(), array_to_vector(F.array(*scores)))
                .withColumn(self.getProbabilityCol(), array_to_vector(F.array(*[o / whole for o in odds]))).drop(raw))


class LeadingDirections(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """PCA of sparse vectors by block power iteration; the model centres and projects."""

    k = Param(Params._dummy(), "k", "number of directions", TypeConverters.toInt)
    size = Param(Params._dummy(), "size", "length of the feature vectors", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None, k: int = 2, size: int = 0) -> None:
        super().__init__()
        self._setDefault(k=2)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> Projection:
        found = fit_pca(df, self.getOrDefault("size"), self.getOrDefault("k"), features=self.getInputCol())
        return Projection(inputCol=self.getInputCol(), outputCol=self.getOutputCol(), axes=found.axes.T.ravel().tolist(),
                          offset=(found.mean @ found.axes).tolist(), shares=found.explained_variance_ratio)


class Projection(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the coordinates of a sparse vector along stored directions, as a vector."""

    axes = Param(Params._dummy(), "axes", "directions, one after another", TypeConverters.toListFloat)
    offset = Param(Params._dummy(), "offset", "coordinates of the mean", TypeConverters.toListFloat)
    shares = Param(Params._dummy(), "shares", "shares of the variance", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None, axes: Sequence[float] | None = None,
                 offset: Sequence[float] | None = None, shares: Sequence[float] | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def explained_variance_ratio(self) -> list[float]:
        return self.getOrDefault("shares")

    def _transform(self, df: DataFrame) -> DataFrame:
        raw, offset = f"_{self.uid}", self.getOrDefault("offset")
        axes = np.array(self.getOrDefault("axes")).reshape(len(offset), -1)
        done = with_products(df, self.getInputCol(), axes.tolist(), raw)
        return done.withColumn(self.getOutputCol(), array_to_vector(F.array(*[F.col(raw)[i] - F.lit(o) for i, o in enumerate(offset)]))).drop(raw)
