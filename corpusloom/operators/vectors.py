"""Spark ML feature stages that stay inside the JVM.

``CountVectorizerModel`` (fixed vocabulary) gives sparse counts;
``ElementwiseProduct`` multiplies by IDF; ``Normalizer`` gives unit rows.
Sublinear counts, vector building and vector stacking go through the struct
form of a sparse vector, without Python workers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .terms import idf, indexed_vocabulary, vocabulary

_SPARSE = "struct<v: struct<type: tinyint, size: int, indices: array<int>, values: array<double>>>"


def sparse_parts(vector: Column) -> Column:
    """``size``, ``indices`` and ``values`` of a sparse vector column."""
    return F.from_json(F.to_json(F.struct(vector.alias("v"))), _SPARSE)["v"]


def sparse_vector(size: Column, indices: Column, values: Column) -> Column:
    """A sparse vector column from its parts; indices must ascend."""
    body = F.struct(F.struct(F.lit(0).cast("tinyint").alias("type"), size.cast("int").alias("size"),
                             indices.cast("array<int>").alias("indices"), values.alias("values")).alias("v"))
    return F.from_json(F.to_json(body), T.StructType([T.StructField("v", VectorUDT())]))["v"]


def with_products(df: DataFrame, features: str, vectors: Sequence[Sequence[float]], out: str) -> DataFrame:
    """Adds ``out``: an array with the product of each row's sparse vector and each of ``vectors``.

    A product is a stage with a stored vector (``ElementwiseProduct``) and a sum, so no
    Python worker and no literal of vocabulary size is in the plan.
    """
    sums: list[Column] = []
    for i, weights in enumerate(vectors):
        df = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol=features, outputCol=f"{out}_{i}").transform(df)
        sums.append(F.aggregate(sparse_parts(F.col(f"{out}_{i}"))["values"], F.lit(0.0), lambda a, v: a + v))
    return df.withColumn(out, F.array(*sums)).drop(*[f"{out}_{i}" for i in range(len(vectors))])


class SublinearCounts(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces each count ``c`` of a sparse vector by ``1 + ln(c)``."""

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        tmp = f"_{self.uid}"
        parts = df.withColumn(tmp, sparse_parts(F.col(self.getInputCol())))
        logs = F.transform(F.col(f"{tmp}.values"), lambda c: 1.0 + F.log(c))
        return parts.withColumn(self.getOutputCol(), sparse_vector(
            F.col(f"{tmp}.size"), F.col(f"{tmp}.indices"), logs)).drop(tmp)


def fit_vectoriser(post: DataFrame, docs: DataFrame, max_features: int = 5000, kind: str = "tfidf",
                   smooth: bool = True, sublinear: bool = False, tokens: str = "tokens",
                   out: str = "features") -> tuple[list[Transformer], list[str]]:
    """Stages turning token arrays into features, and the term of each column.

    The vocabulary (at most ``max_features`` terms) and its IDF are the only
    rows that reach the driver: they *are* the stage parameters.
    """
    rows = indexed_vocabulary(idf(vocabulary(post, max_features), docs, smooth)).orderBy("idx").collect()
    names = [r.term for r in rows]
    counts = out if kind == "bow" else f"{out}_counts"
    stages: list[Transformer] = [CountVectorizerModel.from_vocabulary(names, inputCol=tokens, outputCol=counts)]
    if kind == "bow":
        return stages, names
    if sublinear:
        stages.append(SublinearCounts(inputCol=counts, outputCol=f"{out}_log"))
        counts = f"{out}_log"
    stages.append(ElementwiseProduct(scalingVec=Vectors.dense([r.idf for r in rows]),
                                     inputCol=counts, outputCol=f"{out}_raw"))
    stages.append(Normalizer(p=2.0, inputCol=f"{out}_raw", outputCol=out))
    return stages, names


def apply_stages(df: DataFrame, stages: Sequence[Transformer], keep: Sequence[str]) -> DataFrame:
    for stage in stages:
        df = stage.transform(df)
    return df.select(*keep)
