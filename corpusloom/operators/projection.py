"""Two-component PCA of wide sparse features, and polynomial expansion."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import sparse_parts, with_products


class Components:
    """Mean and leading directions of a feature column; both vocabulary-sized."""

    def __init__(self, mean: np.ndarray, axes: np.ndarray, ratio: list[float]) -> None:
        self.mean, self.axes, self.explained_variance_ratio = mean, axes, ratio

    def project(self, df: DataFrame, keep: list[str], features: str = "features", out: str = "xy") -> DataFrame:
        """Adds the centred coordinates of each row as ``ARRAY<DOUBLE>``."""
        offset = (self.mean @ self.axes).tolist()
        raw = with_products(df.select(*keep, features), features, self.axes.T.tolist(), "_raw")
        return raw.select(*keep, F.array(*[F.col("_raw")[i] - F.lit(o) for i, o in enumerate(offset)]).alias(out))


def fit_pca(df: DataFrame, size: int, k: int = 2, oversample: int = 10, rounds: int = 40, tol: float = 1e-7,
            features: str = "features", seed: int = 42) -> Components:
    """Leading components by block power iteration on the centred covariance.

    Every round is one Spark job: tasks add up ``x (x'Q)`` over their rows, a whole Arrow
    batch at a time, for a block Q of a dozen directions and return sums per feature.
    The driver only ever holds ``size x block`` numbers (size is the vocabulary limit).
    The feature covariance itself (size squared) is never built.  Rounds end when what the
    covariance makes of the leading directions differs from a multiple of them by less
    than ``tol`` of the largest variance.
    """
    rows = df.select(sparse_parts(F.col(features)).alias("s")).select("s.indices", "s.values").persist()
    first = rows.select(F.count(F.lit(1)).alias("n"), F.sum(
        F.aggregate("values", F.lit(0.0), lambda a, v: a + v * v)).alias("sq")).first()
    n = first.n
    exploded = rows.select(F.explode(F.arrays_zip("indices", "values")).alias("e"))
    mean = np.zeros(size)
    for r in exploded.groupBy("e.indices").agg(F.sum("e.values").alias("t")).collect():  # <= size rows
        mean[r.indices] = r.t / n
    total = ((first.sq or 0.0) - n * float(mean @ mean)) / max(n - 1, 1)
    width = min(k + oversample, size)
    filled = rows.filter(F.size("indices") > 0)

    def gram_times(block: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            acc = np.zeros_like(block)
            for batch in batches:
                if batch.num_rows:
                    at, x = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (0, 1))
                    lengths = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
                    along = np.add.reduceat(x[:, None] * block[at], np.cumsum(lengths) - lengths, axis=0)
                    np.add.at(acc, at, x[:, None] * np.repeat(along, lengths, axis=0))
            used = np.flatnonzero(np.any(acc != 0.0, axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(list(acc[used]), pa.list_(pa.float64()))], ["idx", "part"])

        parts = filled.mapInArrow(run, "idx long, part array<double>")
        summed = parts.groupBy("idx").agg(F.array(*[F.sum(F.col("part")[j]) for j in range(width)]).alias("s"))
        out = np.zeros_like(block)
        for r in summed.collect():  # <= size rows
            out[r.idx] = r.s
        return out - n * np.outer(mean, mean @ block)

    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))
    for _ in range(rounds):
        image = gram_times(q)
        small = q.T @ image
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1][:k]
        axes, values = q @ vectors[:, order], values[order]
        if np.linalg.norm(image @ vectors[:, order] - axes * values, axis=0).max() <= tol * max(values[0], 1e-300):
            break
        q, _ = np.linalg.qr(image)
    rows.unpersist()
    axes = axes * np.where(axes[np.argmax(np.abs(axes), axis=0), range(axes.shape[1])] < 0, -1.0, 1.0)
    ratio = [float(v / max(n - 1, 1) / total) if total > 0 else 0.0 for v in values]
    return Components(mean, axes, ratio)


def expand(df: DataFrame, degree: int, xy: str = "xy", out: str = "features") -> DataFrame:
    """All monomials of two coordinates up to ``degree``, without the constant."""
    vec = df.withColumn("_xy", array_to_vector(F.col(xy)))
    if degree == 1:
        return vec.withColumn(out, F.col("_xy")).drop("_xy")
    return PolynomialExpansion(degree=degree, inputCol="_xy", outputCol=out).transform(vec).drop("_xy")


def full_space_size(d: int) -> int:
    """Number of degree-2 products of ``d`` features."""
    return d * (d + 1) // 2
