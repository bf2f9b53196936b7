"""Layered lake: ``raw``, ``processed`` and ``embeddings`` below one root."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import exists

LAYERS = ("raw", "processed", "embeddings")
LATEST = "latest"


def layer_path(root: str, layer: str, name: str | None, version: str | None = None) -> str:
    """Folder of a dataset (or model) version; checks the arguments."""
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of: {', '.join(LAYERS)}")
    if not name:
        what = "model_name" if layer == "embeddings" else "dataset_name"
        raise ValueError(f"{what} is required for the {layer} layer")
    return posixpath.join(root, layer, name, version or LATEST)


def _write_metadata(spark: SparkSession, path: str, metadata: Mapping) -> None:
    spark.createDataFrame([(json.dumps(metadata),)], "value string").coalesce(1).write.mode("overwrite").text(
        posixpath.join(path, "metadata.json"))


def upload_raw(spark: SparkSession, root: str, name: str, files: str | list[str], metadata: Mapping,
               version: str | None = None) -> str:
    """Original files, byte for byte, as rows of ``path, content`` plus metadata."""
    path = layer_path(root, "raw", name, version)
    found = spark.read.format("binaryFile").load(files).select(
        F.regexp_extract("path", "[^/]+$", 0).alias("file"), "length", "modificationTime", "content")
    found.write.mode("overwrite").parquet(posixpath.join(path, "files"))
    _write_metadata(spark, path, metadata)
    return path


def upload_processed(root: str, name: str, corpus: DataFrame, vocabulary: DataFrame | None = None,
                     tfidf: DataFrame | None = None, version: str | None = None) -> str:
    path = layer_path(root, "processed", name, version)
    for part, df in (("corpus", corpus), ("vocabulary", vocabulary), ("tfidf", tfidf)):
        if df is not None:
            df.write.mode("overwrite").parquet(posixpath.join(path, part))
    return path


def upload_embeddings(root: str, model: str, version: str, vectors: DataFrame, metadata: Mapping | None = None) -> str:
    path = layer_path(root, "embeddings", model, version)
    vectors.write.mode("overwrite").parquet(posixpath.join(path, "vectors"))
    if metadata is not None:
        _write_metadata(vectors.sparkSession, path, metadata)
    return path


_MAIN = {"raw": "files", "processed": "corpus", "embeddings": "vectors"}


def fetch_for_training(spark: SparkSession, root: str, dataset: str | None = None, version: str | None = None,
                       layer: str = "processed", model: str | None = None, part: str | None = None) -> DataFrame:
    path = layer_path(root, layer, model if layer == "embeddings" else dataset, version)
    return spark.read.parquet(posixpath.join(path, part or _MAIN[layer]))


def list_versions(spark: SparkSession, root: str, layer: str, dataset: str | None = None,
                  model: str | None = None) -> list[str]:
    """Sorted versions of a dataset or model; without a name, the dataset names."""
    if layer not in LAYERS:
        raise ValueError(f"layer must be one of: {', '.join(LAYERS)}")
    if layer == "embeddings" and not model:
        raise ValueError("model_name is required to list embedding versions")
    name = model if layer == "embeddings" else dataset
    folder = posixpath.join(root, layer, name) if name else posixpath.join(root, layer)
    if not exists(spark, folder):
        return []
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted({s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()})
