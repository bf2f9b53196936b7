"""Run log, model versions, stored models and artefacts as plain tables."""

from __future__ import annotations

import json
import posixpath
from collections.abc import Mapping, Sequence
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import safe_float
from ..operators import registry
from ..plans.config import SERVING, Setup
from ..schemas import MODEL_VERSIONS, RUNS
from . import files


def slug(name) -> str:
    """Lower case, with slashes and blanks as underscores."""
    return name.lower().translate(str.maketrans("/ ", "__"))


def params_of(setup: Setup, sources: str, n_train: int, n_test: int) -> dict[str, str]:
    """A run's parameters: every field of the setup's records, and what it was trained on."""
    fields = {k: str(v) for part in ("tokens", "features", "model") for k, v in asdict(getattr(setup, part)).items()}
    return fields | {"sources": sources, "n_train": str(n_train), "n_test": str(n_test)}


def append_run(spark: SparkSession, store: str, run_id: str, experiment: str, setup: Setup,
               params: Mapping[str, str], metrics: Mapping[str, float]) -> None:
    append_runs(spark, store, experiment, [(run_id, setup, params, metrics)])


def append_runs(spark: SparkSession, store: str, experiment: str,
                rows: Sequence[tuple[str, Setup, Mapping[str, str], Mapping[str, float]]]) -> None:
    """Logs runs of one experiment (``run_id, setup, params, metrics``) in one write."""
    made = [(run_id, experiment, setup.name, setup.model.family, setup.model.variant, dict(params), dict(metrics), None)
            for run_id, setup, params, metrics in rows]
    frame = spark.createDataFrame(made, RUNS).withColumn("start_time", F.current_timestamp())
    frame.coalesce(1).write.mode("append").parquet(posixpath.join(store, "runs"))


def read_runs(spark: SparkSession, store: str) -> DataFrame:
    path = posixpath.join(store, "runs")
    return spark.read.schema(RUNS).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], RUNS)


def run_metrics(runs: DataFrame) -> DataFrame:
    """Runs with their headline metrics as columns."""
    return runs.select("run_id", "experiment", "run_name", "family", "variant", "start_time", *[
        safe_float(F.col("metrics")[m]).alias(m) for m in ("weighted_f1", "accuracy", "roc_auc")])


def append_version(spark: SparkSession, store: str, model: str, run_id: str, metrics: Mapping[str, float]) -> int:
    """Registers the next version of a model and returns its number.

    A version is a file of its own that is created only if it is not there yet; of
    writers that want one number, one gets it and the others go on to the next.
    """
    version = (read_versions(spark, store).filter(F.col("model_name") == model).agg(F.max("version").alias("v")).first().v or 0) + 1
    while True:
        row = {"model_name": model, "version": version, "stage": None, "run_id": run_id,
               **{m: float(metrics[m]) for m in ("weighted_f1", "accuracy", "roc_auc")}}
        if files.create_once(spark, posixpath.join(store, "versions", slug(model), f"{version:08d}.json"), json.dumps(row)):
            return version
        version += 1


def read_versions(spark: SparkSession, store: str) -> DataFrame:
    path = posixpath.join(store, "versions")
    return (spark.read.schema(MODEL_VERSIONS).option("recursiveFileLookup", "true").json(path) if files.exists(spark, path)
            else spark.createDataFrame([], MODEL_VERSIONS))


def staged_versions(spark: SparkSession, store: str) -> DataFrame:
    """Versions with the stage that replaying the promotion rule gives them."""
    return registry.promotions(read_versions(spark, store).drop("stage"), score="weighted_f1")


def model_path(store: str, model: str, version: int) -> str:
    return posixpath.join(store, "models", slug(model), str(version))


def save_model(pipeline: PipelineModel, path: str) -> None:
    pipeline.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def lexicon_path(store: str, model: str, version: int) -> str:
    return posixpath.join(store, "lexicons", slug(model), str(version))


def ensure_serving_model(spark: SparkSession, store: str, model: str, corpus, setup: Setup = SERVING) -> dict:
    """The production (else latest) version; trains and registers one if there is none.

    The lexicon that a lemmatising setup was trained on is stored beside the model, with
    its version; ``lexicon_path`` is None for other setups.
    """
    if read_versions(spark, store).filter(F.col("model_name") == model).isEmpty():
        from ..plans.experiments import fit, log_runs, summarise

        fitted = fit(setup, corpus)
        scores = summarise(fitted).first()
        run_id = log_runs(spark, store, "bootstrap", corpus, [(setup, scores)])[0]
        version = append_version(spark, store, model, run_id, scores.asDict())
        save_model(fitted.pipeline, model_path(store, model, version))
        if setup.tokens.normalization == "lemmatizer":
            corpus.lexicon(setup).write.mode("overwrite").parquet(lexicon_path(store, model, version))
        write_artifacts(posixpath.join(store, "artifacts", slug(model), str(version)),
                        terms=spark.createDataFrame(list(enumerate(fitted.names)), "idx int, term string"))
    row = registry.serving_version(staged_versions(spark, store)).filter(F.col("model_name") == model).first()
    words = lexicon_path(store, model, row.version)
    return {**row.asDict(), "model_path": model_path(store, model, row.version), "lexicon_path": words if files.exists(spark, words) else None}


def load_lexicon(spark: SparkSession, info: Mapping) -> DataFrame | None:
    """The lexicon stored with a version, as ``ensure_serving_model`` names it."""
    return spark.read.parquet(info["lexicon_path"]) if info["lexicon_path"] else None


def write_artifacts(path: str, **tables: DataFrame) -> None:
    """Result tables (report, vocabulary, ablation rows) as JSON lines."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(posixpath.join(path, name))
