"""Scoring of arriving texts; batch and stream share every step."""

from __future__ import annotations

import posixpath

from pyspark.ml import PipelineModel
from pyspark.ml.feature import ElementwiseProduct
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.fixed import LABELS
from ..functions.tokens import tokenize
from ..operators import linear
from ..operators.corpus import reject_reason
from ..operators.vectors import apply_stages, sparse_parts
from ..plans.config import Setup
from ..plans.preprocess import preprocess

REQUESTS = "request_id bigint, text string"


def score(df: DataFrame, pipeline: PipelineModel, setup: Setup, names: list[str] | None = None,
          key: str = "request_id", top: int = 10, lexicon: DataFrame | None = None) -> DataFrame:
    """Validate, preprocess, classify and, given ``names``, explain.

    Invalid rows stay in the result with their ``reject_reason`` and null
    scores.  With a stemmer or none every step is per row, so the plan also runs on a
    stream.  The lemmatiser looks words up in ``lexicon``, the one stored with the model:
    then ``df`` is a batch, and a stream is scored batch by batch (``start_scoring``).
    """
    if setup.tokens.normalization == "lemmatizer":
        if lexicon is None:
            raise ValueError("scoring with the lemmatiser needs the lexicon stored with the model")
        if df.isStreaming:
            raise ValueError("with the lemmatiser a stream is scored by start_scoring")
    marked = df.withColumn("reject_reason", reject_reason(text=F.col("text")))
    valid = F.col("reject_reason").isNull()
    done = preprocess(marked.withColumn("_text", F.when(valid, F.col("text")).otherwise("")), setup, text="_text", lexicon=lexicon)
    toks = done.withColumn("tokens", tokenize(F.col("processed_text"), "word"))
    model = pipeline.stages[-1]
    columns = [key, "reject_reason", "processed_text", model.getFeaturesCol()]
    out = linear.predict(model, apply_stages(toks, pipeline.stages[:-1], columns), columns)
    if names is not None and len(model.coefficients) == len(names):
        out = _explained(out, model, names, top)
    keep = [c for c in ("prediction", "confidence", "class_probabilities", "top_contributing_features") if c in out.columns]
    return out.select(key, "reject_reason", "processed_text", *[
        F.when(F.col("reject_reason").isNull(), F.col(c)).alias(c) for c in keep])


def _explained(df: DataFrame, model, names: list[str], top: int) -> DataFrame:
    """Adds the largest contributions of the row's own terms, as an array of structs.

    Weights are multiplied in by a stage; only the names of the ``top`` largest are looked up.
    """
    weighed = ElementwiseProduct(scalingVec=model.coefficients, inputCol=model.getFeaturesCol(), outputCol="_weighed").transform(df)
    terms = F.array(*[F.lit(n) for n in names])
    sign = F.when(F.col("prediction") == LABELS[1], 1.0).otherwise(-1.0)
    parts = sparse_parts(F.col("_weighed"))
    pairs = F.transform(F.arrays_zip(parts["indices"].alias("i"), parts["values"].alias("x")), lambda p: F.struct(
        F.round(p["x"] * sign, 6).alias("contribution"), p["i"].alias("i")))
    # names are sorted, so among equal contributions the smaller index is the smaller name
    ranked = F.array_sort(F.transform(pairs, lambda p: F.struct(
        (-F.abs(p["contribution"])).alias("o"), p["i"].alias("i"), p["contribution"].alias("contribution"))))
    return weighed.withColumn("top_contributing_features", F.transform(F.slice(ranked, 1, top), lambda p: F.struct(
        F.get(terms, p["i"]).alias("feature"), p["contribution"].alias("contribution")))).drop("_weighed")


def start_scoring(spark: SparkSession, source: str, sink: str, checkpoint: str, pipeline: PipelineModel,
                  setup: Setup, names: list[str] | None = None, lexicon: DataFrame | None = None) -> StreamingQuery:
    """Scores JSON request files as they arrive in ``source``.

    With the lemmatiser each micro-batch is scored as a batch against ``lexicon`` and
    written to its own folder ``batch=<number>`` of the sink, so a batch that runs again
    after a failure replaces what it had written.
    """
    arriving = spark.readStream.schema(REQUESTS).json(source)
    if setup.tokens.normalization != "lemmatizer":
        return (score(arriving, pipeline, setup, names).writeStream.format("parquet")
                .option("path", sink).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())

    def write(batch: DataFrame, number: int) -> None:
        score(batch, pipeline, setup, names, lexicon=lexicon).write.mode("overwrite").parquet(posixpath.join(sink, f"batch={number}"))

    return arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
