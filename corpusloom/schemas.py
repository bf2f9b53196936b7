"""Explicit schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

CORPUS = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("source", T.StringType()),
])

#: Fixed column order of the headerless statement files.
STATEMENTS = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "id", "label", "statement", "subject", "speaker", "job_title", "state", "party")]
    + [T.StructField(n, T.IntegerType()) for n in (
        "barely_true", "false", "half_true", "mostly_true", "pants_fire")]
    + [T.StructField("context", T.StringType())]
)

RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("experiment", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("family", T.StringType()),
    T.StructField("variant", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("start_time", T.TimestampType()),
])

MODEL_VERSIONS = T.StructType([
    T.StructField("model_name", T.StringType()),
    T.StructField("version", T.IntegerType()),
    T.StructField("stage", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("weighted_f1", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("roc_auc", T.DoubleType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
