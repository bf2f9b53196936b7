"""Run history and promotion queries, with orders standing in for runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import registry as rg
from .base import query, table

_VERSIONS = """v AS (SELECT o_orderpriority AS model_name, o_orderkey AS version,
  o_totalprice / 600001 AS f1, o_custkey, o_orderdate FROM orders)"""
_FOLD = f"""RECURSIVE {_VERSIONS}, fold AS (
  SELECT model_name, version, f1 FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version) AS rn FROM v) WHERE rn = 1
  UNION ALL
  SELECT model_name, version, f1 FROM (
    SELECT o.model_name, o.version, o.f1, row_number() OVER (PARTITION BY o.model_name ORDER BY o.version) AS rn
    FROM fold f JOIN v o ON o.model_name = f.model_name AND o.version > f.version AND o.f1 >= f.f1 + 0.01::DOUBLE) WHERE rn = 1),
staged AS (SELECT v.model_name, v.version, v.f1, CASE WHEN f.version IS NULL THEN 'Staging'
    WHEN f.version = max(f.version) OVER (PARTITION BY v.model_name) THEN 'Production' ELSE 'Archived' END AS stage
  FROM v LEFT JOIN fold f ON f.model_name = v.model_name AND f.version = v.version)"""


def _versions(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "orders").select(
        F.col("o_orderpriority").alias("model_name"), F.col("o_orderkey").alias("version"),
        (F.col("o_totalprice") / 600001).alias("f1"))


@query("promotion_fold", f"WITH {_FOLD} SELECT model_name, version, f1, stage FROM staged")
def promotion_fold(spark: SparkSession, data: str) -> DataFrame:
    return rg.promotions(_versions(spark, data)).select("model_name", "version", "f1", "stage")


@query("serving_version", f"""WITH {_FOLD}
SELECT model_name, version, stage FROM (SELECT *, row_number() OVER (PARTITION BY model_name
  ORDER BY CASE WHEN stage = 'Production' THEN 0 ELSE 1 END, version DESC) AS rn FROM staged) WHERE rn = 1""")
def serving_version(spark: SparkSession, data: str) -> DataFrame:
    return rg.serving_version(rg.promotions(_versions(spark, data)))


@query("best_per_family", f"""WITH {_VERSIONS}
SELECT family, run_order, f1 FROM (SELECT model_name AS family, version AS run_order, f1,
  row_number() OVER (PARTITION BY model_name ORDER BY f1 DESC, version) AS rn FROM v) WHERE rn = 1""")
def best_per_family(spark: SparkSession, data: str) -> DataFrame:
    runs = _versions(spark, data).toDF("family", "run_order", "f1")
    return rg.best_per_family(runs)


@query("recent_runs", """SELECT o_orderkey AS run_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS start_time
FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10""")
def recent_runs(spark: SparkSession, data: str) -> DataFrame:
    runs = table(spark, data, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("start_time"))
    return rg.recent_runs(runs).select(
        "run_id", F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss").alias("start_time"))


@query("registry_history", """SELECT o.o_orderpriority AS model_name, o.o_orderkey AS version,
  CASE WHEN o.o_orderstatus = 'F' THEN round(o.o_totalprice / 600001, 6) ELSE coalesce(round(c.c_acctbal / 10000, 6), 0.0) END AS weighted_f1,
  coalesce(round(c.c_acctbal / 10000, 6), 0.0) AS accuracy
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_mktsegment <> 'BUILDING'""")
def registry_history(spark: SparkSession, data: str) -> DataFrame:
    versions = table(spark, data, "orders").select(
        F.col("o_orderpriority").alias("model_name"), F.col("o_orderkey").alias("version"),
        F.col("o_custkey").alias("run_id"),
        F.when(F.col("o_orderstatus") == "F", F.round(F.col("o_totalprice") / 600001, 6)).alias("weighted_f1"),
        F.lit(None).cast("double").alias("accuracy"))
    score = F.round(F.col("c_acctbal") / 10000, 6)
    runs = table(spark, data, "customer").filter(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("run_id"), score.alias("weighted_f1"), score.alias("accuracy"))
    return rg.history(versions, runs, ["weighted_f1", "accuracy"]).drop("run_id")


@query("performance_report", f"""WITH {_FOLD},
h AS (SELECT s.model_name, s.version, s.stage, v.o_custkey AS run_id, s.f1 AS weighted_f1, v.o_orderdate,
  row_number() OVER (PARTITION BY s.model_name ORDER BY s.version DESC) AS rank,
  row_number() OVER (PARTITION BY s.model_name ORDER BY CASE WHEN s.stage = 'Production' THEN 0 ELSE 1 END, s.version DESC) AS served
  FROM staged s JOIN v ON s.model_name = v.model_name AND s.version = v.version),
late AS (SELECT c_mktsegment AS model_name, c_name AS name, c_custkey AS run_id, c_acctbal / 10000 AS weighted_f1,
  row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer)
SELECT 'serving' AS part, 1 AS rank, model_name, version::VARCHAR AS name, stage, run_id, weighted_f1 FROM h WHERE served = 1
UNION ALL SELECT 'version', rank::INTEGER, model_name, version::VARCHAR, stage, run_id, weighted_f1 FROM h
UNION ALL SELECT 'run', rank::INTEGER, model_name, name, NULL, run_id, weighted_f1 FROM late WHERE rank <= 10""")
def performance_report(spark: SparkSession, data: str) -> DataFrame:
    """Orders stand in for versions, customers for runs."""
    staged = rg.promotions(_versions(spark, data)).join(
        table(spark, data, "orders").select(F.col("o_orderkey").alias("version"), F.col("o_custkey").alias("run_id")), "version")
    runs = table(spark, data, "customer").select(
        F.col("c_custkey").alias("run_id"), F.col("c_mktsegment").alias("experiment"), F.col("c_name").alias("run_name"),
        (F.col("c_acctbal") / 10000).alias("weighted_f1"), F.col("c_acctbal").alias("start_time"))
    return rg.performance_report(staged.withColumnRenamed("f1", "weighted_f1"), runs, 10, ["weighted_f1"])
