"""Access log: lines to columns, and a summary per endpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import quantiles

# --- fixed value: the log line format ------------------------------------------
LINE = (r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) \| (\w+) \| (\w+) (\S+) "
        r"status=(\d{3}) client=(\S+) time_ms=([0-9.]+)$")


def parse(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row per line; lines of another shape give nulls and ``matched`` false."""
    col = F.col(value)
    matched = col.rlike(LINE)

    def part(i: int):
        return F.when(matched, F.regexp_extract(col, LINE, i))

    return lines.select(
        F.to_timestamp(F.translate(part(1), ",", "."), "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"),
        part(2).alias("level"), part(3).alias("method"), part(4).alias("path"),
        part(5).cast("int").alias("status"), part(6).alias("client"),
        part(7).cast("double").alias("time_ms"), matched.alias("matched"))


def read(spark: SparkSession, path: str) -> DataFrame:
    return parse(spark.read.text(path))


def endpoint_summary(log: DataFrame) -> DataFrame:
    """Requests, median, 95th percentile and maximum time per endpoint and status.

    Percentiles are exact; a busy endpoint is spread over tasks (see ``ordered``).
    """
    lines = log.filter("matched")
    times = quantiles(lines, "time_ms", {"median_ms": 0.5, "p95_ms": 0.95}, ["path", "status"])
    most = lines.groupBy("path", "status").agg(F.max("time_ms").alias("max_ms"))
    return times.join(most, ["path", "status"]).select(
        "path", "status", F.col("n").alias("requests"), F.round("median_ms", 6).alias("median_ms"),
        F.round("p95_ms", 6).alias("p95_ms"), "max_ms")
