"""Request metrics per time window; the same plan for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_metrics(events: DataFrame, by: str = "event_type", value: str = "value", ts: str = "ts",
                     width: str = "1 minute", lateness: str | None = None) -> DataFrame:
    """Count, sum and maximum per window and group.

    With ``lateness`` the event time carries a watermark, so a stream emits
    finished windows and drops rows that come later than that.
    """
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if lateness:
        timed = timed.withWatermark("_ts", lateness)
    return (timed.groupBy(F.window("_ts", width).alias("w"), by)
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 6).alias("total"),
                 F.max(value).alias("highest"))
            .select(F.col("w.start").alias("window_start"), by, "n", "total", "highest"))
