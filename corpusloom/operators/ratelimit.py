"""Per-client request limits: sliding counts and exact admission."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW_SECONDS = 60
BLOCK_SECONDS = 900


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def sliding_count(events: DataFrame, key: str = "user_id", ts: str = "ts", event_id: str = "event_id",
                  seconds: int = WINDOW_SECONDS, block: int = BLOCK_SECONDS) -> DataFrame:
    """Adds ``recent``: the client's requests in the last ``seconds``, itself included.

    Time is cut into blocks and each block also sees the tail of the one
    before it, so a client with a large share of all requests is counted in
    many tasks at once.
    """
    span, width = seconds * 1_000_000, block * 1_000_000
    if span > width:
        raise ValueError("the block must be at least as long as the window")
    t = events.withColumn("_t", _micros(F.col(ts)))
    own = F.floor(F.col("_t") / width)
    tail = F.floor((F.col("_t") + span) / width)
    copies = F.when(tail > own, F.array(own, tail)).otherwise(F.array(own))
    spread = t.withColumn("_own", own).withColumn("_block", F.explode(copies))
    window = Window.partitionBy(key, "_block").orderBy("_t").rangeBetween(-span, 0)
    return (spread.withColumn("recent", F.count(F.lit(1)).over(window))
            .filter(F.col("_own") == F.col("_block")).drop("_t", "_own", "_block"))


def admissions(events: DataFrame, limit: int, key: str = "user_id", ts: str = "ts",
               event_id: str = "event_id", seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Adds ``admitted``: replays the sliding log, where refused calls are not recorded.

    A request is refused if ``limit`` admitted ones lie in the last
    ``seconds`` (one exactly that old still counts).  A request with no other
    in the window before it finds an empty log, whatever came earlier: the
    history is cut there, so even one client's requests spread over tasks.
    Each task streams its sorted rows and holds at most ``limit`` times.
    """
    span = seconds * 1_000_000
    counted = sliding_count(events, key, ts, event_id, seconds).withColumn("_t", _micros(F.col(ts)))
    segmented = _segment_ids(counted.withColumn("_start", F.col("recent") == 1), key)
    names = events.columns
    schema = segmented.select(*names).schema.add("admitted", "boolean")

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, log = None, deque()
        for batch in batches:
            verdicts = []
            for k, s, t in zip(batch[key], batch["_segment"], batch["_t"]):
                if (k, s) != current:
                    current, log = (k, s), deque()
                while log and t - log[0] > span:
                    log.popleft()
                ok = len(log) < limit
                if ok:
                    log.append(t)
                verdicts.append(ok)
            out = batch[names].copy()
            out["admitted"] = verdicts
            yield out

    placed = segmented.repartition(key, "_segment").sortWithinPartitions(key, "_segment", "_t", event_id)
    return placed.mapInPandas(replay, schema)


def _segment_ids(rows: DataFrame, key: str, block: int = BLOCK_SECONDS) -> DataFrame:
    """Adds ``_segment``: the time of the last start at or before the row.

    Looked up inside blocks of time, then carried over from the last earlier
    block that has a start (a table of one row per client and block).
    """
    width = block * 1_000_000
    b = rows.withColumn("_block", F.floor(F.col("_t") / width))
    start_at = F.when(F.col("_start"), F.col("_t"))
    upto = Window.partitionBy(key, "_block").orderBy("_t").rangeBetween(Window.unboundedPreceding, 0)
    inside = b.withColumn("_here", F.max(start_at).over(upto))
    per_block = b.groupBy(key, "_block").agg(F.max(start_at).alias("_last"))
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(key, "_block", F.max("_last").over(before).alias("_carried"))
    return (inside.join(carried, [key, "_block"])
            .withColumn("_segment", F.coalesce("_here", "_carried", F.lit(-1).cast("long")))
            .drop("_block", "_here", "_carried", "_start", "recent"))
