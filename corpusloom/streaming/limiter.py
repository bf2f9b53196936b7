"""Per-client request limit on a stream: a sliding log kept as state."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.ratelimit import WINDOW_SECONDS

_OUT = "user_id bigint, event_id bigint, t bigint, admitted boolean"


def limit_stream(events: DataFrame, limit: int, seconds: int = WINDOW_SECONDS, lateness: str = "1 minute") -> DataFrame:
    """``user_id, event_id, t, admitted``; refused calls are not recorded.

    The state of a client is the times of its admitted calls in the last
    window: at most ``limit`` numbers.  Rows are replayed in time order within
    a micro-batch.  State of silent clients expires with the watermark.
    """
    span = seconds * 1_000_000

    def replay(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        log = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches)).sort_values(["t", "event_id"])  # one client in one micro-batch
        verdicts = []
        for t in rows["t"]:
            log = [x for x in log if t - x <= span]
            ok = len(log) < limit
            if ok:
                log.append(int(t))
            verdicts.append(ok)
        state.update((log,))
        state.setTimeoutTimestamp(max(int(rows["t"].max()) // 1000 + seconds * 1000 + 1,
                                      state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"user_id": key[0], "event_id": rows["event_id"], "t": rows["t"], "admitted": verdicts})

    timed = (events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
             .withColumn("t", F.unix_micros("ts")).select("user_id", "event_id", "ts", "t"))
    return timed.groupBy("user_id").applyInPandasWithState(
        replay, _OUT, "log array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)
