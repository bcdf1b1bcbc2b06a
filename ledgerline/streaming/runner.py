"""Start, drain and inspect the streaming demand query.

The original used ``trigger(once=True)`` with append output on a fresh
checkpoint, which processes one batch with the watermark still at the epoch
and therefore never emits a window. ``availableNow`` processes the backlog
in rate-limited batches and then runs the no-data batch that advances the
watermark, so every window that the watermark has closed is written.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerline.streaming.demand import windowed_demand
from ledgerline.params import RetailParams


POLL_S = 0.2


@dataclass
class StreamResult:
    sink_path: str
    checkpoint_path: str
    batches: int | None
    input_rows: int | None
    rows_dropped_by_watermark: int | None
    finished: bool = True


def run_demand_stream(
    stream: DataFrame,
    sink_path: str,
    checkpoint_path: str,
    window: str = "1 minute",
    watermark: str = "5 minutes",
    params: RetailParams = RetailParams(),
    timeout_s: float | None = None,
    on_timeout: str = "raise",
) -> StreamResult:
    """Run windowed demand over ``stream`` into a Parquet sink (append).

    The backlog is drained however long it takes; with ``timeout_s`` the query is
    stopped when it is not done by then, and a ``TimeoutError`` is raised or, with
    ``on_timeout="return"``, what was committed so far is reported with
    ``finished`` false. A failed query re-raises its exception. Progress is resumable:
    rerunning on the same checkpoint reads only files not seen before. If the stop
    falls between a batch and the no-data batch behind it, a rerun plans no batch until
    new files arrive; the windows that the watermark has closed stay in the state, and
    are written with the next batch.

    Counts are gathered while the query runs, by batch. Spark keeps the reports
    of recent batches only: if some were gone before they were read, the counts
    are None, never too small.
    """
    windows = windowed_demand(stream, window=window, watermark=watermark, params=params)
    query = (
        windows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    seen: dict[int, dict] = {}
    end = None if timeout_s is None else time.monotonic() + timeout_s
    finished = False
    while not finished:
        left = POLL_S if end is None else min(POLL_S, end - time.monotonic())
        finished = query.awaitTermination(max(left, 0.001))
        seen.update((p["batchId"], p) for p in query.recentProgress)
        if not finished and end is not None and time.monotonic() > end:
            query.stop()
            if on_timeout == "raise":
                raise TimeoutError(f"stream did not drain within {timeout_s}s")
            seen.update((p["batchId"], p) for p in query.recentProgress)
            break
    if finished and query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    if seen and max(seen) - min(seen) + 1 != len(seen):
        return StreamResult(sink_path, checkpoint_path, None, None, None, finished)
    rows = sum(int(p.get("numInputRows") or 0) for p in seen.values())
    late = sum(
        int(op.get("numRowsDroppedByWatermark") or 0)
        for p in seen.values()
        for op in p.get("stateOperators") or []
    )
    return StreamResult(sink_path, checkpoint_path, len(seen), rows, late, finished)
