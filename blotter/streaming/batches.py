"""Running a function per micro-batch, and supervising several streams."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from blotter.session import temporary_tables

ONCE = {"availableNow": True}
POLL = 1  # seconds before looking at the next stream


def run_batches(
    stream: DataFrame,
    step: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start ``step`` on every non-empty micro-batch, in append mode with a checkpoint.

    ``step`` may see a batch again after a failure and must bear it.
    """
    def guarded(batch: DataFrame, number: int) -> None:
        # One row of the first task that has any; isEmpty starts every task of the batch.
        if batch.select(F.lit(1)).take(1):
            with temporary_tables(batch.sparkSession):
                step(batch, number)

    writer = stream.writeStream.foreachBatch(guarded).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def run_all(
    queries: list[StreamingQuery], timeout: float | None = None, until: str = "all"
) -> None:
    """Wait until all queries have ended, or with ``until="any"`` until the first one has;
    when one fails, stop the rest and raise.

    Without a timeout this runs as long as the streams do.
    """
    deadline = None if timeout is None else time.monotonic() + timeout
    try:
        while running := [query for query in queries if query.isActive]:
            for query in running:
                query.awaitTermination(POLL)
            if until == "any" and not all(query.isActive for query in queries):
                break
            if deadline is not None and time.monotonic() > deadline:
                raise TimeoutError(f"streams still active after {timeout} s")
        for query in queries:
            if not query.isActive:
                query.awaitTermination()  # raises what ended the query, if anything did
    finally:
        for query in queries:
            query.stop()
