"""Pacing and timing out micro-batches, and keeping their metrics."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

GROUP = "spark.jobGroup.id"


class BatchTimeout(TimeoutError):
    """A micro-batch that took longer than it may."""


def paced(
    commit: Callable[[DataFrame, int], None], timeout: float | None = None, min_pause: float = 0.0
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps to its time.

    Between the end of a batch and the work of the next lie ``min_pause`` seconds at least. A batch
    that runs for over ``timeout`` seconds has its Spark jobs cancelled and fails with
    ``BatchTimeout``, so the query stops with that reason; on restart the batch comes again.
    """
    ended: list[float] = []

    def run(batch: DataFrame, number: int) -> None:
        if ended:
            time.sleep(max(0.0, min_pause - (time.monotonic() - ended[-1])))
        context = batch.sparkSession.sparkContext
        group = context.getLocalProperty(GROUP)
        over = threading.Event()

        def cancel() -> None:
            over.set()
            while not done.wait(0.2):  # jobs that start after the first call go as well
                context.cancelJobGroup(group)

        done = threading.Event()
        timer = threading.Timer(timeout, cancel) if timeout is not None else None
        try:
            if timer is not None:
                timer.start()
            commit(batch, number)
        except Exception as error:
            if over.is_set():
                raise BatchTimeout(f"batch {number} took over {timeout} s") from error
            raise
        finally:
            done.set()
            if timer is not None:
                timer.cancel()
            ended[:] = [time.monotonic()]
        if over.is_set():
            raise BatchTimeout(f"batch {number} took over {timeout} s")

    return run


def observed(stream: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """``stream`` with aggregates of every batch, computed on the way; by default its rows."""
    return stream.observe(name, *(metrics or (F.count(F.lit(1)).alias("rows"),)))


class BatchLog(StreamingQueryListener):
    """The last batches of queries: number, duration in milliseconds, rows, observed metrics.

    Register it with ``spark.streams.addListener``. Why a query ended is in ``reasons``, by its id.
    """

    def __init__(self, keep: int = 1_000):
        self.batches: deque = deque(maxlen=keep)
        self.reasons: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = {name: row.asDict() for name, row in p.observedMetrics.items()}
        self.batches.append((str(p.id), p.batchId, p.batchDuration, p.numInputRows, seen))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.reasons[str(event.id)] = event.exception
