"""Following a query's batches and stopping it between two of them."""

from __future__ import annotations

import logging
import threading
from collections import deque
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

log = logging.getLogger(__name__)
KEPT = 1000


class BatchListener(StreamingQueryListener):
    """Logs finished batches and wakes up who waits for one; keeps the last ``KEPT``."""

    def __init__(self) -> None:
        self.batches: deque[dict] = deque(maxlen=KEPT)
        self.between = threading.Event()  # set when a batch has ended or there was none to run

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        log.info("query %s started", event.id)

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        progress = event.progress
        state = [(s.operatorName, s.numRowsTotal, s.numRowsDroppedByWatermark) for s in progress.stateOperators]
        row = {
            "id": str(progress.id), "batch": progress.batchId, "rows": progress.numInputRows,
            "ms": progress.batchDuration, "state": state,
        }
        self.batches.append(row)
        log.info("batch %s", row)
        self.between.set()

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        self.between.set()

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        log.info("query %s ended: %s", event.id, event.exception)
        self.between.set()


def run_until(
    spark: SparkSession, query: StreamingQuery, asked: Callable[[], bool], poll: float = 1.0
) -> BatchListener:
    """Let a query run until ``asked`` says so, then stop it when its running batch has ended.

    Asks every ``poll`` seconds. A batch that begins in the moment of the stop is run again by the next start, as after a crash. An error
    of the query is raised.
    """
    listener = BatchListener()
    spark.streams.addListener(listener)
    try:
        while not query.awaitTermination(poll):
            if asked():
                listener.between.clear()
                while query.isActive and query.status["isTriggerActive"] and not listener.between.wait(poll):
                    pass
                query.stop()
                break
    finally:
        spark.streams.removeListener(listener)
    return listener
