"""Queries that keep running: a failed one starts again from its checkpoint, later each time."""

from __future__ import annotations

import heapq
import logging
import queue
import time
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from sluice.plans.tables import brief
from sluice.streaming.fanout import Started

LOG = logging.getLogger(__name__)
RESTARTS, FIRST_WAIT, LONGEST_WAIT = 5, 2.0, 300.0
#: Seconds between looks at the queries themselves, should a listener's event be lost.
LOOK = 30.0


class Endings(StreamingQueryListener):
    """Puts the run id of every ended query into a queue, and keeps those that completed a batch."""

    def __init__(self) -> None:
        self.ended: queue.Queue[str] = queue.Queue()
        self.progressed: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.progressed.add(str(event.progress.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.put(str(event.runId))


def wait_before(failures: int, first: float = FIRST_WAIT, longest: float = LONGEST_WAIT) -> float:
    """Seconds before a restart: twice as many for each failure in a row."""
    return min(first * 2 ** min(failures - 1, 60), longest)


def supervise(
    spark: SparkSession, started: Iterable[Started], limit: int = RESTARTS,
    first_wait: float = FIRST_WAIT, longest_wait: float = LONGEST_WAIT,
) -> None:
    """Wait until every query has ended for good.

    A query that fails starts again, up to ``limit`` times in a row; a completed batch ends the row. One that was
    stopped, or has read all there was, is not started again. ``error`` of an outcome is that of its last
    run, null if that one ended well, and ``restarts`` counts its restarts. The others run on meanwhile.
    """
    listener = Endings()
    spark.streams.addListener(listener)
    try:
        running = {str(o.query.runId): o for o in started if o.query is not None}
        failures = {id(o): 0 for o in running.values()}
        waiting: list[tuple[float, int, Started]] = []

        def failed(outcome: Started) -> None:
            failures[id(outcome)] += 1
            n = failures[id(outcome)]
            if n > limit:
                LOG.error("%s failed %d times in a row and stays down: %s", outcome.event_key, n, outcome.error)
                return
            wait = wait_before(n, first_wait, longest_wait)
            LOG.warning("%s starts again in %.1f s: %s", outcome.event_key, wait, outcome.error)
            heapq.heappush(waiting, (time.monotonic() + wait, id(outcome), outcome))

        def look() -> None:
            for run in [run for run, outcome in running.items() if not outcome.query.isActive]:
                outcome = running.pop(run)
                error = outcome.query.exception()
                outcome.error = None if error is None else brief(error)
                if error is not None:
                    if run in listener.progressed:
                        failures[id(outcome)] = 0
                    failed(outcome)
                listener.progressed.discard(run)

        look()
        while running or waiting:
            pause = LOOK if not waiting else min(LOOK, max(0.0, waiting[0][0] - time.monotonic()))
            try:
                listener.ended.get(timeout=pause) if pause else None
            except queue.Empty:
                pass
            look()
            while waiting and waiting[0][0] <= time.monotonic():
                outcome = heapq.heappop(waiting)[2]
                outcome.restarts += 1
                outcome.begin()
                if outcome.query is not None:
                    running[str(outcome.query.runId)] = outcome
                else:
                    failed(outcome)
    finally:
        spark.streams.removeListener(listener)
