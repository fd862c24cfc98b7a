"""Rows that a running query has left out because they came too late."""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class LateRows(StreamingQueryListener):
    """Counts late rows of all queries of a session: those that windows, joins and other
    operators of Spark drop, and those that the keyed state of this library leaves out. What
    reaches a window has been aggregated within its task, so there a group counts as one."""

    def __init__(self, spark: SparkSession):
        self.counts: dict[str, Counter] = {}
        self.lock = threading.Lock()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self.lock:
            counts = self.counts.setdefault(str(progress.id), Counter())
            for operator in progress.stateOperators:
                counts[operator.operatorName] += operator.numRowsDroppedByWatermark
            for name, row in progress.observedMetrics.items():
                if name.startswith("late_"):
                    counts[name] += row["late"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query: StreamingQuery) -> dict[str, int]:
        """Late rows by operator, for the batches reported so far."""
        with self.lock:
            return {name: n for name, n in self.counts.get(str(query.id), Counter()).items() if n}

    def total(self, query: StreamingQuery) -> int:
        return sum(self.of(query).values())
