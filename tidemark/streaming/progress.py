"""Metrics of triggers: what Spark reports of each one, in the table form of the stage metrics."""

from __future__ import annotations

import threading
import uuid
from collections import deque
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.streaming.metrics import LATENCY, SAMPLED, samples

#: Triggers whose samples are written together, and samples kept while the table cannot be written.
FLUSH_TRIGGERS, MOST_KEPT = 20, 100_000

#: Seconds to wait for the last events of a query that has ended; they come on another thread.
LAST_EVENTS = 30.0


class ProgressMetrics(StreamingQueryListener):
    """Listens to streaming queries and adds a sample for all that a trigger did.

    Stage ``trigger`` counts triggers, rows read, rows kept as state and rows dropped for being
    late; every phase of a trigger is a stage with its latency, one for each trigger, in the bins
    of ``stage_latency``; and what a query observes (``DataFrame.observe``) is a stage named after
    the observation.  Only queries that are followed are sampled.

    A failure to write ends no query: its samples stay for the next attempt.
    """

    def __init__(self, spark: SparkSession, path: str, flush_triggers: int = FLUSH_TRIGGERS):
        self._spark, self._path, self._every = spark, path, flush_triggers
        self._jobs: dict[str, str] = {}
        self._kept: deque[tuple] = deque(maxlen=MOST_KEPT)
        self._triggers = 0
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}
        spark.streams.addListener(self)

    def follow(self, query: StreamingQuery, job: str) -> StreamingQuery:
        """Sample ``query`` (its first triggers, too) under the name ``job``."""
        with self._lock:
            self._jobs[str(query.runId)] = job
            self._ended.setdefault(str(query.runId), threading.Event())
        return query

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run, at = str(progress.runId), datetime.fromisoformat(progress.timestamp)
        counted = {
            "triggers": 1,
            "rows_in": progress.numInputRows,
            "state_rows": sum(s.numRowsUpdated for s in progress.stateOperators),
            "late_rows": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
        }
        made = [("trigger", name, None, float(n)) for name, n in counted.items()]
        for phase, milliseconds in progress.durationMs.items():
            made.append((phase, LATENCY, milliseconds / 1000, 1.0))
        for stage, row in progress.observedMetrics.items():
            made += [
                (stage, name, None, float(n))
                for name, n in row.asDict().items()
                if isinstance(n, int | float)
            ]
        with self._lock:
            self._kept.extend((at, run, *one) for one in made)
            self._triggers += 1
            due = self._triggers % self._every == 0
        if due:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.setdefault(str(event.runId), threading.Event()).set()

    def flush(self) -> None:
        """Write the samples of all followed queries."""
        with self._lock:
            rows = [(at, self._jobs[run], *rest) for at, run, *rest in self._kept if run in self._jobs]
            if rows:
                made = samples(self._spark.createDataFrame(rows, SAMPLED))
                made.coalesce(1).write.parquet(f"{self._path}/flush-{uuid.uuid4().hex}")
            # A query may be followed only after its first trigger.
            others = [one for one in self._kept if one[1] not in self._jobs and not self._over(one[1])]
            self._kept.clear()
            self._kept.extend(others)

    def _over(self, run: str) -> bool:
        return run in self._ended and self._ended[run].is_set()

    def close(self) -> None:
        """Wait for the last events of followed queries that have ended, write, stop listening."""
        active = {str(q.runId) for q in self._spark.streams.active}
        for run in self._jobs.keys() - active:
            self._ended[run].wait(LAST_EVENTS)
        self._spark.streams.removeListener(self)
        self.flush()
