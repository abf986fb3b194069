"""Timed retries: requests without features wait in keyed state until their timer fires."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Fixed value: seconds before the first retry; each further one waits twice as long.
RETRY_SECONDS = 0.5
#: How long a group is remembered, so that a replay is not tried again.
REMEMBERED_MS = 3_600_000
#: Requests that wait together, behind one timer.
GROUP_REQUESTS = 4096

_REQUEST = [
    T.StructField("trace_id", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("retry_count", T.LongType()),
    T.StructField("copies", T.LongType()),  # equal requests of a batch are one row
]
#: A request that found no features, and the number of the try that is due next.
MISSED = T.StructType([T.StructField("group_id", T.StringType()), *_REQUEST])


_ARROW = pa.schema(
    [(n, pa.string()) for n in ("trace_id", "entity_id", "timestamp")]
    + [(n, pa.int64()) for n in ("retry_count", "copies")]
)
_EMPTY = b""


class RetryTimer(StatefulProcessor):
    """Per group of requests: keeps them until their time has come, then hands them on.

    A group is a part of the requests that a micro-batch found no features for; its rows arrive
    together.  One that was seen already is a replay of its batch and is left out.
    """

    def __init__(self, seconds: float):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # One value for all requests of a group: a state call each would cost more than they do.
        group = T.StructType(
            [T.StructField("at", T.LongType()), T.StructField("requests", T.BinaryType())]
        )
        self._group = handle.getValueState("group", group, REMEMBERED_MS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        names = [f.name for f in _REQUEST]
        parts = [pa.Table.from_pandas(f[names], _ARROW, preserve_index=False) for f in rows]
        known = self._group.get()
        if known is not None and known[0] == now:  # more rows of the same micro-batch
            parts.append(pa.ipc.open_stream(known[1]).read_all())
        elif known is not None:
            parts = []
        if parts:
            requests = pa.concat_tables(parts)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _ARROW) as writer:
                writer.write_table(requests)
            self._group.update((now, sink.getvalue().to_pybytes()))
            if known is None and len(requests):
                tries = requests.column("retry_count")[0].as_py()
                self._handle.registerTimer(now + int(1000 * self.seconds * 2 ** (tries - 1)))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        at, requests = self._group.get()
        due = pa.ipc.open_stream(requests).read_all().to_pandas()
        due.insert(0, "group_id", key[0])
        self._group.update((at, _EMPTY))
        yield due

    def close(self) -> None:
        pass


def due_requests(missed: DataFrame, seconds: float = RETRY_SECONDS) -> DataFrame:
    """The requests of a stream of misses, each once its wait is over; no message has to follow."""
    return missed.groupBy("group_id").transformWithStateInPandas(
        statefulProcessor=RetryTimer(seconds),
        outputStructType=MISSED,
        outputMode="Append",
        timeMode="ProcessingTime",
    )
