"""Streamed hourly buckets and the keyed state that places them into rings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.scalars import MONEY
from tidemark.operators.rings import Ring, reconcile
from tidemark.operators.velocity import cross_border
from tidemark.sources.tables import committed_folders, scan_table


_SEPARATOR = "\x1f"


def _hours(transfers: DataFrame, lateness: str, *keys: str) -> DataFrame:
    """Closed clock hours per key; amounts are summed as decimals, as in the batch buckets."""
    return (
        transfers.withColumn("created_at", F.col("created_at").cast("timestamp"))
        .withWatermark("created_at", lateness)
        .groupBy(*keys, F.window("created_at", "1 hour"))
        .agg(
            F.count("*").alias("tx_count"),
            F.sum(F.col("source_amount").cast(MONEY)).alias("amount_sum"),
            F.max("source_amount").alias("amount_max"),
            F.sum(cross_border()).alias("cross_border_count"),
        )
    )


def _bucket() -> Column:
    return F.floor(F.unix_seconds("window.start") / 3600).cast("bigint").alias("bucket")


def hourly_tumbling(transfers: DataFrame, lateness: str) -> DataFrame:
    """One aggregate per sender and closed clock hour.

    Transfers that come later than ``lateness`` behind the newest one are left out; ``reconcile``
    finds the hours they belong to.
    """
    return _hours(transfers, lateness, "sender_id").select(
        F.col("sender_id").alias("user_id"),
        _bucket(),
        "tx_count",
        F.col("amount_sum").cast("double").alias("amount_sum"),
        "amount_max",
        "cross_border_count",
    )


def closed_buckets(transfers: DataFrame, lateness: str) -> DataFrame:
    """One row per sender and closed clock hour, with its distinct recipients.

    A hot sender combines to its distinct recipients before it meets in one bucket.
    """
    parts = _hours(transfers, lateness, "sender_id", "recipient_id")
    return (
        parts.groupBy("sender_id", F.window(F.window_time("window"), "1 hour"))
        .agg(
            F.sum("tx_count").alias("tx_count"),
            F.sum("amount_sum").cast("double").alias("amount_sum"),
            F.max("amount_max").alias("amount_max"),
            F.sum("cross_border_count").cast("bigint").alias("cross_border_count"),
            F.sort_array(F.collect_set("recipient_id")).alias("recipients"),
        )
        .select(
            F.col("sender_id").alias("user_id"),
            _bucket(),
            "tx_count",
            F.coalesce("amount_sum", F.lit(0.0)).alias("amount_sum"),
            F.coalesce("amount_max", F.lit(0.0)).alias("amount_max"),
            "cross_border_count",
            F.array_join("recipients", _SEPARATOR).alias("recipients"),
        )
    )


_TOTALS = [
    T.StructField("bucket", T.LongType()),
    T.StructField("tx_count", T.LongType()),
    T.StructField("amount_sum", T.DoubleType()),
    T.StructField("amount_max", T.DoubleType()),
    T.StructField("cross_border_count", T.LongType()),
]
_SLOT = T.StructType([*_TOTALS, T.StructField("recipients", T.StringType())])

#: Users are kept in this many groups, by the hash of their id.
GROUPS = 1024

_ARROW = pa.schema(
    [("user_id", pa.string())]
    + [(n, pa.int64()) for n in ("slot", "bucket", "tx_count")]
    + [(n, pa.float64()) for n in ("amount_sum", "amount_max")]
    + [("cross_border_count", pa.int64()), ("recipients", pa.string())]
)


class RingState(StatefulProcessor):
    """Per group of users: the newest bucket of every user's slots.  Expiry is the reader's business.

    The hours of all users close together, so a micro-batch brings many users of a group.  Their
    slots are one state value: a state call for each slot would cost more than they do.
    """

    def __init__(self, slots: int):
        self.slots = slots

    def init(self, handle: StatefulProcessorHandle) -> None:
        group = T.StructType([T.StructField("rings", T.BinaryType())])
        self._group = handle.getValueState("group", group)

    def _kept(self) -> list[pd.DataFrame]:
        known = self._group.get()
        return [] if known is None else [pa.ipc.open_stream(known[0]).read_all().to_pandas()]

    def _keep(self, slots: pd.DataFrame) -> None:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _ARROW) as writer:
            writer.write_table(pa.Table.from_pandas(slots, _ARROW, preserve_index=False))
        self._group.update((sink.getvalue().to_pybytes(),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        came = pd.concat(list(rows))
        came["slot"] = came["bucket"] % self.slots
        parts = [part.assign(_came=False) for part in self._kept()] + [came.assign(_came=True)]
        slots = pd.concat([part[[*_ARROW.names, "_came"]] for part in parts])
        # A bucket closes once; one of an earlier lap comes too late for its slot.
        newest = slots.sort_values("bucket", ascending=False, kind="stable")
        newest = newest.drop_duplicates(["user_id", "slot"])
        touched = newest["user_id"].isin(newest.loc[newest["_came"], "user_id"])
        if touched.any():
            self._keep(newest[_ARROW.names])
            yield self._emitted(newest.loc[touched, _ARROW.names])

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """The rings that a batch has computed; buckets they have are not taken from the stream."""
        self._keep(pd.concat([*self._kept(), initialState[_ARROW.names]]))

    @staticmethod
    def _emitted(slots: pd.DataFrame) -> pd.DataFrame:
        """The users' whole rings, one row per written slot."""
        lists = [text.split(_SEPARATOR) if text else [] for text in slots["recipients"]]
        return slots.assign(recipients=lists)

    def close(self) -> None:
        pass


def ring_state(buckets: DataFrame, ring: Ring, start: DataFrame | None = None) -> DataFrame:
    """Rings of the users whose buckets closed in a micro-batch, as slot rows.

    The state of a new query can ``start`` from slot rows that a batch has computed.
    """
    user_type = buckets.schema["user_id"].dataType
    schema = T.StructType(
        [
            T.StructField("user_id", T.StringType()),
            T.StructField("slot", T.LongType()),
            *_TOTALS,
            T.StructField("recipients", T.ArrayType(T.StringType())),
        ]
    )

    def grouped(rows: DataFrame, *columns):
        group = F.pmod(F.xxhash64(F.col("user_id").cast(user_type)), F.lit(GROUPS))
        user = F.col("user_id").cast(user_type).cast("string").alias("user_id")
        return rows.select(group.alias("group_id"), user, *columns).groupBy("group_id")

    initial = None
    totals = [f.name for f in _TOTALS]
    if start is not None:
        recipients = F.array_join("recipients", _SEPARATOR).alias("recipients")
        initial = grouped(start, "slot", *totals, recipients)
    emitted = grouped(buckets, *totals, "recipients").transformWithStateInPandas(
        statefulProcessor=RingState(ring.slots),
        outputStructType=schema,
        outputMode="Append",
        timeMode="None",
        initialState=initial,
    )
    return emitted.withColumn("user_id", F.col("user_id").cast(user_type))


def latest_rings(emitted: DataFrame) -> DataFrame:
    """The last ring emitted per user; ``emitted`` carries the ``batch_id`` that wrote it."""
    newest = emitted.groupBy("user_id").agg(F.max("batch_id").alias("batch_id"))
    return emitted.join(newest, ["user_id", "batch_id"], "left_semi").drop("batch_id")


@dataclass
class RingStream:
    """Live rings that a batch can repair.

    The batch is the truth.  ``repair`` writes its rings as the start of the next run: readers turn
    to that run at once, and the query started next keeps its state from there.  Every run has
    checkpoints of its own, so what a stream had wrong is neither read nor kept.  The messages
    since the batch can be read again: a bucket that the batch has seen is not taken twice.
    """

    ring: Ring
    path: str
    marks: str

    def run(self, spark: SparkSession) -> int:
        """The number of the newest run whose start is whole; run 0 starts from nothing."""
        starts = committed_folders(spark, f"{self.path}/start")
        return max((int(name.split("-")[1]) for name in starts), default=0)

    def _start_of(self, spark: SparkSession, run: int) -> DataFrame | None:
        return scan_table(spark, f"{self.path}/start/run-{run:06d}")

    def start(self, transfers: DataFrame, lateness: str, every: str | None = None):
        """The query that keeps the rings of the newest run."""
        spark = transfers.sparkSession
        run = self.run(spark)
        folder = f"{self.path}/run-{run:06d}"

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

        closed = closed_buckets(transfers, lateness)
        trigger = {"availableNow": True} if every is None else {"processingTime": every}
        return (
            ring_state(closed, self.ring, self._start_of(spark, run))
            .writeStream.foreachBatch(write)
            .outputMode("append")
            .option("checkpointLocation", f"{self.marks}/run-{run:06d}")
            .trigger(**trigger)
            .start()
        )

    def latest(self, spark: SparkSession) -> DataFrame | None:
        """Slot rows of the newest run: as last emitted, else as it started."""
        run = self.run(spark)
        emitted = scan_table(spark, f"{self.path}/run-{run:06d}")
        rows = [] if emitted is None else [emitted]
        start = self._start_of(spark, run)
        if start is not None:
            rows.append(start.withColumn("batch_id", F.lit(-1)))
        if not rows:
            return None
        whole = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
        return latest_rings(whole)

    def differences(self, spark: SparkSession, truth: DataFrame) -> DataFrame:
        """Slots in which the live rings differ from the batch's, and how."""
        columns = ["user_id", "slot", *_SLOT.fieldNames()]
        live = self.latest(spark)
        truth = truth.select(*columns)
        live = truth.limit(0) if live is None else live.select(*columns)
        return reconcile(live, truth, ["user_id", "slot"])

    def repair(self, spark: SparkSession, truth: DataFrame) -> int:
        """Make the batch's rings the start of a new run, and return its number.

        The query of the run before has to be stopped; the next ``start`` goes on from here.
        """
        run = self.run(spark) + 1
        columns = ["user_id", "slot", *_SLOT.fieldNames()]
        truth.select(*columns).write.mode("overwrite").parquet(f"{self.path}/start/run-{run:06d}")
        return run
