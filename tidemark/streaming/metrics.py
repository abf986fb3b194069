"""Stage metrics of the streams: counters, and latency histograms that merge by addition."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Latency bins per factor of ten.  Bin b holds latencies up to 10 ** (b / 10) seconds, so a
#: percentile read from bins is too large by a quarter at most.
BINS, LOWEST, HIGHEST = 10, -60, 60

LATENCY = "latency"
COUNTERS = ("success", "missing", "error", "retry")


def latency_bin(seconds: Column) -> Column:
    """The number of the bin that a latency falls into; all bins are known in advance."""
    number = F.ceil(F.log10(F.greatest(seconds, F.lit(1e-9))) * BINS)
    return F.least(F.greatest(number, F.lit(LOWEST)), F.lit(HIGHEST)).cast("int")


@dataclass
class StageMetrics:
    """What a micro-batch did, stage by stage; ``write`` adds it to the metrics table."""

    job: str
    counts: dict[tuple[str, str], int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def stage(self, name: str) -> Iterator[None]:
        began = time.monotonic()
        try:
            yield
        finally:
            self.seconds[name] = self.seconds.get(name, 0.0) + time.monotonic() - began

    def add(self, stage: str, counts: Mapping[str, int]) -> None:
        for name, n in counts.items():
            self.counts[stage, name] = self.counts.get((stage, name), 0) + (n or 0)

    def write(self, spark: SparkSession, path: str, batch_id: int, now: Column) -> None:
        """One sample per counter, and one per latency bin; a replayed batch replaces its own.

        All rows of a stage share its wall time: each waited for the whole micro-batch.
        """
        rows = [(stage, name, None, float(n)) for (stage, name), n in self.counts.items()]
        for stage, seconds in self.seconds.items():
            through = sum(n for (of, _), n in self.counts.items() if of == stage)
            if through:
                rows.append((stage, LATENCY, seconds, float(through)))
        made = spark.createDataFrame(
            [(None, self.job, *row) for row in rows], SAMPLED
        ).withColumn("ts", now.cast("timestamp"))
        samples(made).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


#: What a stage reports: a counter's value, or (with ``seconds``) how many waited so long.
SAMPLED = "ts timestamp, job string, stage string, name string, seconds double, value double"


def samples(sampled: DataFrame) -> DataFrame:
    """Rows of the metrics table: labels are job, stage and, for latencies, the bin."""
    labels = {"job": F.col("job"), "stage": F.col("stage")}
    plain = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), v)])
    bins = F.create_map(F.lit("bin"), latency_bin(F.col("seconds")).cast("string"))
    labelled = F.when(F.col("seconds").isNull(), plain).otherwise(F.map_concat(plain, bins))
    return sampled.select("ts", "name", labelled.alias("labels"), "value")


def stage_counts(samples: DataFrame) -> DataFrame:
    """Counters per job, stage and name, summed over all micro-batches."""
    return (
        samples.where(F.col("name") != LATENCY)
        .groupBy(F.col("labels.job").alias("job"), F.col("labels.stage").alias("stage"), "name")
        .agg(F.sum("value").alias("total"))
    )


def stage_latency(samples: DataFrame, shares: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Per job and stage, the upper border of the bin in which each share of the rows is reached.

    Bins of any number of micro-batches, executors or runs are added; there are at most 121 a
    stage, whatever the number of rows.
    """
    bins = (
        samples.where(F.col("name") == LATENCY)
        .groupBy(
            F.col("labels.job").alias("job"),
            F.col("labels.stage").alias("stage"),
            F.col("labels.bin").cast("int").alias("bin"),
        )
        .agg(F.sum("value").alias("rows"))
    )
    stage = Window.partitionBy("job", "stage")
    upto = F.sum("rows").over(stage.orderBy("bin"))
    placed = bins.withColumns({"_upto": upto, "_all": F.sum("rows").over(stage)})
    reached = [
        F.min(F.when(F.col("_upto") >= share * F.col("_all"), F.pow(F.lit(10.0), F.col("bin") / BINS)))
        .alias(f"p{round(100 * share)}")
        for share in shares
    ]
    return placed.groupBy("job", "stage").agg(F.sum("rows").alias("rows"), *reached)
