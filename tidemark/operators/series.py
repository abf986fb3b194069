"""Analytics over a metrics table ``(ts, name, labels, value)``: rates, holds, alerts, cost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_divide, unix_second
from tidemark.operators.ordered import exact_quantiles, previous_value

MINUTE = 60

# Alert limits.
ERROR_RATIO_LIMIT = 0.05
LATENCY_LIMIT_MS = 1000.0
FETCH_TROUBLE_LIMIT = 10.0
PREDICT_RETRY_LIMIT = 5.0
DROPOFF_LIMIT = 0.1
TRAILING_FACTOR = 2.0
BACKLOG_LIMIT = 10_000.0

# Unit prices in USD.
PRICES = {
    "vcpu_hour": 0.069,
    "ram_gb_hour": 0.003,
    "instance_second": 0.000024,
    "published_message": 0.04 / 1e6,
    "store_read": 0.26 / 1e6,
    "store_write": 0.26 / 1e6,
    "insert_mb": 0.01 / 200,
}


def label(name: str) -> Column:
    return F.col("labels").getItem(name)


def with_labels(samples: DataFrame, names: Sequence[str]) -> DataFrame:
    return samples.select("ts", "name", "value", *[label(n).alias(n) for n in names])


def step_start(ts: Column, seconds: int) -> Column:
    """Start of the aligned step a time belongs to, in epoch seconds."""
    return (F.floor(unix_second(ts) / seconds) * seconds).cast("bigint")


def counter_increase(samples: DataFrame, series: Sequence[str]) -> DataFrame:
    """Growth of a counter since its previous sample; after a reset, the value itself.

    The first sample of a series has no growth.  A series is the metric name plus ``series``.
    """
    day = F.floor(unix_second(F.col("ts")) / 86_400)
    paired = previous_value(
        samples, ["name", *series], [day], ["ts", "value"], F.col("value"), "_before"
    )
    grown = F.col("value") - F.col("_before")
    increase = (
        F.when(F.col("_before").isNull(), 0.0)
        .when(F.col("value") < F.col("_before"), F.col("value"))
        .otherwise(grown)
    )
    return paired.withColumn("increase", increase).drop("_before")


def counter_rate(
    increases: DataFrame, by: Sequence[str], window_seconds: int = 5 * MINUTE
) -> DataFrame:
    """Per-second growth per aligned window, summed over the series of each label set.

    Growth is not extrapolated to the window edges.
    """
    step = step_start(F.col("ts"), window_seconds).alias("window_start")
    rate = (F.sum("increase") / window_seconds).alias("rate")
    return increases.groupBy(*by, step).agg(rate)


def error_ratio(
    increases: DataFrame,
    is_error: Column,
    window_seconds: int = 5 * MINUTE,
    limit: float = ERROR_RATIO_LIMIT,
) -> DataFrame:
    """Failed share of the request rate per window."""
    step = step_start(F.col("ts"), window_seconds).alias("window_start")
    failed = F.sum(F.when(is_error, F.col("increase")).otherwise(0.0))
    shares = increases.groupBy(step).agg(safe_divide(failed, F.sum("increase")).alias("ratio"))
    return shares.withColumn("firing", F.coalesce(F.col("ratio") > limit, F.lit(False)))


def step_spine(samples: DataFrame, step_seconds: int) -> DataFrame:
    """Every step between the first and the last sample."""
    step = step_start(F.col("ts"), step_seconds)
    span = samples.agg(F.min(step).alias("lo"), F.max(step).alias("hi"))
    return span.select(
        F.explode(F.sequence("lo", "hi", F.lit(step_seconds).cast("bigint"))).alias("window_start")
    )


def no_flow(
    samples: DataFrame, increases: DataFrame, window_seconds: int = 10 * MINUTE
) -> DataFrame:
    """Every window of the observed span with its rate, and whether nothing flowed."""
    rates = counter_rate(increases, [], window_seconds)
    return (
        step_spine(samples, window_seconds)
        .join(rates, "window_start", "left")
        .withColumn("rate", F.coalesce("rate", F.lit(0.0)))
        .withColumn("firing", F.col("rate") == 0)
    )


def held(
    steps: DataFrame, keys: Sequence[str], condition: str, step_seconds: int, hold_seconds: int
) -> DataFrame:
    """Runs of consecutive steps with a true condition that last at least ``hold_seconds``.

    ``steps`` has one row per key and step, so a run is bounded by time, not by data volume.
    """
    order = Window.partitionBy(*keys).orderBy("window_start")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("window_start").over(order)
    # Among true steps a new run starts wherever the step before is not the adjacent one.
    starts = F.when(F.col("window_start") - before == step_seconds, 0).otherwise(1)
    return (
        steps.where(F.col(condition))
        .withColumn("_start", starts)
        .withColumn("_run", F.sum("_start").over(upto))
        .groupBy(*keys, "_run")
        .agg(
            F.min("window_start").alias("run_start"),
            (F.max("window_start") + step_seconds).alias("run_end"),
            F.count("*").alias("steps"),
        )
        .where(F.col("run_end") - F.col("run_start") >= hold_seconds)
        .drop("_run")
    )


def latency_summary(
    samples: DataFrame, by: Sequence[str], limit: float = LATENCY_LIMIT_MS
) -> DataFrame:
    summary = samples.groupBy(*by).agg(
        F.avg("value").alias("mean_ms"), F.max("value").alias("max_ms")
    )
    return summary.withColumn("firing", F.col("mean_ms") > limit)


def failure_spike(
    increases: DataFrame,
    failure: str,
    retry: str,
    window_seconds: int = 5 * MINUTE,
    trouble_limit: float = FETCH_TROUBLE_LIMIT,
    retry_limit: float = PREDICT_RETRY_LIMIT,
) -> DataFrame:
    """Failure and retry rates per window with both alert conditions."""
    step = step_start(F.col("ts"), window_seconds).alias("window_start")

    def rate(name: str) -> Column:
        return F.sum(F.when(F.col("name") == name, F.col("increase")).otherwise(0.0)) / (
            window_seconds
        )

    rates = (
        increases.where(F.col("name").isin(failure, retry))
        .groupBy(step)
        .agg(rate(failure).alias("failure_rate"), rate(retry).alias("retry_rate"))
    )
    return rates.withColumns(
        {
            "trouble_firing": F.col("failure_rate") + F.col("retry_rate") > trouble_limit,
            "retry_firing": F.col("retry_rate") > retry_limit,
        }
    )


def stage_dropoff(
    increases: DataFrame,
    parsed: str,
    fetched: str,
    window_seconds: int = 5 * MINUTE,
    limit: float = DROPOFF_LIMIT,
) -> DataFrame:
    """(parse rate - fetch rate) / (parse rate + 1) per window."""
    step = step_start(F.col("ts"), window_seconds).alias("window_start")

    def rate(name: str) -> Column:
        return F.sum(F.when(F.col("name") == name, F.col("increase")).otherwise(0.0)) / (
            window_seconds
        )

    ratio = (F.col("_p") - F.col("_f")) / (F.col("_p") + 1)
    return (
        increases.where(F.col("name").isin(parsed, fetched))
        .groupBy(step)
        .agg(rate(parsed).alias("_p"), rate(fetched).alias("_f"))
        .select("window_start", ratio.alias("dropoff"), (ratio > limit).alias("firing"))
    )


def versus_trailing_average(
    samples: DataFrame, hours: int = 168, factor: float = TRAILING_FACTOR
) -> DataFrame:
    """Hourly mean against the mean of the hourly means of the last ``hours`` hours."""
    hour = F.floor(unix_second(F.col("ts")) / 3600).alias("hour")
    hourly = samples.groupBy(hour).agg(F.avg("value").alias("current"))
    # One row per hour of history meets here, whatever the number of samples.
    trailing = Window.orderBy("hour").rangeBetween(-(hours - 1), 0)
    return hourly.withColumn("trailing", F.avg("current").over(trailing)).withColumn(
        "firing", F.col("current") > F.col("trailing") * factor
    )


def backlog(
    samples: DataFrame,
    step_seconds: int = 5 * MINUTE,
    limit: float = BACKLOG_LIMIT,
    hold_seconds: int = 15 * MINUTE,
) -> DataFrame:
    """Runs of at least ``hold_seconds`` during which the summed gauge exceeds the limit."""
    step = step_start(F.col("ts"), step_seconds).alias("window_start")
    steps = samples.groupBy(step).agg((F.sum("value") > limit).alias("over"))
    return held(steps, [], "over", step_seconds, hold_seconds)


def histogram_buckets(
    samples: DataFrame, by: Sequence[str], bounds: Sequence[float]
) -> DataFrame:
    """Cumulative counts per upper bound ``le`` (the last bound is infinite)."""
    limits = [float(b) for b in bounds] + [float("inf")]
    index = sum((F.col("value") > F.lit(b)).cast("int") for b in limits[:-1])
    counted = samples.groupBy(*by, index.alias("_i")).agg(F.count("*").alias("_n"))
    wide = counted.groupBy(*by).agg(
        *[
            F.sum(F.when(F.col("_i") <= i, F.col("_n")).otherwise(0)).alias(f"_c{i}")
            for i in range(len(limits))
        ]
    )
    pairs = F.array(
        *[F.struct(F.lit(b).alias("le"), F.col(f"_c{i}").alias("c")) for i, b in enumerate(limits)]
    )
    return wide.select(*by, F.explode(pairs).alias("b")).select(*by, "b.le", "b.c")


def histogram_quantile(
    buckets: DataFrame, by: Sequence[str], quantiles: Mapping[str, float]
) -> DataFrame:
    """Quantiles from cumulative ``le`` buckets, linear inside a bucket.

    The lowest bucket starts at zero; a quantile in the infinite bucket is the highest finite
    bound.  A histogram has a fixed number of buckets, so its window is small.
    """
    order = Window.partitionBy(*by).orderBy("le")
    all_of = Window.partitionBy(*by)
    placed = buckets.withColumns(
        {
            "_lo": F.coalesce(F.lag("le").over(order), F.lit(0.0)),
            "_before": F.coalesce(F.lag("c").over(order), F.lit(0)),
            "_total": F.max("c").over(all_of),
        }
    )

    def quantile(q: float) -> Column:
        rank = F.col("_total") * F.lit(q)
        inside = (F.col("c") >= rank) & (F.col("_before") < rank)
        share = F.try_divide(rank - F.col("_before"), F.col("c") - F.col("_before"))
        value = F.when(F.col("le") == float("inf"), F.col("_lo")).otherwise(
            F.col("_lo") + (F.col("le") - F.col("_lo")) * share
        )
        return F.min(F.when(inside, value))

    return placed.groupBy(*by).agg(*[quantile(q).alias(n) for n, q in quantiles.items()])


def latency_percentiles(samples: DataFrame, by: Sequence[str]) -> DataFrame:
    return exact_quantiles(samples, by, "value", {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def stage_funnel(samples: DataFrame, by: Sequence[str], stages: Sequence[str]) -> DataFrame:
    """Total per stage and label set, one column per stage."""
    return samples.groupBy(*by).agg(
        *[
            F.sum(F.when(F.col("name") == s, F.col("value")).otherwise(0.0)).alias(s)
            for s in stages
        ]
    )


def sum_by_label(samples: DataFrame, name: str) -> DataFrame:
    return samples.groupBy("name", label(name).alias(name)).agg(F.sum("value").alias("total"))


def rollup(samples: DataFrame, distributions: Sequence[str]) -> DataFrame:
    """Counters as sums; distributions also as count, min, max and mean."""
    spread = F.col("name").isin(*distributions)

    def only(value: Column) -> Column:
        return F.when(spread, value)

    summed = samples.groupBy("name").agg(
        F.count("*").alias("_n"),
        F.sum("value").alias("total"),
        F.min("value").alias("_lo"),
        F.max("value").alias("_hi"),
    )
    return summed.select(
        "name",
        "total",
        only(F.col("_n")).alias("samples"),
        only(F.col("_lo")).alias("smallest"),
        only(F.col("_hi")).alias("largest"),
        only(F.col("total") / F.col("_n")).alias("mean"),
    )


def cost_model(usage: DataFrame, prices: Mapping[str, float] = PRICES) -> DataFrame:
    """Daily cost per pipeline from its average vCPUs and metered units.

    ``usage``: day, pipeline, avg_vcpus, one column per metered unit, predictions.
    """
    metered = [u for u in prices if u in usage.columns]
    cost = F.col("avg_vcpus") * prices["vcpu_hour"] * 24
    for unit in metered:
        cost = cost + F.col(unit) * prices[unit]
    return usage.select("day", "pipeline", cost.alias("cost"), "predictions").withColumn(
        "cost_per_prediction", safe_divide(F.col("cost"), F.col("predictions"))
    )


def cost_trend(costs: DataFrame, days: int = 7) -> DataFrame:
    """Rolling mean of the daily cost per pipeline over its last ``days`` rows."""
    last = Window.partitionBy("pipeline").orderBy("day").rowsBetween(-(days - 1), 0)
    return costs.select("day", "pipeline", "cost", F.avg("cost").over(last).alias("trend"))
