"""Analytics over the metrics table (X rows, the hold rule and the metric roll-up)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import series
from tidemark.plans import bindings as b
from tidemark.plans.analytics import rounded
from tidemark.plans.bindings import with_ctes
from tidemark.plans.registry import query


def increases(spark: SparkSession, folder: str) -> DataFrame:
    samples = series.with_labels(b.counters(spark, folder), ["job"])
    return series.counter_increase(samples, ["job"])


@query(
    "counter_rate",
    with_ctes(
        """SELECT name, sec // 300 * 300 AS window_start, round(sum(increase) / 300, 9) AS rate
        FROM increases GROUP BY 1, 2""",
        "increases",
    ),
)
def counter_rate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.counter_rate(increases(spark, folder), ["name"]), 9, "rate")


@query(
    "error_ratio",
    with_ctes(
        """SELECT *, coalesce(ratio > 0.05, false) AS firing FROM (
          SELECT sec // 300 * 300 AS window_start, CASE WHEN sum(increase) <> 0 THEN
            round(sum(CASE WHEN name = 'error' THEN increase ELSE 0.0 END) / sum(increase), 9)
            END AS ratio FROM increases GROUP BY 1)""",
        "increases",
    ),
)
def error_ratio(spark: SparkSession, folder: str) -> DataFrame:
    ratios = series.error_ratio(increases(spark, folder), F.col("name") == "error")
    return rounded(ratios, 9, "ratio")


@query(
    "no_flow",
    with_ctes(
        """SELECT window_start, round(coalesce(rate, 0), 9) AS rate, coalesce(rate, 0) = 0 AS firing
        FROM (SELECT unnest(range(lo, hi + 1, 600)) AS window_start FROM
          (SELECT min(sec // 600 * 600) AS lo, max(sec // 600 * 600) AS hi FROM counters))
        LEFT JOIN (SELECT sec // 600 * 600 AS window_start, sum(increase) / 600 AS rate
          FROM increases WHERE name = 'purchase' GROUP BY 1) USING (window_start)""",
        "increases",
    ),
)
def no_flow(spark: SparkSession, folder: str) -> DataFrame:
    grown = increases(spark, folder).where("name = 'purchase'")
    return rounded(series.no_flow(b.counters(spark, folder), grown), 9, "rate")


_HELD = """SELECT run_start, run_end, steps FROM (
  SELECT min(window_start) AS run_start, max(window_start) + {step} AS run_end,
    count(*) AS steps
  FROM (SELECT window_start, window_start - {step} * row_number() OVER (ORDER BY window_start)
      AS island FROM ({steps}) WHERE {condition}) GROUP BY island)
WHERE run_end - run_start >= {hold}"""
_VALUE_STEPS = "SELECT sec // 300 * 300 AS window_start, sum(value) AS v FROM gauges GROUP BY 1"


@query(
    "gaps_islands_hold",
    with_ctes(
        _HELD.format(step=300, steps=_VALUE_STEPS, condition="v > 10", hold=900), "gauges"
    ),
)
def gaps_islands_hold(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches of at least 15 minutes during which the summed value stays above 10."""
    step = series.step_start(F.col("ts"), 300).alias("window_start")
    steps = b.gauges(spark, folder).groupBy(step).agg((F.sum("value") > 10).alias("over"))
    return series.held(steps, [], "over", 300, 900)


@query(
    "backlog_threshold",
    with_ctes(
        _HELD.format(step=3600, hold=7200, condition="v > 300",
            steps="SELECT sec // 3600 * 3600 AS window_start, sum(value) AS v"
            " FROM gauges GROUP BY 1"),
        "gauges",
    ),
)
def backlog_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return series.backlog(b.gauges(spark, folder), 3_600, limit=300.0, hold_seconds=7_200)


@query(
    "latency_mean_max",
    with_ctes(
        """SELECT job, round(avg(value), 8) AS mean_ms, max(value) AS max_ms,
          avg(value) > 20 AS firing FROM gauges GROUP BY job""",
        "gauges",
    ),
)
def latency_mean_max(spark: SparkSession, folder: str) -> DataFrame:
    samples = series.with_labels(b.gauges(spark, folder), ["job"])
    return rounded(series.latency_summary(samples, ["job"], limit=20.0), 8, "mean_ms")


def _rate_sql(name: str, alias: str) -> str:
    return f"sum(CASE WHEN name = '{name}' THEN increase ELSE 0.0 END) / 300 AS {alias}"


@query(
    "failure_spike",
    with_ctes(
        f"""SELECT window_start, round(f, 9) AS failure_rate, round(r, 9) AS retry_rate,
          f + r > 2.5 AS trouble_firing, r > 1.5 AS retry_firing
        FROM (SELECT sec // 300 * 300 AS window_start, {_rate_sql('error', 'f')},
            {_rate_sql('signup', 'r')}
          FROM increases WHERE name IN ('error', 'signup') GROUP BY 1)""",
        "increases",
    ),
)
def failure_spike(spark: SparkSession, folder: str) -> DataFrame:
    rates = series.failure_spike(
        increases(spark, folder), "error", "signup", trouble_limit=2.5, retry_limit=1.5
    )
    return rounded(rates, 9, "failure_rate", "retry_rate")


@query(
    "stage_dropoff",
    with_ctes(
        f"""SELECT window_start, round((p - f) / (p + 1), 9) AS dropoff,
          (p - f) / (p + 1) > 0.1 AS firing
        FROM (SELECT sec // 300 * 300 AS window_start, {_rate_sql('view', 'p')},
            {_rate_sql('click', 'f')}
          FROM increases WHERE name IN ('view', 'click') GROUP BY 1)""",
        "increases",
    ),
)
def stage_dropoff(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.stage_dropoff(increases(spark, folder), "view", "click"), 9, "dropoff")


@query(
    "vs_trailing_average",
    with_ctes(
        """SELECT hour, round(now, 8) AS "current", round(mean, 8) AS "trailing",
          now > mean * 2 AS firing
        FROM (SELECT hour, now, avg(now) OVER (ORDER BY hour
            RANGE BETWEEN 167 PRECEDING AND CURRENT ROW) AS mean
          FROM (SELECT sec // 3600 AS hour, avg(value) AS now FROM gauges GROUP BY 1))""",
        "gauges",
    ),
)
def vs_trailing_average(spark: SparkSession, folder: str) -> DataFrame:
    compared = series.versus_trailing_average(b.gauges(spark, folder))
    return rounded(compared, 8, "current", "trailing")


BOUNDS = [1.0, 2.5, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0]
_LE = ", ".join(f"({x})" for x in BOUNDS) + ", ('Infinity'::DOUBLE)"
_BUCKET_SQL = f"""SELECT job, le, count(*) FILTER (WHERE value <= le) AS c
  FROM gauges, (VALUES {_LE}) AS l(le) GROUP BY job, le"""


def _quantile_sql(q: float, name: str) -> str:
    return f"""round(min(CASE WHEN c >= {q} * n AND before < {q} * n THEN
      CASE WHEN le = 'Infinity'::DOUBLE THEN lo
        ELSE lo + (le - lo) * ({q} * n - before) / (c - before) END END), 8) AS {name}"""


@query(
    "histogram_quantile",
    with_ctes(
        f"""SELECT job, {_quantile_sql(0.5, 'p50')}, {_quantile_sql(0.95, 'p95')},
          {_quantile_sql(0.99, 'p99')}
        FROM (SELECT job, CAST(le AS DOUBLE) AS le, c, max(c) OVER (PARTITION BY job) AS n,
            coalesce(lag(CAST(le AS DOUBLE)) OVER (PARTITION BY job ORDER BY le), 0) AS lo,
            coalesce(lag(c) OVER (PARTITION BY job ORDER BY le), 0) AS before
          FROM ({_BUCKET_SQL})) GROUP BY job""",
        "gauges",
    ),
)
def histogram_quantile(spark: SparkSession, folder: str) -> DataFrame:
    samples = series.with_labels(b.gauges(spark, folder), ["job"])
    buckets = series.histogram_buckets(samples, ["job"], BOUNDS)
    quantiles = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    return rounded(series.histogram_quantile(buckets, ["job"], quantiles), 8, *quantiles)


@query(
    "latency_percentiles",
    with_ctes(
        """SELECT job, round(quantile_cont(value, 0.5), 8) AS p50,
          round(quantile_cont(value, 0.95), 8) AS p95, round(quantile_cont(value, 0.99), 8) AS p99
        FROM gauges GROUP BY job""",
        "gauges",
    ),
)
def latency_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    samples = series.with_labels(b.gauges(spark, folder), ["job"])
    return rounded(series.latency_percentiles(samples, ["job"]), 8, "p50", "p95", "p99")


STAGES = ["view", "click", "signup", "purchase"]


@query(
    "stage_funnel",
    with_ctes(
        "SELECT job, "
        + ", ".join(
            f"round(coalesce(sum(value) FILTER (WHERE name = '{s}'), 0), 4) AS {s}" for s in STAGES
        )
        + " FROM gauges GROUP BY job",
        "gauges",
    ),
)
def stage_funnel(spark: SparkSession, folder: str) -> DataFrame:
    samples = series.with_labels(b.gauges(spark, folder), ["job"])
    return rounded(series.stage_funnel(samples, ["job"], STAGES), 4, *STAGES)


@query(
    "sum_by_label",
    with_ctes(
        "SELECT name, job, round(sum(value), 4) AS total FROM gauges GROUP BY name, job", "gauges"
    ),
)
def sum_by_label(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.sum_by_label(b.gauges(spark, folder), "job"), 4, "total")


@query(
    "metric_rollup",
    with_ctes(
        """SELECT name, round(sum(value), 4) AS total,
          CASE WHEN name = 'view' THEN count(*) END AS samples,
          CASE WHEN name = 'view' THEN min(value) END AS smallest,
          CASE WHEN name = 'view' THEN max(value) END AS largest,
          CASE WHEN name = 'view' THEN round(avg(value), 8) END AS mean
        FROM gauges GROUP BY name""",
        "gauges",
    ),
)
def metric_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rolled = series.rollup(b.gauges(spark, folder), distributions=["view"])
    return rounded(rounded(rolled, 4, "total"), 8, "mean")


_USAGE = """SELECT CAST(ts AS DATE) AS day, CAST(user_id % 3 AS VARCHAR) AS pipeline,
  avg(value) AS avg_vcpus, count(*) FILTER (WHERE event_type = 'click') AS published_message,
  count(*) FILTER (WHERE event_type = 'view') AS store_read,
  count(*) FILTER (WHERE event_type = 'signup') AS store_write,
  count(*) FILTER (WHERE event_type = 'purchase') AS predictions
FROM events GROUP BY 1, 2"""
_COST = f"""SELECT day, pipeline, predictions, avg_vcpus * 0.069 * 24
    + published_message * (0.04 / 1e6) + store_read * (0.26 / 1e6)
    + store_write * (0.26 / 1e6) AS cost
  FROM ({_USAGE})"""


def usage(spark: SparkSession, folder: str) -> DataFrame:
    def units(kind: str, name: str):
        return F.count_if(F.col("event_type") == kind).alias(name)

    return (
        b.load(spark, folder, "events")
        .groupBy(
            F.to_date("ts").alias("day"),
            (F.col("user_id") % 3).cast("string").alias("pipeline"),
        )
        .agg(
            F.avg("value").alias("avg_vcpus"),
            units("click", "published_message"),
            units("view", "store_read"),
            units("signup", "store_write"),
            units("purchase", "predictions"),
        )
    )


@query(
    "cost_model",
    f"""SELECT day, pipeline, predictions, round(cost, 8) AS cost,
      CASE WHEN predictions <> 0 THEN round(cost / predictions, 8) END AS cost_per_prediction
    FROM ({_COST})""",
)
def cost_model(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(series.cost_model(usage(spark, folder)), 8, "cost", "cost_per_prediction")


@query(
    "cost_trend",
    f"""SELECT day, pipeline, round(cost, 8) AS cost, round(avg(cost) OVER (PARTITION BY pipeline
      ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 8) AS trend FROM ({_COST})""",
)
def cost_trend(spark: SparkSession, folder: str) -> DataFrame:
    costs = series.cost_model(usage(spark, folder))
    return rounded(series.cost_trend(costs), 8, "cost", "trend")
