"""Counters with resets, holds and histogram quantiles."""

import datetime as dt

import pytest

from tidemark.operators import series

T0 = dt.datetime(2024, 1, 1)


def samples(spark, values, step=60):
    rows = [(T0 + dt.timedelta(seconds=step * i), "c", {"job": "j"}, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ts timestamp, name string, labels map<string,string>, value double")


def test_reset_counts_from_zero(spark):
    grown = series.counter_increase(series.with_labels(samples(spark, [10, 15, 3]), ["job"]), ["job"])
    assert [r.increase for r in grown.orderBy("ts").collect()] == [0.0, 5.0, 3.0]


def test_growth_crosses_midnight(spark):
    day = samples(spark, [1, 2, 4, 8], step=40_000)
    grown = series.counter_increase(series.with_labels(day, ["job"]), ["job"])
    assert [r.increase for r in grown.orderBy("ts").collect()] == [0.0, 1.0, 2.0, 4.0]


def test_histogram_with_an_empty_bucket(spark):
    rows = [(1.0, 2), (2.0, 2), (4.0, 10), (float("inf"), 10)]
    buckets = spark.createDataFrame(rows, "le double, c long")
    got = series.histogram_quantile(buckets, [], {"p10": 0.1, "p50": 0.5, "p99": 0.99}).first()
    assert got.p10 == pytest.approx(0.5)
    assert got.p50 == pytest.approx(2.75)
    assert got.p99 == pytest.approx(3.975)


def test_quantile_in_the_open_bucket(spark):
    buckets = spark.createDataFrame([(1.0, 1), (float("inf"), 10)], "le double, c long")
    assert series.histogram_quantile(buckets, [], {"p": 0.9}).first().p == 1.0


def test_hold_needs_consecutive_steps(spark):
    flags = [(0, True), (60, True), (120, False), (180, True), (240, True), (300, True), (600, True)]
    steps = spark.createDataFrame(flags, "window_start long, over boolean")
    got = series.held(steps, [], "over", 60, 180).collect()
    assert [(r.run_start, r.run_end, r.steps) for r in got] == [(180, 360, 3)]


def test_silent_windows_fire(spark):
    data = samples(spark, [1, 2, 3], step=1200)
    grown = series.counter_increase(series.with_labels(data, ["job"]), ["job"])
    got = series.no_flow(data, grown).orderBy("window_start").collect()
    assert [r.firing for r in got] == [True, True, False, True, False]
