"""Chunked running totals, previous values, quantiles and splits against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ordered, splits
from tidemark.operators.canonical import append_with_next_id
from tidemark.operators.ordered import equal_depth, exact_quantiles, previous_value, running_totals


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    return [
        (i, draw.choice(["hot", "hot", "hot", "b", None]), draw.randrange(-50, 50) / 2)
        for i in range(400)
    ]


def test_running_totals(spark, rows):
    df = spark.createDataFrame(rows, "id long, k string, v double")
    for descending in (False, True):
        got = running_totals(
            df, ["k"], [F.floor(F.col("v") / 10)], [F.col("v")], {"t": F.col("id")}, descending
        )
        for r in got.collect():
            same = [x for x in rows if x[1] == r.k]
            fits = [x[0] for x in same if (x[2] >= r.v if descending else x[2] <= r.v)]
            assert r.t == sum(fits)


def test_previous_value(spark, rows):
    df = spark.createDataFrame(rows, "id long, k string, v double")
    got = previous_value(df, ["k"], [F.floor(F.col("id") / 7)], ["id"], F.col("v"), "before")
    for r in got.collect():
        earlier = [x for x in rows if x[1] == r.k and x[0] < r.id]
        assert r.before == (max(earlier)[2] if earlier else None)


def test_quantiles_equal_the_exact_percentile(spark, rows):
    df = spark.createDataFrame(rows, "id long, k string, v double")
    wanted = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r.k: r for r in exact_quantiles(df, ["k"], "v", wanted).collect()}
    plain = df.groupBy("k").agg(*[F.percentile("v", q).alias(n) for n, q in wanted.items()])
    for r in plain.collect():
        for name in wanted:
            assert got[r.k][name] == pytest.approx(r[name])


def test_split_is_exact_with_many_copies(spark):
    rows = [(1, "copy")] * 700 + [(i, "single") for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b string")
    got = splits.train_test_split(df, ["a", "b"]).collect()
    assert Counter(r.split for r in got) == {"train": 800, "test": 200}
    assert Counter((r.a, r.b) for r in got) == Counter(rows)


def test_next_ids_are_dense(spark):
    rows = [("copy",)] * 500 + [(f"s{i}",) for i in range(250)]
    new = spark.createDataFrame(rows, "x string")
    existing = spark.createDataFrame([(41,), (7,)], "Id long")
    got = append_with_next_id(existing, new).collect()
    assert sorted(r.Id for r in got) == list(range(42, 42 + 750))
    assert Counter((r.x,) for r in got) == Counter(rows)
    empty = existing.where("Id > 1000")
    assert min(r.Id for r in append_with_next_id(empty, new).collect()) == 1


def test_time_user_split_shares_no_user(spark):
    draw = random.Random(9)
    rows = [(draw.randrange(200), 1_700_000_000 + draw.randrange(10_000_000)) for _ in range(900)]
    df = spark.createDataFrame(rows, "u long, s long").select("u", F.timestamp_seconds("s").alias("t"))
    got = splits.time_user_split(df, "u", "t").collect()
    members = {s: {r.u for r in got if r.split == s} for s in ("fit", "calib", "test")}
    assert all(members.values())
    assert not members["fit"] & members["calib"]
    assert not (members["fit"] | members["calib"]) & members["test"]
    assert max(r.t for r in got if r.split != "test") < min(r.t for r in got if r.split == "test")


def test_split_floor(spark):
    df = spark.createDataFrame([("fit", 1), ("fit", 0), ("calib", 0)], "split string, y int")
    with pytest.raises(Exception, match="too few positives"):
        splits.split_floor(df, "y", floor=1).collect()


def test_chunks_follow_the_data(spark):
    # Nine of ten values lie in 0.999..1, some are equal, and one key has next to none.
    narrow = F.when(F.col("id") % 10 > 0, 0.999 + F.rand(5) / 1000).otherwise(F.rand(6) * 1e6 - 5e5)
    value = F.when(F.col("id") % 50 == 7, 0.9995).otherwise(narrow)
    df = spark.range(60_000).select(
        F.when(F.col("id") < 59_990, "hot").otherwise("cold").alias("k"), value.alias("v")
    )
    cut = equal_depth(df, ["k"], "v", 1000)
    cut.persist()
    sizes = sorted(r["count"] for r in cut.where("k = 'hot' and v != 0.9995").groupBy("_piece").count().collect())
    assert len(sizes) >= 60 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    spans = cut.groupBy("k", "_piece").agg(F.min("v").alias("low"), F.max("v").alias("high")).collect()
    ordered = sorted((r.k, r._piece, r.low, r.high) for r in spans)
    for a, b in zip(ordered, ordered[1:]):
        assert a[0] != b[0] or a[3] < b[2]  # pieces do not overlap, so equal values share one
    assert [r[1] for r in ordered if r[0] == "cold"] == [0]
    cut.unpersist()
    whole = equal_depth(df.select("v"), [], "v", 10_000)
    assert whole.groupBy("_piece").count().count() == 8
    assert equal_depth(df.limit(0), ["k"], "v").count() == 0
    assert equal_depth(df.limit(0).select("v"), [], "v").count() == 0


def test_carries_meet_level_by_level(spark, monkeypatch):
    """Blocks of 16 chunks: carries of 3000 chunks of two keys, some of them empty, equal brute force."""
    monkeypatch.setattr(ordered, "BLOCK_CHUNKS", 16)
    draw = random.Random(4)
    rows = [(draw.choice(["a", None]), draw.randrange(3000), draw.choice([None, 1, 5])) for _ in range(600)]
    df = spark.createDataFrame(rows, "k string, c long, n long").groupBy("k", "c").agg(F.max("n").alias("n"))
    kept = sorted((r.c, r.k or "", r.n) for r in df.collect())
    for descending in (False, True):
        got = ordered.sums_before(df, ["k"], ["c"], {"n": "before"}, descending).collect()
        assert len(got) == len(kept)
        for r in got:
            at, key = r.c, r.k or ""
            same = [n or 0 for c, k, n in kept if k == key and (c > at if descending else c < at)]
            assert r.before == sum(same)
    for r in ordered.last_before(df, ["k"], ["c"], {"n": "before"}).collect():
        at, key = r.c, r.k or ""
        known = [n for c, k, n in kept if k == key and c < at and n is not None]
        assert r.before == (known[-1] if known else None)


def test_a_window_sees_one_block_of_chunks_only(spark):
    """A million chunks of one key: the largest group that a window orders has 4096 rows."""
    chunks = spark.range(1_000_000).select(F.col("id").alias("c"), F.lit(2).alias("n"))
    made = ordered.sums_before(chunks, [], ["c"], {"n": "before"})
    assert made.where(F.col("before") != 2 * F.col("c")).isEmpty()
    text = made._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert len(windows) == 2
    assert sum("[_block" in line for line in windows) == 2  # by block, and over the blocks


def test_chunks_are_cut_again_where_one_cut_is_not_enough(spark):
    """Four chunks a cut: 20 000 rows in chunks of about 500 need more than two cuts' first level."""
    value = F.when(F.col("id") % 4 > 0, F.lit(0.5) + F.rand(3) / 1e6).otherwise(F.rand(4) * 100)
    df = spark.range(20_000).select(F.lit("k").alias("k"), value.alias("v"), "id")
    cut = equal_depth(df, ["k"], "v", 500, most=4)
    spans = cut.groupBy("_piece").agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n")
    ).orderBy("_piece").collect()
    assert 32 <= len(spans) <= 64 and max(r.n for r in spans) <= 2 * 500
    assert all(a.high < b.low for a, b in zip(spans, spans[1:]))
    totals = ordered.running_totals(cut, ["k"], [F.col("_piece")], [F.col("v")], {"t": F.lit(1)})
    ranks = sorted((r.v, r.t) for r in totals.collect())
    assert [t for _, t in ranks] == list(range(1, 20_001))


def test_borders_do_not_change_when_chunks_are_read_again(spark):
    """Sketches draw at random, so a lost task must find the borders that the others used."""
    df = spark.range(400_000).select((F.rand(1) * 1e6).alias("v"), "id")
    cut = equal_depth(df, [], "v", 5_000)
    first, second = (cut.groupBy("_piece").agg(F.sum("id").alias("s")) for _ in range(2))
    assert sorted(first.collect()) == sorted(second.collect())


def test_next_ids_and_splits_over_two_levels_of_chunks(spark):
    new = spark.range(30_000).select(F.col("id").cast("string").alias("x"))
    none = spark.createDataFrame([], "Id long")
    got = append_with_next_id(none, new)
    assert got.agg(F.countDistinct("Id"), F.min("Id"), F.max("Id")).first()[:] == (30_000, 1, 30_000)
    assert got.select("x").distinct().count() == 30_000
