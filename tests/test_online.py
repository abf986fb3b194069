"""Online store, lookups, as-of join, sinks and contracts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.contract import FEATURE_SCHEMA, IRIS, conform, contract
from tidemark.operators import asof, online
from tidemark.operators.canonical import canonicalise
from tidemark.session import new_folder
from tidemark.sources import tables

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


SCHEMA = "entity_id string, a double, b string, feature_timestamp timestamp"


def values(store, upto=None):
    return {r.entity_id: (r.a, r.b) for r in store.snapshot(upto).collect()}


def test_null_features_keep_their_value(spark):
    store = online.new_store(spark, "entity_id", ["a", "b"])
    assert store.snapshot() is None
    first = [("x", 1.0, "p", at(0)), ("x", 2.0, None, at(1)), ("y", None, "q", at(0))]
    store.upsert(spark.createDataFrame(first, SCHEMA), 0)
    assert values(store) == {"x": (2.0, "p"), "y": (None, "q")}
    store.upsert(spark.createDataFrame([("x", None, "r", at(2))], SCHEMA), 1)
    assert values(store)["x"] == (2.0, "r")
    assert values(store, upto=0)["x"] == (2.0, "p")
    # Replaying a batch replaces it.
    store.upsert(spark.createDataFrame([("x", 9.0, "r", at(2))], SCHEMA), 1)
    assert values(store)["x"] == (9.0, "r")
    before = values(store)
    store.compact(1)
    assert len(store.parts()) == 1
    assert values(store) == before
    store.upsert(spark.createDataFrame([("z", 5.0, None, at(0))], SCHEMA), 2)
    assert values(store)["z"] == (5.0, None)
    keys = spark.createDataFrame([("z",), ("none",)], "entity_id string")
    assert [r.entity_id for r in store.lookup(keys).collect()] == ["z"]


def test_sync_hides_no_change(spark):
    store = online.new_store(spark, "entity_id", ["a", "b"])
    store.upsert(spark.createDataFrame([("x", 1.0, "p", at(0))], SCHEMA), 500)
    store.sync(spark.createDataFrame([("x", 1.0, "p", at(0)), ("y", 3.0, "q", at(0))], SCHEMA))
    assert values(store) == {"x": (1.0, "p"), "y": (3.0, "q")}
    store.upsert(spark.createDataFrame([("x", 2.0, None, at(1))], SCHEMA), 501)
    assert values(store) == {"x": (2.0, "p"), "y": (3.0, "q")}
    before = values(store)
    for batch in (501, 501):
        store.compact(batch)
        assert values(store) == before
    store.upsert(spark.createDataFrame([("y", 4.0, None, at(2))], SCHEMA), 502)
    assert values(store) == {"x": (2.0, "p"), "y": (4.0, "q")}
    # What an earlier base had replaced is gone; the last two bases and new changes are left.
    names = tables.committed_folders(spark, store.path)
    assert sorted(n.split("=")[0] for n in names) == ["_base", "_base", "_change"]


def test_lookup_reads_the_buckets_of_its_keys_only(spark):
    store = online.new_store(spark, "entity_id", ["a", "b"])
    rows = spark.range(600_000).select(
        F.concat(F.lit("e"), F.col("id")).alias("entity_id"),
        F.col("id").cast("double").alias("a"),
        F.lit("p").alias("b"),
        F.lit(at(0)).alias("feature_timestamp"),
    )
    store.sync(rows)
    store.upsert(spark.createDataFrame([("e5", -5.0, None, at(1)), ("new", 1.0, "q", at(1))], SCHEMA), 0)
    asked = [("e5",), ("e7",), ("new",), ("none",), (None,), ("e5",)]
    keys = spark.createDataFrame(asked, "entity_id string")
    found = store.lookup(keys)
    got = {r.entity_id: (r.a, r.b) for r in found.collect()}
    assert got == {"e5": (-5.0, "p"), "e7": (7.0, "p"), "new": (1.0, "q")}
    # Of 256 buckets of the base, those of four keys are read, and of one file each.
    base, _ = store._parts()
    assert base.bits == 8
    plan = found._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [_bucket" in plan.toString()
    whole = store._base(base)
    buckets = {n.n >> (online.MOST_BITS - 8) for n in keys.dropna().select(online.bucket("entity_id", online.MOST_BITS).alias("n")).collect()}
    read = whole.where(F.col("_bucket").isin(sorted(buckets)))
    assert len(read.inputFiles()) == 256 and read.count() < 5 * 600_000 / 256 * 1.5
    files = read.select(F.input_file_name()).distinct().count()
    assert files == len(buckets) <= 4


def test_buckets_nest_and_follow_the_rows(spark):
    keys = spark.range(1000).select(F.col("id").alias("k"))
    fine, coarse = online.bucket("k", 14), online.bucket("k", 4)
    assert keys.where(F.shiftright(fine, 10) != coarse).isEmpty()
    assert keys.select(online.bucket("k", 0).alias("n")).distinct().count() == 1
    assert [online.bits_for(n) for n in (0, 1, 4096, 4097, 10**7, 10**12)] == [0, 0, 0, 1, 12, 14]


def test_an_empty_batch_changes_nothing(spark):
    store = online.new_store(spark, "entity_id", ["a", "b"])
    none = spark.createDataFrame([], SCHEMA)
    store.upsert(none, 0)
    assert store.snapshot() is None and store.lookup(none) is None
    store.compact(0)
    store.upsert(spark.createDataFrame([("x", 1.0, "p", at(0))], SCHEMA), 1)
    assert store.lookup(none).count() == 0
    assert values(store) == {"x": (1.0, "p")}


def test_lookup_retry(spark):
    asked = spark.createDataFrame([("x",), ("y",), ("w",), ("x",)], "entity_id string")
    schema = "entity_id string, a double, b double"
    now = spark.createDataFrame([("x", 1.0, 1.0), ("y", 1.0, None)], schema)
    later = spark.createDataFrame([("x", 2.0, 2.0), ("y", 2.0, 2.0)], schema)
    got = online.enrich_with_retry(asked, [now, later], "entity_id", ["b", "a"]).collect()
    assert len(got) == 4
    assert {(r.entity_id, r.a, r.retry_count, tuple(r.missing)) for r in got} == {
        ("x", 1.0, 0, ()),
        ("y", 2.0, 1, ()),
        ("w", None, 1, ("a", "b")),
    }


def test_point_in_time(spark):
    facts = [("x", at(h), float(h)) for h in (0, 5, 30, 31, 100)] + [(None, at(0), -1.0)]
    spine = [("x", at(h), h) for h in (-1, 0, 4, 5, 29, 30, 80, 200)] + [("y", at(3), 0)]
    features = spark.createDataFrame(facts, "e string, ft timestamp, v double")
    asked = spark.createDataFrame(spine, "e string, st timestamp, n int")
    for rows in (1, 3, 65_536):
        joined = asof.point_in_time_join(asked, features, "e", "st", "ft", ["v"], rows)
        got = {(r.e, r.n): r.v for r in joined.collect()}
        assert got == {
            ("x", -1): None,
            ("x", 0): 0.0,
            ("x", 4): 0.0,
            ("x", 5): 5.0,
            ("x", 29): 5.0,
            ("x", 30): 30.0,
            ("x", 80): 31.0,
            ("x", 200): 100.0,
            ("y", 0): None,
        }


def test_strict_sink_refuses_nulls(spark):
    row = (1.0, None, 1.0, 1.0, None, "s", "e", T0)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FEATURE_SCHEMA.fields)
    df = spark.createDataFrame([row], schema)
    assert conform(df, FEATURE_SCHEMA).count() == 1
    with pytest.raises(Exception, match="sepal_width_cm is null"):
        conform(df, FEATURE_SCHEMA, strict=True).collect()
    with pytest.raises(ValueError, match="entity_id"):
        conform(df.drop("entity_id"), FEATURE_SCHEMA)


def test_sink_needs_its_table(spark):
    with pytest.raises(FileNotFoundError):
        tables.require_table(spark, new_folder(spark, "absent"))


def test_scan_skips_only_missing_tables(spark):
    assert tables.scan_table(spark, new_folder(spark, "absent")) is None
    broken = new_folder(spark, "broken")
    spark.createDataFrame([("not parquet",)], "x string").write.text(broken)
    with pytest.raises(Exception):
        tables.scan_table(spark, broken).count()


def test_canonicalise(spark):
    schema = "Id double, SepalLengthCm double, source string, load_timestamp string"
    one = spark.createDataFrame([(1.0, 5.0, "training", "2024-01-01 00:00:00")], schema)
    two = spark.createDataFrame([(2, 6.0, "batch_input", "x")], "Id int, SepalLengthCm double, source string, Species string")
    rows = canonicalise([one, None, two], IRIS, F.current_timestamp()).collect()
    assert {r.entity_id for r in rows} == {"1_training", "2_batch_input"}
    assert {r.entity_id: r.feature_timestamp is None for r in rows} == {
        "1_training": False,
        "2_batch_input": True,  # another table has the column, so no default applies
    }
    assert canonicalise([None, None], IRIS, F.current_timestamp()) is None
    with pytest.raises(Exception, match="Id must not be null"):
        canonicalise([one.withColumn("Id", F.lit(None).cast("double"))], IRIS, F.lit(None)).collect()


def test_unknown_contract():
    with pytest.raises(KeyError, match="fraud_user"):
        contract("nothing")
    assert IRIS.to_source("snake")["petal_width_cm"] == "petal_width"


def test_a_base_alone_is_not_merged(spark):
    """A base has one row per key, so the state is merged only where changes came after it."""
    store = online.new_store(spark, "k", ["x"])
    at = dt.datetime(2024, 1, 1)
    rows = [("a", 1.0, at), ("a", 2.0, at + dt.timedelta(1)), ("a", None, at + dt.timedelta(2)), (None, 3.0, at)]
    schema = "k string, x double, feature_timestamp timestamp"
    store.sync(spark.createDataFrame(rows, schema))

    def state():
        return {r.k: r.x for r in store.snapshot().collect()}

    def merges():
        return "Aggregate" in store.snapshot()._jdf.queryExecution().executedPlan().toString()

    assert state() == {"a": None, None: 3.0} and not merges()
    store.upsert(spark.createDataFrame([("a", 5.0, at)], schema), 0)
    assert state() == {"a": 5.0, None: 3.0} and merges()
