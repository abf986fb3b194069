"""Physical plans: what reaches the scan and what is combined before a shuffle."""

import pytest

from tidemark.functions import messages as msg
from tidemark.operators import online, rings, splits, velocity
from tidemark.plans import bindings as b
from tidemark.session import new_folder
from tidemark.sources import tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_source_filter_prunes_partitions(spark):
    path = new_folder(spark, "features")
    tables.write_refresh(b.canonical(spark, FOLDER), path)
    text = plan(tables.scan_source(spark.read.parquet(path), "training").select("entity_id"))
    assert "PartitionFilters: [isnotnull(source" in text
    assert "ReadSchema: struct<entity_id:string>" in text


def test_day_predicate_prunes_partitions(spark):
    path = new_folder(spark, "days")
    made = b.stream_predictions(spark, FOLDER)
    tables.day_partitioned(made, "prediction_timestamp").write.partitionBy("dt").parquet(path)
    recent = tables.between_days(
        spark.read.parquet(path), "prediction_timestamp", b.as_of("2024-01-20 00:00:00")
    )
    assert "PartitionFilters: [isnotnull(dt" in plan(recent.select("entity_id"))


def test_only_needed_columns_are_read(spark):
    latest = online.latest_per_entity(
        b.canonical(spark, FOLDER).select("entity_id", "species", "feature_timestamp"),
        "entity_id",
        ["feature_timestamp"],
    )
    assert "l_extendedprice" not in plan(latest)


def test_members_are_distinct_before_they_meet_in_a_bucket(spark):
    text = plan(rings.buckets(b.transfers(spark, FOLDER), rings.HOURLY))
    assert "ObjectHashAggregate" in text and "partial_collect_list" in text
    assert "HashAggregate(keys=[user_id" in text


def test_split_does_not_shuffle_the_rows(spark):
    """Outside the one digest bucket of the cut, rows are labelled where they are read."""
    text = plan(splits.train_test_split(b.raw(spark, FOLDER), ["Id"]))
    rows_branch = text.split("Union")[1].split("HashAggregate")[0]
    assert "Exchange hashpartitioning" not in rows_branch


@pytest.mark.parametrize(
    "made",
    [
        lambda spark: b.canonical(spark, FOLDER),
        lambda spark: msg.read_feature_messages(b.messages(spark, FOLDER)),
        lambda spark: velocity.transfer_features(
            b.transfers(spark, FOLDER), b.users(spark, FOLDER), b.as_of()
        ),
        lambda spark: rings.user_rings(b.transfers(spark, FOLDER), b.as_of()),
        lambda spark: splits.train_test_split(b.raw(spark, FOLDER), ["Id"]),
    ],
)
def test_batch_plans_have_no_python(spark, made):
    text = plan(made(spark))
    assert not any(kind in text for kind in ("BatchEvalPython", "ArrowEval", "MapInPandas"))
