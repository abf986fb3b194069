"""Streams: nothing is lost, replays change nothing, waiting requests get their retry."""

import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.contract import DEAD_LETTER_SCHEMA, FEATURE_SCHEMA, IRIS, PREDICTION_SCHEMA, traced
from tidemark.operators import online, scoring
from tidemark.session import new_folder
from tidemark.sources import tables
from tidemark.sources.messages import file_stream
from tidemark.streaming.features import FeatureStream
from tidemark.streaming.inference import InferenceStream
from tidemark.streaming.metrics import LATENCY, latency_bin, stage_counts, stage_latency

NAMES = list(IRIS.features)


def feature(sample, length=5.0):
    return json.dumps(
        {"sepal_length": length, "sepal_width": 1, "petal_length": 2, "petal_width": 3,
         "sample_id": sample}
    )


def messages(spark, texts):
    rows = [(bytearray(t.encode()),) for t in texts]
    return spark.createDataFrame(rows, "value binary")


@pytest.fixture()
def stream(spark):
    base = new_folder(spark, "features")
    built = FeatureStream(
        f"{base}/offline",
        online.OnlineStore(spark, f"{base}/online", "entity_id", NAMES),
        f"{base}/letters",
        f"{base}/metrics",
    )
    tables.create_table(spark, built.offline_path, FEATURE_SCHEMA)
    tables.create_table(spark, built.dead_letter_path, DEAD_LETTER_SCHEMA)
    return built


def test_rows_are_conserved_and_replay_is_harmless(spark, stream):
    batch = messages(spark, [feature(1), feature(2), feature(0), "{bad", feature("x")])
    for _ in range(2):
        stream.process(batch, 0)
    offline = tables.read_batches(spark, stream.offline_path, FEATURE_SCHEMA)
    letters = tables.read_batches(spark, stream.dead_letter_path, DEAD_LETTER_SCHEMA)
    assert (offline.count(), letters.count()) == (3, 2)
    # Random ids agree between both sinks.
    assert {r.entity_id for r in offline.collect()} == {
        r.entity_id for r in stream.store.snapshot().collect()
    }
    samples = spark.read.parquet(stream.metrics_path)
    counts = {(r.stage, r.name): r.total for r in stage_counts(samples).collect()}
    assert counts == {
        ("parse", "success"): 3, ("parse", "missing"): 1, ("parse", "error"): 1,
        ("offline", "success"): 3, ("online", "success"): 3, ("dead_letters", "success"): 2,
    }
    waits = {r.stage: r for r in stage_latency(samples).collect()}
    assert waits["parse"].rows == 5 and 0 < waits["parse"].p50 <= waits["parse"].p99


def test_offline_table_must_exist(spark, stream):
    stream.offline_path += "-absent"
    with pytest.raises(FileNotFoundError):
        stream.process(messages(spark, [feature(1)]), 0)


def serving(spark, store, **how):
    base = new_folder(spark, "inference")
    built = InferenceStream(
        store=store,
        scorer=scoring.ThresholdRule(0, 2.0, 4.0),
        service="rule://t",
        prediction_path=f"{base}/predictions",
        work_path=f"{base}/work",
        dead_letter_path=f"{base}/letters",
        metrics_path=f"{base}/metrics",
        features=NAMES,
        as_of=F.lit(dt.datetime(2024, 1, 31)),
        **how,
    )
    tables.create_table(spark, built.prediction_path, PREDICTION_SCHEMA)
    tables.create_table(spark, built.dead_letter_path, DEAD_LETTER_SCHEMA)
    return base, built


def outcomes(spark, stream):
    made = tables.read_batches(spark, stream.prediction_path, traced(PREDICTION_SCHEMA)).collect()
    letters = tables.read_batches(spark, stream.dead_letter_path, traced(DEAD_LETTER_SCHEMA)).collect()
    return (
        sorted((r.entity_id, r.prediction) for r in made),
        sorted((r.error_type, r.entity_id, r.retry_count) for r in letters),
    )


def test_requests_wait_for_their_features(spark, stream):
    stream.process(messages(spark, [feature(1, 1.0)]), 0)
    base, server = serving(spark, stream.store)
    asked = ['{"sample_id": 1}', *['{"sample_id": 2}'] * 2, '{"sample_id": 3}', "{}"]
    server.process(messages(spark, asked), 0)
    assert server.waiting(spark) == 2  # equal requests wait together
    stream.process(messages(spark, [feature(2, 3.0)]), 1)
    server.process(messages(spark, ['{"sample_id": 1}']), 1)
    server.process(messages(spark, ['{"sample_id": 1}']), 1)  # replay
    # No message follows: the timers alone end the waiting.
    server.settle(spark, f"{base}/retry-marks")
    expected = (
        [("1_streaming", "0"), ("1_streaming", "0"), ("2_streaming", "1"), ("2_streaming", "1")],
        [("missing_features", "3_streaming", 1), ("missing_field", None, None)],
    )
    assert outcomes(spark, server) == expected
    assert server.waiting(spark) == 0
    # A replay of the batch that missed is recognised by the state of the retries.
    server.process(messages(spark, ['{"sample_id": 1}', '{"sample_id": 3}', "{}"]), 0)
    run = server.start_retries(spark, f"{base}/retry-marks", "100 milliseconds")
    deadline, read = time.monotonic() + 60, 0
    while time.monotonic() < deadline and (read == 0 or run.lastProgress["batchId"] < read + 3):
        time.sleep(0.3)
        if run.lastProgress and run.lastProgress["numInputRows"]:
            read = run.lastProgress["batchId"]
    run.stop()
    assert read
    made, letters = outcomes(spark, server)
    assert letters == expected[1] and made.count(("2_streaming", "1")) == 2


def test_several_retries_each_wait_longer(spark, stream):
    base, server = serving(spark, stream.store, max_retries=3, retry_seconds=0.1)
    server.process(messages(spark, ['{"sample_id": 8}', '{"sample_id": 9}']), 0)
    stream.process(messages(spark, [feature(9)]), 0)
    server.settle(spark, f"{base}/retry-marks")
    made, letters = outcomes(spark, server)
    assert [m[0] for m in made] == ["9_streaming"]
    assert letters == [("missing_features", "8_streaming", 3)]


def test_an_unreadable_store_gives_dead_letters_and_the_stream_goes_on(spark, stream):
    stream.process(messages(spark, [feature(1, 1.0)]), 0)
    base, server = serving(spark, stream.store)
    broken = f"{stream.store.path}/_change={7:012d}"
    spark.createDataFrame([("not parquet",)], "value string").write.text(broken)
    server.process(messages(spark, ['{"sample_id": 1}', "{}"]), 0)
    assert outcomes(spark, server) == ([], [("missing_field", None, None)])
    tables.remove_folders(spark, stream.store.path, [f"_change={7:012d}"])
    server.process(messages(spark, ['{"sample_id": 1}']), 1)
    spark.createDataFrame([("not parquet",)], "value string").write.text(broken)
    server.settle(spark, f"{base}/retry-marks")
    assert outcomes(spark, server) == (
        [("1_streaming", "0")],
        [("fetch_error", "1_streaming", 1), ("missing_field", None, None)],
    )
    counts = {(r.stage, r.name): r.total for r in stage_counts(spark.read.parquet(server.metrics_path)).collect()}
    assert counts["fetch", "error"] == 1 and counts["fetch", "retry"] == 1
    assert counts["fetch", "success"] == 1 and counts["write", "error"] == 2


def test_a_message_read_twice_counts_once_and_keeps_its_id(spark, stream):
    base, server = serving(spark, stream.store)
    rows = [(bytearray(feature(1, 1.0).encode()), "f-1"), (bytearray(b"nope"), "f-2")]
    spark.createDataFrame(rows * 2, "value binary, trace_id string").write.parquet(f"{base}/f")
    asked = [("{}", "i-1"), ('{"sample_id": 1}', "i-2"), ('{"sample_id": 5}', "i-3"), ('{"sample_id": 1}', None)]
    asked = [(bytearray(a.encode()), i) for a, i in asked]
    spark.createDataFrame(asked * 2, "value binary, trace_id string").write.parquet(f"{base}/i")
    schema = "value binary, trace_id string"
    stream.start(file_stream(spark, f"{base}/f", schema), f"{base}/mf").awaitTermination()
    server.start(file_stream(spark, f"{base}/i", schema), f"{base}/mi").awaitTermination()
    server.settle(spark, f"{base}/retry-marks")

    def ids(path, schema):
        return sorted(str(r.trace_id) for r in tables.read_batches(spark, path, traced(schema)).collect())

    assert ids(stream.offline_path, FEATURE_SCHEMA) == ["f-1"]
    assert ids(stream.dead_letter_path, DEAD_LETTER_SCHEMA) == ["f-2"]
    assert ids(server.prediction_path, PREDICTION_SCHEMA) == ["None", "None", "i-2"]
    assert ids(server.dead_letter_path, DEAD_LETTER_SCHEMA) == ["i-1", "i-3"]


def test_latency_bins_merge_by_addition(spark):
    draw = random.Random(4)
    seconds = [10 ** draw.uniform(-3, 1) for _ in range(2000)]
    rows = [("score", LATENCY, s, 1.0) for s in seconds]
    bins = spark.createDataFrame(rows, "stage string, name string, s double, value double").select(
        "name",
        F.create_map(
            F.lit("job"), F.lit("j"), F.lit("stage"), F.col("stage"), F.lit("bin"), latency_bin(F.col("s")).cast("string")
        ).alias("labels"),
        "value",
    )
    halves = bins.where("rand(1) < 0.5").unionByName(bins.where("rand(1) >= 0.5"))
    got = stage_latency(halves).first()
    for name, share in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
        exact = sorted(seconds)[int(share * len(seconds)) - 1]
        assert exact <= got[name] <= exact * 1.26
    assert got.rows == 2000
