"""Message validation, row by row."""

import json

import pytest

from tidemark.functions import messages as msg

GOOD = {"sepal_length": 5.1, "sepal_width": 3.5, "petal_length": 1.4, "petal_width": 0.2}


def body(**changes):
    return json.dumps({**GOOD, "sample_id": 7, **changes}).encode()


def without(name):
    return json.dumps({k: v for k, v in GOOD.items() if k != name}).encode()


def raw(text):
    return json.dumps(GOOD).replace("5.1", text).encode()


@pytest.fixture(scope="module")
def check(spark):
    def run(read, payloads):
        rows = [(i, bytearray(p)) for i, p in enumerate(payloads)]
        frame = spark.createDataFrame(rows, "i int, value binary")
        return sorted(read(frame).collect(), key=lambda r: r.i)

    return run


FEATURE_CASES = [
    (body(), None, 5.1, 7),
    (raw("3"), None, 3.0, None),
    (raw('"5.1"'), None, 5.1, None),
    (raw('" 5.1 "'), None, 5.1, None),
    (raw('"1e3"'), None, 1000.0, None),
    (raw("true"), None, 1.0, None),
    (raw("false"), None, 0.0, None),
    (raw('"abc"'), "validation", None, None),
    (raw('""'), "validation", None, None),
    (raw('"true"'), "validation", None, None),
    (raw("null"), "validation", None, None),
    (raw("[1]"), "validation", None, None),
    (raw('"5.1d"'), "validation", None, None),
    (raw('"nan"'), "validation", None, None),
    (raw('"inf"'), "validation", None, None),
    (raw("1e400"), "validation", None, None),
    (raw("NaN"), "json_decode", None, None),
    (without("sepal_length"), "validation", None, None),
    (body(sample_id=7.0), None, 5.1, 7),
    (body(sample_id="7"), None, 5.1, 7),
    (body(sample_id="7.0"), None, 5.1, 7),
    (body(sample_id=True), None, 5.1, 1),
    (body(sample_id=7.5), "validation", 5.1, None),
    (body(sample_id="7.5"), "validation", 5.1, None),
    (body(sample_id="x"), "validation", 5.1, None),
    (body(sample_id=0), None, 5.1, 0),
    (body(sample_id=None), None, 5.1, None),
    (body(sample_id=9007199254740993), None, 5.1, 9007199254740993),
    (body(timestamp=5), "validation", 5.1, 7),
    (body(timestamp=""), None, 5.1, 7),
    (body(timestamp=None), None, 5.1, 7),
    (body(extra=[1, {"a": 2}]), None, 5.1, 7),
    (b'{"sepal_length": 1, "sepal_length": 5.1, "sepal_width": 1, "petal_length": 1,'
     b' "petal_width": 1}', None, 5.1, None),
    (b"{bad json", "json_decode", None, None),
    (b"", "json_decode", None, None),
    (b"[1]", "json_decode", None, None),
    (b"5", "json_decode", None, None),
    (b"null", "json_decode", None, None),
    (b"\xff", "json_decode", None, None),
]


def test_feature_messages(check):
    rows = check(msg.read_feature_messages, [c[0] for c in FEATURE_CASES])
    for row, (payload, error, length, sample) in zip(rows, FEATURE_CASES):
        assert (row.error.error_type if row.error else None) == error, payload
        assert row.sepal_length == length, payload
        assert row.sample_id == sample, payload


INFERENCE_CASES = [
    (b'{"entity_id":"a","sample_id":1}', "a", None),
    (b'{"entity_id":"","sample_id":0}', "0_streaming", None),
    (b'{"entity_id":0,"sample_id":4}', "4_streaming", None),
    (b'{"sample_id":7.0}', "7.0_streaming", None),
    (b'{"sample_id":7.5}', "7.5_streaming", None),
    (b'{"sample_id":7}', "7_streaming", None),
    (b'{"entity_id":5}', "5", None),
    (b"{}", None, "missing_field"),
    (b'{"sample_id":null}', None, "missing_field"),
    (b"[1]", None, "json_decode"),
    (b"\xff", None, "json_decode"),
]


def test_inference_messages(check):
    rows = check(msg.read_inference_messages, [c[0] for c in INFERENCE_CASES])
    for row, (payload, entity, error) in zip(rows, INFERENCE_CASES):
        assert row.entity_id == entity, payload
        assert (row.error.error_type if row.error else None) == error, payload


def test_dead_letters_keep_what_was_sent(spark, check):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(
        [(bytearray(b"\xff"),), (bytearray(b"{bad"),)], "value binary"
    )
    failed = msg.refused(msg.read_feature_messages(frame))
    letters = msg.dead_letters(
        failed, "feature", "parse", F.current_timestamp(), payload=F.col("value")
    )
    assert {r.original_message for r in letters.collect()} == {"FF", "{bad"}


def test_long_error_is_cut(spark):
    from pyspark.sql import functions as F

    from tidemark.functions.scalars import truncated

    cut = spark.range(1).select(truncated(F.repeat(F.lit("x"), 3000)).alias("m")).first().m
    assert len(cut) == 2048


def test_payload_is_parsed_once(spark):
    frame = spark.createDataFrame([(bytearray(b"{}"),)], "value binary")
    plan = msg.accepted(msg.read_feature_messages(frame))._jdf.queryExecution()
    assert plan.executedPlan().toString().count("parseJson") == 1
