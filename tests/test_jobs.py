"""The jobs end to end on a small table with a learnable label."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.contract import DEAD_LETTER_SCHEMA, FEATURE_SCHEMA, PREDICTION_SCHEMA, RAW_SCHEMA
from tidemark.operators.online import OnlineStore
from tidemark.session import new_folder
from tidemark.sources import tables
from tidemark.streaming.metrics import stage_counts, stage_latency
from tidemark.streaming.progress import ProgressMetrics

NAMES = ["sepal_length_cm", "sepal_width_cm", "petal_length_cm", "petal_width_cm"]
T0 = dt.datetime(2024, 1, 1)


def samples(n, source):
    draw = random.Random(n)
    kinds = [("Iris-setosa", 1.0), ("Iris-versicolor", 4.0), ("Iris-virginica", 6.0)]
    rows = []
    for i in range(n):
        species, centre = kinds[i % 3]
        petal = centre + draw.uniform(-0.4, 0.4)
        label = species if source == "training" else None
        rows.append((i + 1, 5.0 + draw.random(), 3.0, petal, petal / 3, label, source, T0))
    return rows


def test_batch_pipeline(spark):
    base = new_folder(spark, "jobs")
    path = {n: f"{base}/{n}" for n in ("raw", "input", "features", "store", "model", "out", "work")}
    assert not jobs.ingest(spark, path["raw"], path["input"], path["features"])
    for name, source, n in (("raw", "training", 150), ("input", "batch_input", 20)):
        spark.createDataFrame(samples(n, source), RAW_SCHEMA).write.parquet(path[name])
    assert jobs.ingest(spark, path["raw"], path["input"], path["features"])
    stored = spark.read.schema(FEATURE_SCHEMA).parquet(path["features"])
    assert stored.count() == 170

    jobs.sync(spark, path["features"], path["store"])
    snapshot = OnlineStore(spark, path["store"], "entity_id", NAMES).snapshot()
    assert snapshot.count() == 170

    metrics = jobs.train(spark, path["features"], path["work"], path["model"], trees=5).collect()
    assert {(r.model, r.split) for r in metrics} == {
        (m, s) for m in ("decision_tree", "random_forest") for s in ("holdout", "test")
    }
    sizes = {r.split: r["count"] for r in spark.read.parquet(f"{base}/work/nested").groupBy("split").count().collect()}
    assert sizes == {"fit": 96, "holdout": 24, "test": 30}
    assert all(r.accuracy > 0.9 for r in metrics)

    for _ in range(2):
        jobs.batch_inference(spark, path["features"], path["model"], path["out"])
    out = spark.read.parquet(path["out"])
    assert out.count() == 40
    assert out.select("prediction_timestamp").distinct().count() == 2

    asked = [json.dumps({"entity_id": f"{i}_training"}) for i in (1, 2, 3)] + ["{}"]
    messages = f"{base}/requests"
    spark.createDataFrame([(bytearray(a.encode()),) for a in asked], "value binary").write.parquet(messages)
    jobs.create_tables(spark, predictions=f"{base}/predictions", dead_letters=f"{base}/letters")
    jobs.inference_stream(
        spark, messages, path["store"], path["model"], f"{base}/predictions", f"{base}/marks",
        dead_letters=f"{base}/letters", available_now=True,
    )
    made = tables.read_batches(spark, f"{base}/predictions", PREDICTION_SCHEMA).collect()
    assert {r.entity_id: r.prediction for r in made} == {
        "1_training": "2", "2_training": "0", "3_training": "1"
    }
    letters = tables.read_batches(spark, f"{base}/letters", DEAD_LETTER_SCHEMA).collect()
    assert [r.error_type for r in letters] == ["missing_field"]


def test_feature_job_and_options(spark):
    base = new_folder(spark, "feature-job")
    body = {"sepal_length": 1, "sepal_width": 1, "petal_length": 2, "petal_width": 3, "sample_id": 4}
    rows = [(bytearray(json.dumps(body).encode()),), (bytearray(b"nope"),)]
    spark.createDataFrame(rows, "value binary").write.parquet(f"{base}/in")
    jobs.create_tables(spark, features=f"{base}/features", dead_letters=f"{base}/letters")
    options = vars(
        jobs.parser().parse_args(
            ["feature_stream", "--source", f"{base}/in", "--features", f"{base}/features",
             "--store", f"{base}/store", "--checkpoint", f"{base}/marks",
             "--dead_letters", f"{base}/letters", "--metrics", f"{base}/metrics",
             "--progress", f"{base}/progress", "--available_now"]
        )
    )
    assert options.pop("job") == "feature_stream"
    jobs.feature_stream(spark, **options)
    rows = tables.read_batches(spark, f"{base}/features", FEATURE_SCHEMA).collect()
    assert [r.entity_id for r in rows] == ["4_streaming"]
    assert tables.read_batches(spark, f"{base}/letters", DEAD_LETTER_SCHEMA).count() == 1

    # Spark's own report of its triggers (a last one moves the watermark on), in the same form as the stages' metrics.
    heard = spark.read.parquet(f"{base}/progress/*")
    counts = {(r.job, r.stage, r.name): r.total for r in stage_counts(heard).collect()}
    triggers = counts["feature", "trigger", "triggers"]
    assert triggers in (1, 2)
    assert counts["feature", "trigger", "rows_in"] == 2
    waits = {r.stage: r for r in stage_latency(heard).collect()}
    assert waits["triggerExecution"].rows == triggers
    assert 0 < waits["addBatch"].p99 <= waits["triggerExecution"].p99
    both = heard.unionByName(spark.read.parquet(f"{base}/metrics/*"))
    assert {"parse", "offline", "online", "trigger"} <= {r.stage for r in stage_counts(both).collect()}

    # A batch refresh of the same table leaves the streamed rows alone.
    spark.createDataFrame(samples(3, "training"), RAW_SCHEMA).write.parquet(f"{base}/raw")
    for _ in range(2):
        jobs.ingest(spark, f"{base}/raw", f"{base}/none", f"{base}/features")
    rows = tables.read_batches(spark, f"{base}/features", FEATURE_SCHEMA).collect()
    assert sorted(r.source for r in rows) == ["streaming", "training", "training", "training"]
    jobs.ingest(spark, f"{base}/raw", f"{base}/none", f"{base}/features", full=True)
    assert tables.read_batches(spark, f"{base}/features", FEATURE_SCHEMA).count() == 3


def test_listener_keeps_what_it_cannot_write(spark):
    """Observed counters are stages; samples of a failed write come with the next one."""
    base = new_folder(spark, "listener")
    listener = ProgressMetrics(spark, f"{base}/file", flush_triggers=1)
    with open(f"{base.removeprefix('file:')}-blocker", "w") as blocker:
        blocker.write("a file where a folder is wanted")
    listener._path = f"{base}-blocker"
    spark.range(7).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("id long").parquet(f"{base}/in").observe(
        "seen", F.count("*").alias("success"), F.count_if(F.col("id") > 4).alias("error")
    )
    writer = stream.writeStream.format("noop").trigger(availableNow=True)
    query = listener.follow(writer.option("checkpointLocation", f"{base}/marks").start(), "watched")
    query.awaitTermination()
    listener._ended[str(query.runId)].wait(30)
    listener._path = f"{base}/progress"
    listener.close()
    counts = {
        (r.job, r.stage, r.name): r.total
        for r in stage_counts(spark.read.parquet(f"{base}/progress/*")).collect()
    }
    assert counts["watched", "seen", "success"] == 7 and counts["watched", "seen", "error"] == 2
    assert counts["watched", "trigger", "rows_in"] == 7
