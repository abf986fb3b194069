"""Ring buckets: stale slots, idle and unknown users, parity with the trailing windows."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import rings, velocity
from tidemark.session import new_folder
from tidemark.sources.messages import file_stream
from tidemark.streaming.rings import RingState, RingStream

T0 = dt.datetime(2024, 1, 10)
SCHEMA = (
    "transfer_id string, sender_id long, recipient_id string, source_currency string,"
    " target_currency string, source_amount double, created_at timestamp, source string"
)


def transfer(i, sender, hours, amount=1.0, recipient="r", currency="EUR"):
    when = T0 + dt.timedelta(hours=hours)
    return (str(i), sender, recipient, "EUR", currency, amount, when, "training")


def moment(hours):
    return F.lit((T0 + dt.timedelta(hours=hours)).isoformat(sep=" ")).cast("timestamp")


def test_slot_of_an_earlier_lap_is_ignored(spark):
    df = spark.createDataFrame([transfer(0, 1, 0.5), transfer(1, 1, 30)], SCHEMA)
    hourly = rings.ring_arrays(rings.buckets(df, rings.HOURLY), rings.HOURLY)
    daily = rings.ring_arrays(rings.buckets(df, rings.DAILY), rings.DAILY)
    both = daily.join(hourly, "user_id", "left")
    fresh = rings.read_time_merge(both, moment(0.75)).first()
    assert (fresh.tx_count_1h, fresh.tx_count_24h) == (1, 1)
    day_later = rings.read_time_merge(both, moment(24.75)).first()
    assert (day_later.tx_count_1h, day_later.tx_count_24h) == (0, 0)


def test_idle_user_is_zero(spark):
    df = spark.createDataFrame([transfer(0, 1, 0)], SCHEMA)
    merged = rings.read_time_merge(rings.user_rings(df, moment(24 * 20)), moment(24 * 20)).first()
    assert (merged.tx_count_24h, merged.tx_count_7d, merged.tx_count_30d) == (0, 0, 1)
    assert merged.total_amount_24h == 0.0
    assert merged.avg_amount_7d is None and merged.max_amount_7d is None
    assert merged.unique_recipients_7d == 0


def test_a_bucket_of_200_recipients(spark):
    rows = [transfer(i, 1, 0, recipient=f"r{i:03d}") for i in range(200)]
    rows += [transfer(200, None, 0, amount=None)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = {r.user_id: r for r in rings.buckets(df, rings.HOURLY).collect()}
    assert kept[1].recipients == [f"r{i:03d}" for i in range(200)]
    assert kept[None].recipients == ["r"] and kept[None].tx_count == 1
    merged = rings.read_time_merge(rings.user_rings(df.where("sender_id = 1"), moment(1)), moment(1))
    assert merged.first().unique_recipients_7d == 200


def test_three_states(spark):
    scalars = ", ".join(f"{c} double" for c in rings.SCALARS)
    now = T0 + dt.timedelta(days=1)
    users = spark.createDataFrame(
        [(1, *[7.0] * 10, now), (2, *[7.0] * 10, T0)],
        f"user_id long, {scalars}, feature_timestamp timestamp",
    )
    row = spark.createDataFrame([tuple([3.0] * 10)], ", ".join(f"global_{c} double" for c in rings.SCALARS))
    asked = spark.createDataFrame([(1,), (2,), (9,)], "user_id long")
    got = {
        r.user_id: (r.state, r.tx_count_7d, r.avg_amount_7d)
        for r in rings.three_state(asked, users, row, moment(24), 3600).collect()
    }
    assert got == {1: ("live", 7.0, 7.0), 2: ("stale", 0.0, None), 9: ("global", 3.0, 3.0)}


def test_merge_equals_windows_on_aligned_data(spark):
    """At the end of a day, with every transfer on the hour, both definitions agree."""
    rows = [
        transfer(i, 1, -24 * d + h, amount=d + h / 100, recipient=f"r{(d * h) % 5}",
                 currency=("EUR", "USD")[d % 2])
        for i, (d, h) in enumerate((d, h) for d in range(6) for h in (1, 9, 23))
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    last = velocity.with_windows(df).orderBy(F.desc("created_at")).first()
    merged = rings.read_time_merge(rings.user_rings(df, moment(23)), moment(23)).first()
    for name in rings.SCALARS:
        if name not in ("tx_count_24h", "total_amount_24h"):
            a, b = last[name], merged[name]
            assert abs(a - b) < 1e-9, name


def test_reconcile(spark):
    schema = "user_id long, bucket long, n long"
    streamed = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 9, 1), (None, 1, 4)], schema)
    truth = spark.createDataFrame([(1, 1, 5), (1, 2, 7), (3, 3, 1), (None, 1, 4)], schema)
    got = {(r.user_id, r.status) for r in rings.reconcile(streamed, truth, ["user_id", "bucket"]).collect()}
    assert got == {(1, "different"), (3, "missing"), (2, "extra")}


def test_repair_replaces_corrupted_missing_and_extra_buckets(spark):
    base = new_folder(spark, "repair")
    live = RingStream(rings.HOURLY, f"{base}/rings", f"{base}/marks")
    assert live.latest(spark) is None

    def stream(name, rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{base}/{name}")
        return file_stream(spark, f"{base}/{name}", spark.createDataFrame([], SCHEMA).schema)

    right = [transfer(i, user, hour, recipient=f"r{i}") for i, (user, hour) in enumerate([(1, 0), (1, 1), (2, 1), (3, 2)])]
    last = [transfer(99, 9, 40)]  # closes the hours before it
    wrong = [transfer(0, 1, 0, amount=5.0, recipient="r0"), right[1], right[3], transfer(7, 4, 1)]
    live.start(stream("wrong", wrong + last), "0 seconds").awaitTermination()
    truth = rings.newest_slots(rings.buckets(spark.createDataFrame(right, SCHEMA), rings.HOURLY), rings.HOURLY)

    def found():
        return {(r.user_id, r.status) for r in live.differences(spark, truth).collect()}

    assert found() == {(1, "different"), (2, "missing"), (4, "extra")}
    assert live.repair(spark, truth) == 1 and live.run(spark) == 1
    assert found() == set()  # readers turn to the repaired rings at once
    # The next run reads all messages again and one more hour; only that hour is new.
    more = [transfer(50, 1, 3, amount=2.0)]
    live.start(stream("right", right + more + last), "0 seconds").awaitTermination()
    rows = {(r.user_id, r.bucket % 24): (r.tx_count, r.amount_sum, r.recipients) for r in live.latest(spark).collect()}
    assert found() == {(1, "extra")}
    hour = int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) // 3600
    assert rows[1, hour % 24] == (1, 1.0, ["r0"]) and rows[1, (hour + 3) % 24] == (1, 2.0, ["r"])
    assert len(rows) == 5


def test_averages_of_one_source(spark):
    name = rings.SCALARS[0]
    rows = spark.createDataFrame([(1.0, "training"), (3.0, "training"), (9.0, "batch_input")], f"{name} double, source string")
    users = spark.createDataFrame([("7", 1.0)], "user_id string, is_business double")
    got = {r.user_id: r[f"global_{name}"] for r in rings.with_global_row(users, rows).collect()}
    assert got == {"7": None, rings.GLOBAL_USER: 2.0}
    assert rings.global_averages(rows.drop("source")).first()[f"global_{name}"] == 13 / 3


def test_users_of_a_group_share_a_state_value():
    """One call reads and one writes, however many users and slots a micro-batch brings."""

    class Value:
        value, calls = None, 0

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls, self.value = self.calls + 1, value

    def came(rows):
        names = ["user_id", "bucket", "tx_count", "amount_sum", "amount_max", "cross_border_count", "recipients"]
        return iter([pd.DataFrame([(u, n, k, 1.0, 1.0, 0, f"a\x1f{u}") for u, n, k in rows], columns=names)])

    state, processor = Value(), RingState(24)
    processor._group = state
    first = [(u, n, 1) for u in ("1", None, "x") for n in range(30)]
    out = pd.concat(processor.handleInputRows((0,), came(first), None))
    assert state.calls == 2 and len(out) == 72 and out["bucket"].min() == 6
    # An earlier lap and the same bucket again change nothing; only touched users are emitted.
    assert not list(processor.handleInputRows((0,), came([("x", 5, 9), ("x", 29, 9)]), None))
    again = pd.concat(processor.handleInputRows((0,), came([(None, 30, 7)]), None))
    assert again["user_id"].isna().all() and len(again) == 24
    assert again.loc[again["slot"] == 6, "tx_count"].tolist() == [7]
    assert again["recipients"].map(len).eq(2).all()
