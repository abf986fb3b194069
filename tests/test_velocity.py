"""Trailing windows against brute force on a fixture with a hot sender."""

import datetime as dt
import random
from collections import Counter

import pytest

from tidemark.operators import velocity

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
DAY = 86_400


def transfers():
    draw = random.Random(5)
    rows = []

    def add(sender, second, micros=0):
        at = START + dt.timedelta(seconds=second, microseconds=micros)
        rows.append(
            (
                f"t{len(rows)}",
                sender,
                draw.choice(["r1", "r2", "r3", "r4", None]),
                "EUR",
                draw.choice(["EUR", "USD", "GBP", None]),
                draw.choice([None, *[round(draw.uniform(0, 500), 2)] * 5]),
                at.replace(tzinfo=None),
                "training",
            )
        )

    for _ in range(300):  # a hot sender, many transfers in the same second
        add(1, draw.randrange(40 * DAY) // 1800 * 1800, draw.randrange(1_000_000))
    for edge in (0, 3600, 3601, DAY, DAY + 1, 7 * DAY - 1, 7 * DAY, 7 * DAY + 1, 30 * DAY):
        add(2, edge)
        add(2, edge, 999_999)
    add(3, 3 * DAY - 1)  # last second of a day, seen again exactly a week later and after
    add(3, 10 * DAY - 1)
    add(4, 3 * DAY - 1)
    add(4, 10 * DAY)
    for _ in range(4):  # transfers without a sender form a group of their own
        add(None, draw.randrange(2 * DAY))
    return rows


def brute(rows):
    expected = {}
    for row in rows:
        now = int((row[6].replace(tzinfo=dt.timezone.utc) - START).total_seconds() // 1)

        def frame(width, now=now, sender=row[1]):
            return [
                r
                for r in rows
                if r[1] == sender
                and now - width
                <= (r[6].replace(tzinfo=dt.timezone.utc) - START).total_seconds() // 1
                <= now
            ]

        week, day = frame(7 * DAY), frame(DAY)
        amounts = [r[5] for r in week if r[5] is not None]
        today = [r[5] for r in day if r[5] is not None]
        expected[row[0]] = (
            len(frame(3600)),
            len(day),
            len(week),
            len(frame(30 * DAY)),
            pytest.approx(sum(amounts) / len(amounts)) if amounts else None,
            max(amounts, default=None),
            pytest.approx(sum(today)) if today else None,
            pytest.approx(
                sum(1 for r in week if r[4] is not None and r[3] != r[4]) / len(week)
            ),
            len({r[2] for r in week} - {None}),
            len({r[4] for r in week} - {None}),
        )
    return expected


SCHEMA = (
    "transfer_id string, sender_id long, recipient_id string, source_currency string,"
    " target_currency string, source_amount double, created_at timestamp_ntz, source string"
)


def test_windows_match_brute_force(spark):
    rows = transfers()
    expected = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    got = velocity.with_windows(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert expected[r.transfer_id] == (
            r.tx_count_1h,
            r.tx_count_24h,
            r.tx_count_7d,
            r.tx_count_30d,
            r.avg_amount_7d,
            r.max_amount_7d,
            r.total_amount_24h,
            r.cross_border_ratio_7d,
            r.unique_recipients_7d,
            r.unique_currencies_7d,
        ), r


def test_equal_branches_share_their_shuffles(spark):
    features = velocity.window_features(spark.createDataFrame(transfers(), SCHEMA))
    features.collect()
    assert "Reused" in features._jdf.queryExecution().executedPlan().toString()


def test_transfers_without_a_time_form_a_group(spark):
    rows = spark.sql(
        "select cast(id as string) as transfer_id, 'training' as source, 's' as sender_id, "
        "cast(id % 3 as string) as recipient_id, 'EUR' as source_currency, "
        "'USD' as target_currency, double(id) as source_amount, "
        "if(id >= 5, null, timestamp_seconds(1700000000 + id * 60)) as created_at from range(7)"
    )
    got = {
        r.transfer_id: (r.tx_count_7d, r.total_amount_24h, r.unique_recipients_7d)
        for r in velocity.with_windows(rows).collect()
    }
    assert len(got) == 7
    assert got["4"] == (5, 10.0, 3)
    assert got["5"] == got["6"] == (2, 11.0, 2)


def test_a_sender_of_100_000_transfers_in_a_day(spark):
    rows = spark.sql(
        "select cast(id as string) as transfer_id, 'training' as source, 's' as sender_id, "
        "cast(id % 5000 as string) as recipient_id, 'EUR' as source_currency, "
        "'USD' as target_currency, 1.0D as source_amount, "
        "timestamp_seconds(1700006400 + id % 80000) as created_at from range(100000)"
    )
    made = velocity.with_windows(rows)
    assert made.count() == 100_000
    last = made.where("transfer_id = '79999'").first()
    assert (last.tx_count_24h, last.unique_recipients_7d) == (100_000, 5000)


def test_sorted_changes_of_a_task_do_not_grow(spark, monkeypatch):
    rows = transfers()[:200]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = Counter(map(str, velocity.window_features(df).collect()))
    monkeypatch.setattr(velocity, "TASK_ROWS", 60)  # 9 changes a transfer: 30 partitions
    spread = velocity.window_features(df)
    text = spread._jdf.queryExecution().executedPlan().toString()
    assert "_day" in text and ", 30), REPARTITION_BY_NUM" in text
    assert Counter(map(str, spread.collect())) == plain
