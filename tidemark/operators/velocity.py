"""Trailing-window features per sender over transfers, exact and safe for a hot sender.

Frames are ranges of whole seconds that include the current second.  Spark's sliding frames would
cost rows x frame length for a busy sender.  Transfers are therefore combined per second, so a
sender has at most one row per second of history however many transfers it makes, and trailing
sums become running totals: a second adds its amount when it enters a frame and subtracts it when
it leaves.  That is linear, and runs are cut into days (see ordered.py).  Every sender goes this
way, so features do not depend on how many transfers a sender has.

Amounts are summed as decimals, so adding and subtracting leaves no residue.  Transfers without a
time form a group of their own per sender: each sees all of them and no others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contract import SCALARS
from tidemark.functions.scalars import (
    MONEY,
    country_risk,
    day_of_week,
    days_since,
    flag,
    hour_of_day,
    safe_divide,
    unix_second,
)

HOUR, DAY, WEEK, MONTH = 3_600, 86_400, 604_800, 2_592_000
FRAMES = {"1h": HOUR, "24h": DAY, "7d": WEEK, "30d": MONTH}  # frame lengths in seconds

WINDOW_FEATURES = SCALARS

# Kinds of change: a second enters all frames, leaves the frame of that many seconds, or a
# distinct member comes (+1) or goes (-1).
ENTER, RECIPIENT, CURRENCY = 0, 1, 2

# Measure -> (summed column, frame it is summed over).
ADDITIVE = {
    **{f"tx_count_{frame}": ("_n", seconds) for frame, seconds in FRAMES.items()},
    "_known_24h": ("_known", DAY),
    "_known_7d": ("_known", WEEK),
    "_amount_24h": ("_amount", DAY),
    "_amount_7d": ("_amount", WEEK),
    "_cross_7d": ("_cross", WEEK),
}
DISTINCT = {
    "unique_recipients_7d": ("recipient_id", RECIPIENT),
    "unique_currencies_7d": ("target_currency", CURRENCY),
}
MEASURES = [*ADDITIVE, *DISTINCT]

#: Changes that a task sorts, and changes that a transfer makes at most.
TASK_ROWS = 500_000
MOST_CHANGES = 1 + len(FRAMES) + 2 * len(DISTINCT)


def cross_border() -> Column:
    return flag(F.col("source_currency") != F.col("target_currency"))


def _keyed(transfers: DataFrame) -> DataFrame:
    return transfers.withColumn("_sec", unix_second(F.col("created_at")))


def per_second(transfers: DataFrame) -> DataFrame:
    """Transfers combined per sender and second."""
    return (
        _keyed(transfers)
        .groupBy("sender_id", "_sec")
        .agg(
            F.count("*").alias("_n"),
            F.count("source_amount").alias("_known"),
            F.coalesce(F.sum(F.col("source_amount").cast(MONEY)), F.lit(0))
            .cast("decimal(38,9)")
            .alias("_amount"),
            F.sum(cross_border()).alias("_cross"),
            F.max("source_amount").alias("_max"),
        )
    )


_CHANGE = ["sender_id", "_at", "_kind", "_n", "_known", "_amount", "_cross", "_max"]


def _entering_and_leaving(seconds: DataFrame) -> DataFrame:
    """Five rows per second: it enters every frame and leaves each of the four."""
    kinds = F.explode(F.array(*[F.lit(k) for k in (ENTER, *FRAMES.values())]))
    at = F.col("_sec") + F.when(F.col("_kind") == ENTER, 0).otherwise(F.col("_kind") + 1)
    changes = seconds.withColumn("_kind", kinds).withColumn("_at", at).select(*_CHANGE)
    return changes.where((F.col("_kind") == ENTER) | F.col("_at").isNotNull())


def _distinct_changes(transfers: DataFrame, member: str, kind: int) -> DataFrame:
    """+1 when a member is seen, -1 when it is seen again or a week has passed.

    Changes are combined per second, so members do not multiply a sender's rows.
    """
    seen = (
        _keyed(transfers)
        .where(F.col(member).isNotNull())
        .select("sender_id", F.col(member).alias("_member"), "_sec")
        .distinct()
    )
    by_member = Window.partitionBy("sender_id", "_member", F.col("_sec").isNull()).orderBy("_sec")
    left = F.least(F.lead("_sec").over(by_member), F.col("_sec") + WEEK + 1)
    both = F.array(
        *[
            F.struct(at.alias("_at"), F.lit(by).cast("bigint").alias("_n"))
            for at, by in ((F.col("_sec"), 1), (F.col("_left"), -1))
        ]
    )
    zero = F.lit(0).cast("bigint")
    return (
        seen.withColumn("_left", left)
        .select("sender_id", F.explode(both).alias("c"))
        .where("c._at is not null or c._n > 0")
        .groupBy("sender_id", F.col("c._at").alias("_at"))
        .agg(F.sum("c._n").alias("_n"))
        .where("_n != 0")
        .select(
            "sender_id",
            "_at",
            F.lit(kind).alias("_kind"),
            "_n",
            zero.alias("_known"),
            F.lit(0).cast("decimal(38,9)").alias("_amount"),
            zero.alias("_cross"),
            F.lit(None).cast("double").alias("_max"),
        )
    )


def _signed(measure: str) -> Column:
    """What a change adds to a measure."""
    kind = F.col("_kind")
    if measure in DISTINCT:
        return F.when(kind == DISTINCT[measure][1], F.col("_n")).otherwise(0)
    column, frame = ADDITIVE[measure]
    return (
        F.when(kind == ENTER, F.col(column)).when(kind == frame, -F.col(column)).otherwise(0)
    ).cast("decimal(38,9)" if column == "_amount" else "bigint")


def _spread(changes: DataFrame, rows: int) -> DataFrame:
    """Senders' days in as many partitions as keep a task's sorts at one size, whatever ``rows``.

    Left to itself, Spark joins partitions by their compressed bytes, of which changes have few.
    """
    parts = math.ceil(rows * MOST_CHANGES / TASK_ROWS)
    if parts <= changes.sparkSession.sparkContext.defaultParallelism:
        return changes
    return changes.repartition(parts, "sender_id", "_day")


def window_features(transfers: DataFrame) -> DataFrame:
    """Trailing features per (sender_id, second), linear in the number of rows."""
    changes = _entering_and_leaving(per_second(transfers))
    for member, kind in DISTINCT.values():
        changes = changes.unionByName(_distinct_changes(transfers, member, kind))
    changes = changes.withColumn("_day", F.floor(F.col("_at") / DAY))
    changes = _spread(changes, transfers.count())
    entering = F.when(F.col("_kind") == ENTER, F.col("_max"))
    leaving = F.when(F.col("_kind") == WEEK, F.col("_max"))

    in_day = Window.partitionBy("sender_id", "_day").orderBy("_at")
    so_far = in_day.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # Seconds of the day one week earlier that are still inside the frame leave it later today
    # (its last second leaves at midnight and is carried with the day totals).
    not_yet_left = (
        Window.partitionBy("sender_id", "_day")
        .orderBy(F.desc("_at"))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    today = changes.select(
        "sender_id",
        "_day",
        "_at",
        "_kind",
        *[F.sum(_signed(m)).over(so_far).alias(m) for m in MEASURES],
        F.greatest(F.max(entering).over(so_far), F.max(leaving).over(not_yet_left)).alias(
            "_max_ends"
        ),
    ).where(F.col("_kind") == ENTER)

    last_second = F.col("_at") % DAY == DAY - 1
    per_day = changes.groupBy("sender_id", "_day").agg(
        *[F.sum(_signed(m)).alias(m) for m in MEASURES],
        F.max(entering).alias("_day_max"),
        F.max(F.when(last_second, entering)).alias("_last_second_max"),
    )
    days = Window.partitionBy("sender_id", F.col("_day").isNull()).orderBy("_day")
    earlier = days.rowsBetween(Window.unboundedPreceding, -1)
    carry = per_day.select(
        F.col("sender_id").alias("_s"),
        F.col("_day").alias("_d"),
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_pre_{m}") for m in MEASURES],
        F.greatest(
            F.max("_day_max").over(days.rangeBetween(-6, -1)),
            F.max("_last_second_max").over(days.rangeBetween(-7, -7)),
        ).alias("_max_between"),
    )
    totals = today.join(
        carry, F.col("sender_id").eqNullSafe(F.col("_s")) & F.col("_day").eqNullSafe(F.col("_d"))
    ).select(
        "sender_id",
        F.col("_at").alias("_sec"),
        *[(F.col(m) + F.col(f"_pre_{m}")).alias(m) for m in MEASURES],
        F.greatest("_max_ends", "_max_between").alias("max_amount_7d"),
    )
    return totals.select("sender_id", "_sec", *_finished())


def _finished() -> list[Column]:
    """The features from the summed measures."""
    derived = {
        "avg_amount_7d": safe_divide(F.col("_amount_7d"), F.col("_known_7d")),
        "total_amount_24h": F.when(F.col("_known_24h") > 0, F.col("_amount_24h").cast("double")),
        "cross_border_ratio_7d": safe_divide(F.col("_cross_7d"), F.col("tx_count_7d")),
    }
    return [derived.get(n, F.col(n)).alias(n) for n in WINDOW_FEATURES]


def with_windows(transfers: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Transfers with the trailing features of their sender, and its attributes if given.

    ``users`` is keyed by ``user_id``; transfers of senders it lacks are dropped.
    """
    features = window_features(transfers).withColumnsRenamed({"sender_id": "_s", "_sec": "_t"})
    if users is not None:
        # Joined here, users meet one row per second of a hot sender, not every transfer.
        features = features.join(users, F.col("_s") == F.col("user_id"))
    match = F.col("sender_id").eqNullSafe(F.col("_s")) & F.col("_sec").eqNullSafe(F.col("_t"))
    return _keyed(transfers).join(features, match).drop("_s", "_t", "_sec")


def user_attributes(users: DataFrame) -> DataFrame:
    """Model-facing attributes of users; the registration date is carried through."""
    return users.select(
        "user_id",
        "registration_date",
        flag(F.col("account_type") == "Business").alias("is_business"),
        flag(F.col("kyc_status") == "Verified").alias("is_kyc_verified"),
        country_risk(F.col("country_of_residence")).alias("country_risk_score"),
        "label",
    )


def transfer_features(transfers: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    """The transfer-grained feature table: windows, calendar parts and user attributes."""
    # The join with users drops transfers without a sender; dropping them first keeps the
    # branches of the window plan equal, so their shuffles are reused.
    sent = transfers.where(F.col("sender_id").isNotNull())
    joined = with_windows(sent, user_attributes(users))
    ts = F.col("created_at")
    return joined.select(
        F.concat(F.col("transfer_id"), F.lit("_"), F.col("source")).alias("entity_id"),
        "transfer_id",
        "sender_id",
        "source",
        "source_amount",
        "created_at",
        cross_border().alias("is_cross_border"),
        hour_of_day(ts).alias("hour_of_day"),
        day_of_week(ts).alias("day_of_week"),
        *WINDOW_FEATURES,
        days_since(F.col("registration_date"), ts).alias("account_age_days"),
        "is_business",
        "is_kyc_verified",
        "country_risk_score",
        safe_divide(F.col("source_amount"), F.col("avg_amount_7d")).alias("amount_ratio_to_avg"),
        "label",
        as_of.cast("timestamp").alias("feature_timestamp"),
    )
