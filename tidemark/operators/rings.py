"""Hourly and daily bucket rings per user, and their roll-up as of a moment.

A ring is a set of fixed-length arrays; slot = bucket number modulo ring length, and every
slot carries its own bucket number.  Readers ignore slots whose number lies outside the window,
so nothing has to be written for idle users.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import SCALARS, USER_ATTRIBUTES
from tidemark.functions.scalars import MONEY, unix_second
from tidemark.operators.velocity import cross_border
from tidemark.sources.tables import scan_source

NEVER = -1  # fixed value: bucket number of a slot that was never written
GLOBAL_USER = "__global__"  # fixed value: id of the row with population averages


@dataclass(frozen=True)
class Ring:
    prefix: str
    stamp: str
    seconds: int
    slots: int
    currencies: bool


HOURLY = Ring("hourly", "hourly_bucket_hour", 3_600, 24, False)
DAILY = Ring("daily", "daily_bucket_day", 86_400, 30, True)

def _members(rows: DataFrame, column: str) -> DataFrame:
    """Sorted distinct members per (user, bucket)."""
    distinct = rows.where(F.col(column).isNotNull()).select("user_id", "bucket", column).distinct()
    return distinct.groupBy("user_id", "bucket").agg(
        F.sort_array(F.collect_list(column)).alias("members")
    )


def buckets(transfers: DataFrame, ring: Ring, as_of: Column | None = None) -> DataFrame:
    """Per user and bucket: count, sum, max, cross-border count and member lists.

    With ``as_of`` only transfers of the ring's span up to that moment are used.
    """
    second = unix_second(F.col("created_at"))
    rows = transfers.withColumn("_sec", second)
    if as_of is not None:
        now = unix_second(as_of)
        span = ring.seconds * ring.slots
        rows = rows.where((F.col("_sec") >= now - span) & (F.col("_sec") <= now))
    rows = rows.select(
        F.col("sender_id").alias("user_id"),
        F.floor(F.col("_sec") / ring.seconds).alias("bucket"),
        "source_amount",
        "recipient_id",
        "target_currency",
        cross_border().alias("_cross"),
    )
    totals = rows.groupBy("user_id", "bucket").agg(
        F.count("*").alias("tx_count"),
        F.sum(F.col("source_amount").cast(MONEY)).cast("double").alias("amount_sum"),
        F.max("source_amount").alias("amount_max"),
        F.sum("_cross").alias("cross_border_count"),
    )
    lists = {"recipients": "recipient_id"}
    if ring.currencies:
        lists["currencies"] = "target_currency"
    result = totals
    for name, column in lists.items():
        found = _members(rows, column).select(
            F.col("user_id").alias("_u"), F.col("bucket").alias("_b"), F.col("members").alias(name)
        )
        same = F.col("user_id").eqNullSafe(F.col("_u")) & F.col("bucket").eqNullSafe(F.col("_b"))
        result = result.join(found, same, "left").drop("_u", "_b")
    empty = F.array().cast("array<string>")
    return result.withColumns({name: F.coalesce(name, empty) for name in lists})


def slot_rows(users: DataFrame, bucketed: DataFrame, ring: Ring) -> DataFrame:
    """Every user x slot, with the newest bucket of the slot or the empty default."""
    newest = _newest(bucketed, ring)
    spine = users.select("user_id").select(
        "user_id",
        F.explode(
            F.sequence(F.lit(0).cast("bigint"), F.lit(ring.slots - 1).cast("bigint"))
        ).alias("slot"),
    )
    return spine.join(newest, ["user_id", "slot"], "left").select(
        "user_id",
        "slot",
        F.coalesce("b.bucket", F.lit(NEVER).cast("bigint")).alias("bucket"),
        F.coalesce("b.tx_count", F.lit(0).cast("bigint")).alias("tx_count"),
        F.coalesce("b.amount_sum", F.lit(0.0)).alias("amount_sum"),
        F.coalesce("b.amount_max", F.lit(0.0)).alias("amount_max"),
        F.coalesce("b.cross_border_count", F.lit(0).cast("bigint")).alias("cross_border_count"),
    )


def _newest(bucketed: DataFrame, ring: Ring) -> DataFrame:
    fields = [c for c in bucketed.columns if c not in ("user_id", "slot")]
    return (
        bucketed.withColumn("slot", F.col("bucket") % ring.slots)
        .groupBy("user_id", "slot")
        .agg(F.max_by(F.struct(*fields), "bucket").alias("b"))
    )


def newest_slots(bucketed: DataFrame, ring: Ring) -> DataFrame:
    """One row per user and written slot: the newest bucket of the slot."""
    return _newest(bucketed, ring).select("user_id", "slot", "b.*")


def ring_arrays(bucketed: DataFrame, ring: Ring) -> DataFrame:
    """One row per user with the ring's arrays, position = slot."""
    collected = (
        _newest(bucketed, ring)
        .groupBy("user_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("slot", "b"))).alias("_by_slot"))
    )

    def array_of(field: str, default: Column) -> Column:
        slots = F.sequence(F.lit(0).cast("bigint"), F.lit(ring.slots - 1).cast("bigint"))
        return F.transform(
            slots, lambda i: F.coalesce(F.try_element_at("_by_slot", i).getField(field), default)
        )

    zero, none = F.lit(0).cast("bigint"), F.array().cast("array<string>")
    columns = [
        array_of("bucket", F.lit(NEVER).cast("bigint")).alias(ring.stamp),
        array_of("tx_count", zero).alias(f"{ring.prefix}_tx_count"),
        array_of("amount_sum", F.lit(0.0)).alias(f"{ring.prefix}_amount_sum"),
        array_of("amount_max", F.lit(0.0)).alias(f"{ring.prefix}_amount_max"),
        array_of("cross_border_count", zero).alias(f"{ring.prefix}_cross_border_count"),
        array_of("recipients", none).alias(f"{ring.prefix}_recipients"),
    ]
    if ring.currencies:
        columns.append(array_of("currencies", none).alias(f"{ring.prefix}_currencies"))
    return collected.select("user_id", *columns)


def user_rings(transfers: DataFrame, as_of: Column) -> DataFrame:
    """Hourly and daily rings of every user with a transfer in the last 30 days."""
    daily = ring_arrays(buckets(transfers, DAILY, as_of), DAILY)
    hourly = ring_arrays(buckets(transfers, HOURLY, as_of), HOURLY)
    return daily.join(hourly, "user_id", "left")


def read_time_merge(rings: DataFrame, as_of: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rings rolled up to the model-facing scalars as of a moment.

    Windows are whole buckets: one hour is the current clock hour, seven days are the last
    seven calendar days.
    """

    def live(ring: Ring, window: int) -> Column:
        now = F.floor(unix_second(as_of) / ring.seconds)
        fields = [c for c in rings.columns if c.startswith(f"{ring.prefix}_")]
        return F.filter(
            F.arrays_zip(*fields),
            lambda s: (s[ring.stamp] >= 0)
            & (s[ring.stamp] > now - window)
            & (s[ring.stamp] <= now),
        )

    def total(slots: Column, field: str) -> Column:
        start = F.lit(0.0) if "amount" in field else F.lit(0).cast("bigint")
        return F.aggregate(F.coalesce(slots, F.array()), start, lambda a, s: a + s[field])

    def distinct(slots: Column, field: str) -> Column:
        ids = F.flatten(F.transform(slots, lambda s: s[field]))
        return F.coalesce(F.size(F.array_distinct(ids)).cast("bigint"), F.lit(0).cast("bigint"))

    staged = rings.withColumns(
        {
            "_h1": live(HOURLY, 1),
            "_h24": live(HOURLY, 24),
            "_d7": live(DAILY, 7),
            "_d30": live(DAILY, 30),
        }
    )
    h1, h24, d7, d30 = (F.col(c) for c in ("_h1", "_h24", "_d7", "_d30"))
    count_7d = total(d7, "daily_tx_count")
    return staged.select(
        "user_id",
        *keep,
        total(h1, "hourly_tx_count").alias("tx_count_1h"),
        total(h24, "hourly_tx_count").alias("tx_count_24h"),
        count_7d.alias("tx_count_7d"),
        total(d30, "daily_tx_count").alias("tx_count_30d"),
        F.try_divide(total(d7, "daily_amount_sum"), count_7d).alias("avg_amount_7d"),
        F.array_max(F.transform(d7, lambda s: s["daily_amount_max"])).alias("max_amount_7d"),
        total(h24, "hourly_amount_sum").alias("total_amount_24h"),
        F.try_divide(total(d7, "daily_cross_border_count"), count_7d).alias(
            "cross_border_ratio_7d"
        ),
        distinct(d7, "daily_recipients").alias("unique_recipients_7d"),
        distinct(d7, "daily_currencies").alias("unique_currencies_7d"),
    )


def global_averages(features: DataFrame, source: str = "training") -> DataFrame:
    """The cold-start row: population averages of attributes and derived scalars.

    Where rows name their source, only those of one source are averaged.
    """
    if "source" in features.columns:
        features = scan_source(features, source)
    averaged = [c for c in features.columns if c in SCALARS or c in USER_ATTRIBUTES]
    return features.agg(
        F.lit(GLOBAL_USER).alias("user_id"),
        *[F.avg(F.col(c).cast("double")).alias(_global_name(c)) for c in averaged],
    )


def _global_name(column: str) -> str:
    return f"global_{column}" if column in SCALARS else column


def with_global_row(users: DataFrame, features: DataFrame) -> DataFrame:
    """User rows plus the cold-start row; columns only one side has are null on the other."""
    return users.unionByName(global_averages(features), allowMissingColumns=True)


def three_state(
    requests: DataFrame, users: DataFrame, global_row: DataFrame, as_of: Column, max_age_s: int
) -> DataFrame:
    """Scalars per request: unknown user, user with a stale row, or a normal user.

    ``users`` holds merged scalars and ``feature_timestamp`` per ``user_id``.
    """
    known = F.col("feature_timestamp").isNotNull()
    stale = known & (unix_second(as_of) - unix_second(F.col("feature_timestamp")) > max_age_s)
    state = F.when(~known, "global").when(stale, "stale").otherwise("live")
    defaults = global_row.select(F.struct(*[f"global_{c}" for c in SCALARS])).scalar()
    empty = {"avg_amount_7d", "max_amount_7d", "cross_border_ratio_7d"}

    def resolved(column: str) -> Column:
        idle = F.lit(None).cast("double") if column in empty else F.lit(0.0)
        return (
            F.when(F.col("state") == "global", F.col("_defaults").getField(f"global_{column}"))
            .when(F.col("state") == "stale", idle)
            .otherwise(F.col(column).cast("double"))
            .alias(column)
        )

    return (
        requests.join(users, "user_id", "left")
        .withColumn("state", state)
        .withColumn("_defaults", defaults)
        .select(*requests.columns, "state", *[resolved(c) for c in SCALARS])
    )


def reconcile(streamed: DataFrame, recomputed: DataFrame, key: list[str]) -> DataFrame:
    """Keys whose streamed values differ from the recomputed ones, and how.

    The recomputed side is the truth; writing it back repairs every listed key.
    """
    values = [c for c in recomputed.columns if c not in key]
    left = streamed.select(*key, F.struct(*values).alias("_streamed"))
    right = recomputed.select(
        *[F.col(k).alias(f"_{k}") for k in key], F.struct(*values).alias("_truth")
    )
    same = functools.reduce(
        Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    )
    status = (
        F.when(F.col("_streamed").isNull(), "missing")
        .when(F.col("_truth").isNull(), "extra")
        .when(~F.col("_streamed").eqNullSafe(F.col("_truth")), "different")
    )
    return (
        left.join(right, same, "full_outer")
        .withColumn("status", status)
        .where(F.col("status").isNotNull())
        .select(*[F.coalesce(k, f"_{k}").alias(k) for k in key], "status")
    )
