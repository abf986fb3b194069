"""Reproducible splits: exact row splits, out-of-time user-disjoint splits, time folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import hash_bucket
from tidemark.operators.ordered import exact_quantiles, running_totals

SPLIT_SEED = 42
COPY_BLOCK = 1_000_000

# Identifier and time columns that never enter a feature matrix.
ID_COLUMNS = (
    "label",
    "sender_id",
    "recipient_id",
    "transfer_id",
    "entity_id",
    "created_at",
    "feature_timestamp",
    "source",
    "split",
)


def row_digest(columns: Sequence[str], seed: int) -> Column:
    """md5 of the row's values and the seed; equal rows get equal digests."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def _copies(df: DataFrame, count: str) -> DataFrame:
    """Each row ``count`` times; large counts are spread over tasks block by block."""
    blocks = df.withColumn(
        "_block",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(count) - 1) / COPY_BLOCK))),
    ).repartition("_block", *[c for c in df.columns if c != count])
    size = F.least(F.lit(COPY_BLOCK), F.col(count) - F.col("_block") * COPY_BLOCK)
    return blocks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), size))).drop(
        "_block", "_copy", count
    )


def train_test_split(
    df: DataFrame,
    key: Sequence[str],
    test_share: float = 0.2,
    seed: int = SPLIT_SEED,
    column: str = "split",
) -> DataFrame:
    """Labels exactly ceil(share * n) rows 'test', the rest 'train', in seeded md5 order.

    A histogram over the first four hex digits of the digest (at most 65536 rows) finds the
    one digest bucket the cut falls into.  All other rows are labelled by a map-only pass;
    only that bucket is ranked, in chunks by further digits, with equal rows counted together.
    """
    digest = row_digest(key, seed)
    bucket = F.substring(digest, 1, 4)
    histogram = df.select(bucket.alias("_b")).groupBy("_b").agg(F.count("*").alias("_n"))
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = histogram.select("_b", "_n", F.sum("_n").over(upto).alias("_upto"))
    total = histogram.agg(F.ceil(F.sum("_n") * F.lit(test_share)).cast("bigint").alias("_want"))
    cut = (
        sized.withColumn("_want", total.scalar())
        .where(F.col("_upto") >= F.col("_want"))
        .agg(
            F.struct(
                F.min("_b").alias("bucket"),
                F.min_by(F.col("_want") - (F.col("_upto") - F.col("_n")), "_b").alias("need"),
            )
        )
        .scalar()
    )
    placed = df.withColumns(
        {"_b": bucket, "_cut": cut.getField("bucket"), "_need": cut.getField("need")}
    )
    clear = placed.where(F.col("_b") != F.col("_cut")).select(
        *df.columns, F.when(F.col("_b") < F.col("_cut"), "test").otherwise("train").alias(column)
    )
    inside = (
        placed.where(F.col("_b") == F.col("_cut"))
        .withColumn("_digest", digest)
        .groupBy(*df.columns, "_digest", "_need")
        .agg(F.count("*").alias("_m"))
    )
    # Each further digit of the digest is a level of the ranking, so the bucket may be large, too.
    deeper = [F.substring("_digest", at, 2) for at in (5, 7)]
    order = [F.col(c) for c in ("_digest", *df.columns)]
    ranked = running_totals(inside, [], deeper, order, {"_upto": F.col("_m")})
    in_test = F.greatest(
        F.lit(0), F.least(F.col("_m"), F.col("_need") - (F.col("_upto") - F.col("_m")))
    )
    shares = ranked.withColumn("_test", in_test).select(
        *df.columns,
        F.explode(
            F.array(
                F.struct(F.lit("test").alias("s"), F.col("_test").alias("c")),
                F.struct(F.lit("train").alias("s"), (F.col("_m") - F.col("_test")).alias("c")),
            )
        ).alias("_part"),
    )
    boundary = _copies(
        shares.where(F.col("_part.c") > 0).select(
            *df.columns, F.col("_part.s").alias(column), F.col("_part.c").alias("_m")
        ),
        "_m",
    )
    return clear.unionByName(boundary)


def nested_split(outer: DataFrame, key: Sequence[str], seed: int = SPLIT_SEED + 1) -> DataFrame:
    """Splits the train part of a stored outer split again: 'fit', 'holdout' and 'test'."""
    rows = outer.where("split = 'train'").drop("split")
    inner = train_test_split(rows, key, seed=seed, column="_inner")
    named = F.when(F.col("_inner") == "test", "holdout").otherwise("fit")
    return inner.select(*rows.columns, named.alias("split")).unionByName(
        outer.where("split = 'test'")
    )


def cutoff(df: DataFrame, time: str, share: float = 0.8) -> DataFrame:
    """One row: the continuous percentile of a timestamp in epoch microseconds."""
    micros = df.select(F.unix_micros(F.col(time).cast("timestamp")).alias("_us"))
    day = F.floor(F.col("_us") / 86_400_000_000)
    return exact_quantiles(micros, [], "_us", {"cutoff_us": share}, chunk=day)


def time_user_split(
    df: DataFrame,
    user: str,
    time: str,
    seed: int = SPLIT_SEED,
    share: float = 0.8,
    calib_percent: int = 20,
) -> DataFrame:
    """'fit', 'calib' and 'test' that share no user; test lies after the cutoff.

    Users with any row at or after the cutoff belong to test and lose their earlier rows.
    """
    late = F.unix_micros(F.col(time).cast("timestamp")) >= F.col("cutoff_us")
    placed = df.withColumn("cutoff_us", cutoff(df, time, share).scalar()).withColumn("_late", late)
    test_users = placed.where("_late").select(user).distinct()
    test = placed.where("_late").withColumn("split", F.lit("test"))
    train = (
        placed.where("not _late")
        .join(test_users, user, "left_anti")
        .withColumn(
            "split",
            F.when(hash_bucket(F.col(user), seed) < calib_percent, "calib").otherwise("fit"),
        )
    )
    return test.unionByName(train).drop("_late", "cutoff_us")


def time_series_folds(
    df: DataFrame, order: Sequence[Column], chunk: Sequence[Column], folds: int = 5
) -> DataFrame:
    """Adds ``fold``: 1..folds validate on a later slice than they train on, 0 never validates.

    ``order`` has to be unique.
    """
    total = df.agg(F.count("*").alias("_n"))
    ranked = running_totals(df, [], chunk, order, {"_rank": F.lit(1)})
    size = F.expr(f"_n div {folds + 1}")
    from_end = F.floor((F.col("_n") - F.col("_rank")) / size)
    return (
        ranked.withColumn("_n", total.scalar())
        .withColumn("fold", F.greatest(F.lit(0), F.lit(folds) - from_end).cast("bigint"))
        .drop("_n", "_rank")
    )


def split_floor(df: DataFrame, label: str, floor: int, split: str = "split") -> DataFrame:
    """Rows and positives per split; fails the job when a split has fewer than ``floor``."""
    counts = df.groupBy(split).agg(
        F.count("*").alias("rows"), F.count_if(F.col(label) == 1).alias("positives")
    )
    enough = F.when(F.col("positives") >= floor, F.col("positives")).otherwise(
        F.raise_error(F.concat(F.lit("too few positives in split "), F.col(split))).cast("bigint")
    )
    return counts.withColumn("positives", enough)


def drop_id_columns(df: DataFrame) -> DataFrame:
    return df.drop(*ID_COLUMNS)
