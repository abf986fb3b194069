"""Exact duplicates: frequent digests are settled map-side, all others by one shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import ascii_lower, documents, query, written

#: Digests that may be broadcast as winners, and counters of the frequent-items summary.
WINNERS, COUNTERS = 256, 4096


def frequent(digests: DataFrame, digest: str, winners: int, counters: int) -> DataFrame:
    """At most ``winners`` digests that may be frequent, by a mergeable Misra-Gries summary.

    Every task keeps ``counters`` counters and the summaries are merged, so memory is fixed.
    A digest with more than 1 / ``counters`` of all rows always holds a counter; one that is
    listed although it is rare costs nothing, since its rows are counted exactly afterwards.
    """
    top = digests.agg(F.expr(f"approx_top_k({digest}, {winners}, {counters})").alias("_top"))
    found = top.select(F.explode("_top").alias("_found"))
    return found.where(F.col("_found.count") > 1).select(F.col("_found.item").alias(digest))


def exact_groups(
    df: DataFrame, id_col: str, text: Column, winners: int = WINNERS, counters: int = COUNTERS
) -> DataFrame:
    """One row per input row: the digest of its text, its group's size and the row that stays.

    The largest id of equal texts stays; if rows share that id, all of them are marked as kept.
    Texts are compared by SHA-256.  A null text equals the empty one.  An empty table gives an
    empty result.  Columns: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.
    """
    hashed = df.select(
        F.col(id_col).alias("_id"),
        F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)).alias("_digest"),
    )
    rows = written(hashed, "digests")
    hexed = rows.select(F.hex("_digest").alias("_name"))
    often = frequent(hexed, "_name", winners, counters).select(F.unhex("_name").alias("_digest"))
    often = written(often, "frequent-digests")
    verified = (
        rows.join(F.broadcast(often), "_digest")
        .groupBy("_digest")
        .agg(F.max("_id").alias("_keep"), F.count("*").alias("_size"))
    )
    verified = written(verified, "winners")  # at most `winners` rows
    joined = rows.join(F.broadcast(verified), "_digest", "left")
    group = Window.partitionBy("_digest")
    rest = joined.where(F.col("_size").isNull()).select(
        "_id",
        "_digest",
        F.max("_id").over(group).alias("_keep"),
        F.count("*").over(group).alias("_size"),
    )
    settled = joined.where(F.col("_size").isNotNull()).select("_id", "_digest", "_keep", "_size")
    return settled.unionByName(rest).select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


@query(
    "op2_exact_dedup",
    """
    WITH d AS (
      SELECT doc_id, sha256(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
      FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
      doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def op2_exact_dedup(spark, folder):
    """Every document with the one of its group that stays."""
    return exact_groups(documents(spark, folder), "doc_id", ascii_lower(F.col("text")))
