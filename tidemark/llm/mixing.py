"""Mixing sources to target weights by Efraimidis-Spirakis sampling without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import WORD, documents, query, scratch, written

#: Source weights by rank, repeating; share of all words to take; most copies of a document.
WEIGHTS, SHARE, REPEATS = (3, 1, 2), 1.5, 2
#: Rows of a source for each chunk of its sampling order.
CHUNK_ROWS = 4096


def symbol_quality(text: Column, size: Column) -> Column:
    """Quality weight in (0, 1]: falls with the number of symbols per word."""
    symbols = F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>!]")), F.lit(0))
    return F.lit(1.0) / (F.lit(1.0) + symbols / F.greatest(size, F.lit(1)))


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: ``source_size``, ``target``, full ``epochs`` and the ``rest`` of words.

    A source is full (at its cap) if filling all sources in proportion to their weights up to
    the level at which it is full takes no more than all there is to share; the others get
    their weight's part of what the full ones leave.  One row per source meets in one task.
    """
    per = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_rows")
    )
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (rank % len(WEIGHTS)) + 1)
    per = per.withColumn("_weight", weight).withColumn("_cap", REPEATS * F.col("source_size"))
    all_rows = Window.partitionBy()
    level = F.col("_cap") / F.col("_weight")
    upto = Window.orderBy("_level").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    per = per.withColumn("_level", level).select(
        "*",
        (F.sum("source_size").over(all_rows) * F.lit(SHARE)).alias("_total"),
        F.sum("_cap").over(upto).alias("_below"),
        (F.sum("_weight").over(all_rows) - F.sum("_weight").over(upto)).alias("_above"),
    )
    full = F.col("_below") + F.col("_level") * F.col("_above") <= F.col("_total")
    per = per.withColumn("_full", full).select(
        "*",
        F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(all_rows), F.lit(0)).alias(
            "_given"
        ),
        F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(all_rows).alias("_open"),
    )
    part = (F.col("_total") - F.col("_given")) / F.col("_open")
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(
        part * F.col("_weight")
    )
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    return (
        per.withColumn("target", target)
        .withColumn("_epochs", epochs.cast("long"))
        .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
        .withColumn("_chunks", F.ceil(F.col("_rows") / F.lit(CHUNK_ROWS)))
        .select("source", "source_size", "target", "_epochs", "_rest", "_chunks")
    )


def mix(
    df: DataFrame, id_col: str, source: Column, size: Column, weight: Column, seed: str = "mix"
) -> DataFrame:
    """One row per input row: how many of its words the mixture takes, repeats counted.

    Complete epochs of a source come first; what is left of its target is filled with the rows
    that have the smallest exponential keys ``-ln(u) / weight``, where ``u`` is drawn from the id,
    so reruns agree.  Summing the sizes in key order decides; the row that crosses the budget is
    taken if that ends nearer to it.  Instead of sorting a source in one task, its keys are cut
    into chunks of even probability: sums of chunks find the one in which the budget ends, and
    only that chunk is ordered.  Rows with the same id draw the same key.  A null source is a
    source; a source without words has target 0.  Columns: id, ``size``, ``source_size``,
    ``target``, ``taken``, ``copies``.
    """
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string"))), 1, 12)
    uniform = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**48))
    rows = written(
        df.select(
            F.col(id_col).alias("_id"),
            source.alias("source"),
            size.cast("long").alias("size"),
            weight.alias("_quality"),
            F.coalesce(uniform, F.lit(0.5)).alias("_u"),
        ),
        "sizes",
    )
    # In chunk c of n lie the keys whose exponential distribution function is in [c/n, (c+1)/n).
    chunk = F.floor((1 - F.pow(F.col("_u"), 1 / F.col("_quality"))) * F.col("_chunks"))
    targets = written(source_targets(rows), "targets")
    same = F.col("source").eqNullSafe(F.col("_source"))
    keyed = rows.join(targets.withColumnRenamed("source", "_source"), same).withColumns(
        {"_chunk": chunk, "_key": -F.log(F.col("_u")) / F.col("_quality")}
    )
    sums = keyed.groupBy("_source", "_chunk").agg(
        F.sum("size").alias("_sum"), F.first("_rest").alias("_left")
    )
    before = F.coalesce(
        F.sum("_sum").over(
            Window.partitionBy("_source")
            .orderBy("_chunk")
            .rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    cuts = (
        sums.withColumn("_before", before)
        .where((F.col("_before") <= F.col("_left")) & (F.col("_before") + F.col("_sum") > F.col("_left")))
        .select(
            F.col("_source").alias("_cut_source"), F.col("_chunk").alias("_cut"), "_before"
        )
    )
    cuts = written(cuts, "cuts")  # at most one row per source
    placed = keyed.join(cuts, F.col("_source").eqNullSafe(F.col("_cut_source")), "left")
    # Without a cut the rest is 0 or takes the whole source (rounding of an exact multiple).
    never = F.col("_rest") <= 0
    sure = placed.where(F.col("_cut").isNull() | (F.col("_chunk") != F.col("_cut"))).withColumn(
        "_extra", ~never & (F.col("_cut").isNull() | (F.col("_chunk") < F.col("_cut")))
    )
    inside = Window.partitionBy("_source").orderBy("_key", "_id", "size")
    upto = F.col("_before") + F.sum("size").over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ordered = placed.where(F.col("_chunk") == F.col("_cut")).withColumn("_upto", upto)
    over = F.col("_upto") - F.col("_rest")
    under = F.col("_rest") - (F.col("_upto") - F.col("size"))
    ordered = ordered.withColumn(
        "_extra", ~never & ((over <= 0) | ((under > 0) & (over < under)))
    ).drop("_upto")
    copies = F.col("_epochs") + F.col("_extra").cast("long")
    return sure.unionByName(ordered).select(
        F.col("_id").alias(id_col),
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).alias("taken"),
        copies.alias("copies"),
    )


def mix_documents(df: DataFrame) -> DataFrame:
    """``mix`` for a documents table: sizes in words, quality from its symbols."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return mix(df, "doc_id", F.col("source"), size, symbol_quality(F.col("text"), size))


def mix_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture as rows: a document taken twice stands there twice, one not taken is gone.

    Rows with the same id are one draw; documents without a word add nothing and go too.
    """
    with scratch(spark) as keep:
        taken = mix_documents(docs).where(F.col("taken") > 0)
        copies = taken.groupBy("doc_id").agg(F.max("copies").alias("_copies"))
        copies = keep(copies, "copies")
    picked = docs.join(copies, "doc_id")
    repeated = picked.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*docs.columns)


MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, text,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    coalesce(length(regexp_replace(text, '[^#*$%&|<>!]', '', 'g')), 0) AS symbols
  FROM {table}),
r AS (
  SELECT doc_id, source, size, -ln((('0x' || substr(md5('mix-' || doc_id), 1, 12))::BIGINT + 0.5::DOUBLE)
      / 281474976710656.0::DOUBLE) / (1.0::DOUBLE / (1.0::DOUBLE + symbols::DOUBLE / greatest(size, 1))) AS k
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM r GROUP BY source),
l AS (SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / w AS lev FROM s),
c AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5 AS total,
    sum(cap) OVER (ORDER BY lev RANGE UNBOUNDED PRECEDING) AS below,
    sum(w) OVER () - sum(w) OVER (ORDER BY lev RANGE UNBOUNDED PRECEDING) AS above
  FROM l),
f AS (SELECT *, below + lev * above::DOUBLE <= total AS is_full FROM c),
t AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE
      (total - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0)::DOUBLE)
      / (sum(CASE WHEN NOT is_full THEN w END) OVER ())::DOUBLE * w END AS target
  FROM f),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
p AS (
  SELECT r.doc_id, r.size, e.source_size, e.target, e.epochs,
    e.target - e.epochs * e.source_size AS rest,
    sum(r.size) OVER (PARTITION BY r.source ORDER BY k, r.doc_id, r.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM r JOIN e ON r.source IS NOT DISTINCT FROM e.source),
x AS (
  SELECT *, epochs + (rest > 0 AND (upto <= rest OR (upto - size < rest
      AND upto - rest < rest - (upto - size))))::BIGINT AS copies
  FROM p)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies FROM x
"""


@query("op9_mix_sources", MIX_SQL.format(table="documents"))
def op9_mix_sources(spark, folder):
    """Words that the mixture takes from every document."""
    return mix_documents(documents(spark, folder))
