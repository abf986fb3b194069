"""Connected components of a table of links, as joins and groupings only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import scratch, written


def _hook(links: DataFrame, larger_only: bool) -> DataFrame:
    """Each node's neighbours are linked to the smallest of them (or to the node itself).

    With ``larger_only`` just the larger neighbours move (the large star); without, links lead
    from larger to smaller nodes and all neighbours and the node move (the small star).  The
    smallest neighbour is combined before the shuffle, and the join that hands it out is an
    ordinary inner join, so the links of one hub can be split among tasks.
    """
    if larger_only:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        both = links.select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    if larger_only:
        least = least.withColumn("m", F.least("u", "m"))
        moved = both.where(F.col("v") > F.col("u")).join(least, "u")
        made = moved.select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = both.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        made = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return made.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for links ``a`` - ``b``.

    Distributed union-find in rounds of large and small stars.  Each round is written to the
    shared folder, so a lost executor costs at most that round; rounds grow with the logarithm
    of the longest chain.  Ends when every node points at a node that points at none.  Nodes
    without links are not listed; null ends are ignored.
    """
    with scratch(links.sparkSession) as keep:
        stars = written(
            links.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct(),
            "links",
        )
        while True:
            roots = stars.select(F.col("b").alias("a")).distinct()
            several = stars.groupBy("a").count().where("count > 1").select("a")
            again = stars.select("a").join(roots, "a", "left_semi").unionByName(several).limit(1)
            if again.count() == 0:
                break
            stars = written(_hook(_hook(stars, True), False), "links")
        nodes = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
        ends = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
        return keep(nodes.unionByName(ends), "components")
