"""Links that a forest's neighbours and anchors leave out in crowded regions, found exactly.

Shingles are ordered by how many documents of the crowds hold them, rarest first, and shingles held
by one component alone come before all others.  Two similar documents of different components have
their first common shingle among the first of both (the prefix).  If it is rare, a join on rare
shingles finds the pair.  If it is frequent, so are all shingles they share, and documents meet by
their sets of frequent shingles: equal sets form a class, which its smallest document stands for,
and classes with a common MinHash are compared in blocks, each two of which meet in a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import scan_filters, written

#: Documents of a rare shingle: at most so many are paired by it.
RARE = 16
#: Orders of frequent shingles: sets at a similarity of 0.75 have no common first in 0.25 ** 12.
ORDERS = 12
#: Classes, and their shingles, of a block.
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 1 << 21
#: Columns of the matrices that count common shingles.
COLUMNS = 4096


def unsettled(regions: DataFrame, named: DataFrame, most: int) -> DataFrame:
    """Rows of ``named`` in a region of more than ``most`` documents and several components."""
    members = regions.select("region", "id").join(named.select("id", "comp"), "id")
    still_open = (
        members.groupBy("region")
        .agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        .where((F.col("n") > most) & (F.col("low") != F.col("high")))
        .select("region")
    )
    ids = members.join(still_open, "region", "left_semi").select("id").distinct()
    return written(named.join(ids, "id"), "unsettled")


def _enough(common: Column, sizes: Column, percent: int) -> Column:
    """Whether ``common`` shingles of two sets with ``sizes`` together make them similar."""
    return (100 + percent) * common >= percent * sizes


def ordered_sets(open_rows: DataFrame, texts: DataFrame, shingles: Callable, percent: int) -> DataFrame:
    """``id``, ``comp``, ``n_shingles``, ``need`` and ``held``, the shingles of several components.

    ``held`` is ordered by (documents, shingle).  ``need`` is the least number of common shingles of
    a link; documents that hold fewer have no link to another component and are left out.
    """
    kinds = {c: open_rows.schema[c].dataType.simpleString() for c in ("id", "comp")}

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shingles()
        for batch in batches:
            for at in range(batch.num_rows):
                found = of(batch.column(2)[at].as_py() or "")
                rows = pa.array(np.full(len(found), at))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(found.view(np.int64)),
                    ],
                    ["id", "comp", "shingle"],
                )

    with scan_filters(texts.sparkSession):
        rows = written(
            texts.join(open_rows.select("id", "comp"), "id")
            .dropDuplicates(["id"])
            .select("id", "comp", "text")
            .mapInArrow(split, f"id {kinds['id']}, comp {kinds['comp']}, shingle long"),
            "crowd-shingles",
        )
    several = (
        rows.groupBy("shingle")
        .agg(F.count("*").alias("docs"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        .where("low != high")
        .select("shingle", "docs")
    )
    return written(
        rows.select("id", "shingle")
        .join(several, "shingle")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("docs", "shingle"))).alias("held"))
        .join(open_rows, "id")
        .withColumn("need", F.expr(f"(n_shingles * {percent} + 99) div 100"))
        .where("size(held) >= need"),
        "crowd-sets",
    )


def rare_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a`` < ``b`` that share a rare shingle of their prefixes and may be similar enough.

    What two sets share is at most the common shingles seen and what follows the last of them.
    """
    at = F.expr("n_shingles - size(held)")
    tokens = written(
        sets.select(
            "id",
            "comp",
            F.col("n_shingles").alias("n"),
            at.alias("private"),
            F.posexplode(F.expr("slice(held, 1, cast(size(held) - need + 1 as int))")).alias("at", "held"),
        )
        .where(F.col("held.docs") <= RARE)
        .select(F.col("held.shingle").alias("shingle"), "id", "comp", "n", (F.col("private") + F.col("at")).alias("at")),
        "rare-shingles",
    )
    a = tokens.select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("id", "comp", "n", "at")])
    b = tokens.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("id", "comp", "n", "at")])
    rest = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) - 1
    return (
        a.join(b, "shingle")
        .where("id_a < id_b and comp_a != comp_b")
        .where(_enough(F.least("n_a", "n_b"), F.col("n_a") + F.col("n_b"), percent))
        .groupBy("id_a", "id_b", "n_a", "n_b")
        .agg(F.count("*").alias("seen"), F.max("at_a").alias("at_a"), F.max("at_b").alias("at_b"))
        .where(_enough(F.col("seen") + rest, F.col("n_a") + F.col("n_b"), percent))
        .select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    )


def frequent_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a`` - ``b`` that join all documents similar by frequent shingles alone.

    In a class, and between two, a document that is similar to any is similar to the smallest.
    """
    frequent = F.expr(f"transform(filter(held, h -> h.docs > {RARE}), h -> h.shingle)")
    docs = written(
        sets.withColumn("frequent", frequent)
        .where("size(frequent) >= need")
        .select(
            "id",
            "comp",
            F.col("n_shingles").alias("n"),
            "frequent",
            F.size("frequent").cast("long").alias("n_frequent"),
            F.xxhash64("frequent").alias("h1"),
            F.xxhash64(F.lit(1), "frequent").alias("h2"),
        ),
        "frequent-sets",
    )
    digest = ["n_frequent", "h1", "h2"]
    classes = written(
        docs.groupBy(*digest).agg(
            F.min(F.struct("n", "id")).alias("least"),
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
        ),
        "frequent-classes",
    )
    members = written(
        docs.drop("frequent")
        .join(classes.select(*digest, F.col("least.id").alias("first"), F.col("least.n").alias("first_n")), digest)
        .withColumn("near", _enough(F.col("n_frequent"), F.col("n") + F.col("first_n"), percent))
        .drop("h1", "h2"),
        "frequent-members",
    )
    inside = members.where("near and id != first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    firsts = classes.select(F.col("least.id").alias("id"), "low", "high").join(
        docs.select("id", "n", "frequent"), "id"
    )
    pairs = written(_similar_classes(firsts, percent), "class-pairs")
    between = pairs.select("a", "b")
    # A document too long for its own class's smallest can be similar to that of another class.
    ways = pairs.select("a", "b", "n_b", "common").unionByName(
        pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n_a").alias("n_b"), "common")
    )
    across = (
        members.where("not near")
        .join(ways, F.col("first") == F.col("a"))
        .where(_enough(F.col("common"), F.col("n") + F.col("n_b"), percent))
        .select(F.col("id").alias("a"), "b")
    )
    return inside.unionByName(between).unionByName(across)


def _similar_classes(firsts: DataFrame, percent: int) -> DataFrame:
    """Similar pairs of the classes' smallest documents, by blocks of those with a common first.

    Sets that are similar have the same first shingle in one of several orders, as in the forest.
    Orders that bring the same classes together count once.
    Columns ``a``, ``b``, ``n_a``, ``n_b`` and ``common``, the number of common shingles.
    """
    first = "array_min(transform(frequent, s -> xxhash64(cast({} as int), s)))"
    keyed = written(
        firsts.select(
            "id",
            "low",
            "high",
            F.size("frequent").alias("size"),
            F.explode(F.array(*[F.expr(first.format(at)) for at in range(ORDERS)])).alias("key"),
        ),
        "class-keys",
    )
    keys = (
        keyed.groupBy("key")
        .agg(
            F.min("low").alias("least"),
            F.max("high").alias("most"),
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("id")).alias("m1"),
            F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("m2"),
            F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("parts"),
        )
        .where("n > 1 and least != most")
        .groupBy("n", "m1", "m2")
        .agg(F.min("key").alias("key"), F.first("parts").alias("parts"))
        .select("key", "parts")
    )
    mine = F.pmod(F.xxhash64("id"), "parts").cast("int")
    dealt = (
        keyed.select("id", "key")
        .join(keys, "key")
        .select("key", "id", mine.alias("mine"), F.explode(F.expr("sequence(0, cast(parts - 1 as int))")).alias("y"))
        .select("key", "id", "mine", F.least("mine", "y").alias("x"), F.greatest("mine", "y").alias("y"))
        .join(firsts, "id")
    )
    kind = firsts.schema["id"].dataType.simpleString()

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        left = block["mine"].to_numpy() == block["x"].iloc[0]
        right = block["mine"].to_numpy() == block["y"].iloc[0]
        i, j, common = _common(block["frequent"].tolist(), left, right)
        ids, n = block["id"].to_numpy(), block["n"].to_numpy()
        low, high = block["low"].to_numpy(), block["high"].to_numpy()
        keep = (100 + percent) * common >= percent * (n[i] + n[j])
        keep &= (ids[i] != ids[j]) & ~((low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j]))
        i, j, common = i[keep], j[keep], common[keep]
        turn = ids[i] > ids[j]
        i, j = np.where(turn, j, i), np.where(turn, i, j)
        return pd.DataFrame({"a": ids[i], "b": ids[j], "n_a": n[i], "n_b": n[j], "common": common})

    return (
        dealt.groupBy("key", "x", "y")
        .applyInPandas(compare, f"a {kind}, b {kind}, n_a long, n_b long, common long")
        .distinct()
    )


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray):
    """Pairs of a left and a right set that share shingles, and how many they share."""
    sizes = [len(s) for s in sets]
    _, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    row, column = row[held[column] > 1], column[held[column] > 1]
    used, column = np.unique(column, return_inverse=True)
    rows, others = np.flatnonzero(left), np.flatnonzero(right)
    common = np.zeros((len(rows), len(others)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, len(used), COLUMNS):
        start, end = np.searchsorted(column, [at, at + COLUMNS])
        matrix = np.zeros((len(sets), COLUMNS), np.float32)
        matrix[row[start:end], column[start:end] - at] = 1
        common += matrix[rows] @ matrix[others].T
    i, j = np.nonzero(common)
    same = np.array_equal(rows, others)
    i, j, found = rows[i], others[j], common[i, j].astype(np.int64)
    return (i[i < j], j[i < j], found[i < j]) if same else (i, j, found)
