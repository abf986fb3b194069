"""License scans: MinHash bands of text windows retrieve templates, containment verifies them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import documents, query, written

#: Words of a shingle (templates with fewer words than that are one of SHORT words).
SHINGLE, SHORT = 5, 3
#: Shingles of a window (two blocks) and MinHash bands of one hash each: a window that shares
#: 60 % with a window of a template meets it with 99.6 %.
BLOCK, BANDS = 8, 6
#: Least share of a template's shingles in the matching stretch, in percent.
PERCENT = 75

#: Notices and opening paragraphs of public licenses.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-2-notice": "This program is licensed under the GNU General Public License, version 2.",
    "lgpl-notice": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "agpl-notice": "Licensed under the GNU Affero General Public License, version 3.",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd-notice": "Use of this source code is governed by a BSD-style license.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc0-notice": "Dedicated to the public domain under CC0 1.0.",
    "all-rights-reserved": "All rights reserved.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so"
    ),
    "apache-text": (
        "you may not use this file except in compliance with the License. You may obtain a copy "
        "of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"
    ),
    "gpl-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer."
    ),
}


def hashed(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``n_words`` and the hashed shingles of its words: ``full`` and ``short``."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))
    made = df.withColumn("_words", words)
    made = made.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))

    def shingles(n: int) -> str:
        parts = ", ".join(f"get(_hashes, i + {k})" for k in range(n))
        return (
            f"if(size(_hashes) < {n}, cast(array() as array<bigint>), "
            f"transform(sequence(0, greatest(size(_hashes) - {n}, 0)), i -> xxhash64({parts})))"
        )

    return made.select(
        *df.columns,
        F.size("_words").alias("n_words"),
        F.expr(shingles(SHINGLE)).alias("full"),
        F.expr(shingles(SHORT)).alias("short"),
    )


def _masked(values: str, mask: int) -> str:
    return f"array_min(transform({values}, x -> x ^ {mask}L))"


def _masks() -> list[int]:
    return [(0x2545F4914F6CDD1D * (2 * i + 3)) % (2**63) for i in range(BANDS)]


def template_table(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """Templates with their shingles; ``long`` ones are retrieved by windows of two blocks."""
    rows = spark.createDataFrame(list(templates.items()), "license string, text string")
    made = hashed(rows, F.col("text"))
    of = F.when(F.col("n_words") < SHINGLE, F.col("short")).otherwise(F.col("full"))
    return made.select(
        "license",
        F.col("n_words").alias("words"),
        (F.col("n_words") < SHINGLE).alias("few"),
        of.alias("template"),
        (F.size(of) >= 3 * BLOCK).alias("long"),
    )


def template_bands(table: DataFrame) -> DataFrame:
    """(``band``, ``value``, ``license``, ``at``): where each band value stands in a template.

    Bands 0 to BANDS - 1 are minima of every window of a long template; band -1 is a full shingle
    and band -2 a short one, each a window by itself, of a template too short for windows.
    """
    size = 2 * BLOCK
    parts = []
    for band, mask in enumerate(_masks()):
        window = f"slice(template, i + 1, {size})"
        minima = f"transform(sequence(0, size(template) - {size}), i -> {_masked(window, mask)})"
        parts.append(
            table.where("long").select(
                F.lit(band).alias("band"), "license", F.expr(f"posexplode({minima}) as (at, value)")
            )
        )
    alone = F.when(F.col("few"), F.lit(-2)).otherwise(F.lit(-1)).alias("band")
    parts.append(
        table.where("not long").select(
            alone, "license", F.expr("posexplode(template) as (at, value)")
        )
    )
    made = parts[0]
    for part in parts[1:]:
        made = made.unionByName(part)
    # Equal values of neighbouring windows are one entry, at the first of them.
    return made.groupBy("band", "value", "license").agg(F.min("at").alias("at"))


def find_licenses(
    df: DataFrame, id_col: str, text: str, templates: Mapping[str, str] = TEMPLATES
) -> DataFrame:
    """One row per license stretch: id, ``license``, ``start`` (word), ``percent`` contained.

    Each text is cut into overlapping windows of two blocks of shingles.  Windows (or, for short
    templates, single shingles) whose band value is one of a template's go on; only these are
    joined with the templates, which are a parameter and so of fixed size.  A stretch matches if
    it holds at least 75 % of the template's distinct shingles, counted exactly.  Matches of a
    template that start within half its length of each other are one, with the best share.
    Null and empty texts have none; rows with the same id are taken for one document.
    """
    spark = df.sparkSession
    table = written(template_table(spark, templates), "templates")
    bands = written(template_bands(table), "template-bands")
    # The values go into the scan's filter; their number is that of the templates' windows.
    values: dict[int, list[int]] = {b: [] for b in range(-2, BANDS)}
    for row in bands.select("band", "value").distinct().collect():
        values[row["band"]].append(row["value"])
    made = hashed(df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")), F.col("_text"))
    made = made.drop("_text").withColumn(
        "_blocks", F.expr(f"sequence(0, greatest(cast(ceil(size(full) / {BLOCK}) as int) - 1, 0))")
    )

    def hits(found: str, band: int, step: int) -> str:
        known = ", ".join(f"{v}L" if v != -(2**63) else "(-9223372036854775807L - 1)" for v in sorted(values[band]))
        if not known:
            return "cast(array() as array<struct<band:int,at:int,value:bigint>>)"
        return (
            f"filter(transform({found}, (v, i) -> struct({band} as band, i * {step} as at, v as value)),"
            f" x -> x.value in ({known}))"
        )

    for band, mask in enumerate(_masks()):
        minima = _masked(f"slice(full, b * {BLOCK} + 1, {BLOCK})", mask)
        made = made.withColumn(f"_m{band}", F.expr(f"transform(_blocks, b -> {minima})"))
    both = [
        hits(f"transform(_m{b}, (v, i) -> least(v, get(_m{b}, i + 1)))", b, BLOCK)
        for b in range(BANDS)
    ]
    every = ", ".join([*both, hits("full", -1, 1), hits("short", -2, 1)])
    flagged = made.withColumn("_hits", F.expr(f"concat({every})"))
    # Outer, then without nulls: a filter on the array would be pushed down to the scan, where the
    # hashes would be computed once more for each place in which they are used.
    hit = flagged.select("_id", "full", "short", F.explode_outer("_hits").alias("hit"))
    hit = hit.where(F.col("hit").isNotNull())
    joined = hit.join(
        F.broadcast(bands.withColumnRenamed("at", "of")),
        (F.col("hit.band") == F.col("band")) & (F.col("hit.value") == F.col("value")),
    ).join(F.broadcast(table.select("license", "template", "few")), "license")
    size = F.size("template")
    aim = F.col("hit.at") - F.col("of")
    slack = F.when(F.col("band") < 0, F.lit(0)).otherwise(
        F.ceil(size / 4).cast("int") + 2 * BLOCK
    )
    first = F.greatest(aim - slack, F.lit(0))
    of = F.when(F.col("few"), F.col("short")).otherwise(F.col("full"))
    stretch = F.slice(of, first + 1, size + 2 * slack)
    common = F.size(F.array_intersect("template", stretch))
    percent = F.floor(100 * common / F.size(F.array_distinct("template"))).cast("int")
    matches = (
        joined.select(
            "_id", "license", F.greatest(aim, F.lit(0)).alias("start"), percent.alias("percent"),
            size.alias("size"),
        )
        .where(F.col("percent") >= PERCENT)
        .groupBy("_id", "license", "start", "size")
        .agg(F.max("percent").alias("percent"))
    )
    order = Window.partitionBy("_id", "license").orderBy("start")
    fresh = F.coalesce(F.col("start") - F.lag("start").over(order) > F.col("size") / 2, F.lit(True))
    runs = matches.withColumn("_fresh", fresh.cast("int"))
    runs = runs.withColumn("_run", F.sum("_fresh").over(order))
    return (
        runs.groupBy("_id", "license", "_run")
        .agg(F.min("start").alias("start"), F.max("percent").alias("percent"))
        .select(F.col("_id").alias(id_col), "license", "start", "percent")
    )


@query("op5_license_scan")
def op5_license_scan(spark, folder):
    """Every license stretch in every document."""
    return find_licenses(documents(spark, folder), "doc_id", "text")
