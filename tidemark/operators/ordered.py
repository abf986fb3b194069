"""Running totals, previous values, ranks and quantiles that survive a hot key.

A plain window puts a whole key (or the whole table) into one task.  Here every ordered run
is cut into chunks that follow the order: a window works inside each (key, chunk), and one
small row per chunk carries the state of all earlier chunks.  The chunk rows come from a
map-side-combined aggregation and are carried on level by level (blocks of chunks, then the
blocks), so neither rows nor chunks of a key ever meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import WindowSpec

from tidemark.session import new_folder

CHUNK_PREFIX, BLOCK = "_chunk", "_block"

#: Rows of a chunk, chunks that one cut makes at most, and items a sketch keeps for its borders (with
#: these, a border is off by a tenth of a chunk's rows or so, however the values lie).
CHUNK_ROWS, MOST_CHUNKS, SKETCH_ITEMS = 65_536, 512, 8_192

#: Cuts one inside the other: 512 ** 3 chunks a key, and one pass over the rows for each.
CUTS = 3

#: Numbered chunks whose carries are summed in one window; the next level sums the blocks.
BLOCK_CHUNKS = 4_096


def equal_depth(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    chunk_rows: int = CHUNK_ROWS,
    most: int = MOST_CHUNKS,
) -> DataFrame:
    """Adds ``_piece``: cuts each key's values into ordered chunks of about ``chunk_rows`` rows.

    The borders come from a mergeable quantile sketch per key, so the chunks follow the data:
    values that crowd in a narrow range are cut as evenly as others.  Equal values stay together.
    A key of few rows is one chunk; chunks of a key that needs more than ``most`` (a power of two)
    are cut again, so their number grows with the rows.

    A sketch keeps a random half of what it compacts, so borders are written once: whoever reads
    the chunks, and however often a lost task is run again, sees the same ones.
    """
    cut, rows = _cut(df, keys, value, chunk_rows, most)
    for _ in range(CUTS - 1):
        if rows <= most * chunk_rows:
            break
        outer = cut.withColumnRenamed("_piece", "_outer")
        cut, rows = _cut(outer, [*keys, "_outer"], value, chunk_rows, most)
        cut = cut.withColumn("_piece", F.col("_outer") * most + F.col("_piece")).drop("_outer")
    return cut


def _cut(
    df: DataFrame, keys: Sequence[str], value: str, chunk_rows: int, most: int
) -> tuple[DataFrame, int]:
    """``df`` with ``_piece``, at most ``most`` a key, and the rows of the largest key."""
    spark = df.sparkSession
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), SKETCH_ITEMS).alias("_sketch")
    rows = F.count(value).alias("_rows")
    if keys:
        # Only keys of more than a chunk need a sketch: at most one for every `chunk_rows` rows.
        large = df.groupBy(*keys).agg(rows).where(F.col("_rows") > chunk_rows).select(*keys)
        sketched = _join_carry(df, large, keys).groupBy(*keys).agg(sketch, rows)
    else:
        sketched = df.agg(sketch, rows)
    # As many chunks as a power of two, so that their borders are among the same ranks for all keys.
    doubled = F.ceil(F.log2(F.greatest(F.col("_rows") / chunk_rows, F.lit(1.0))))
    chunks = F.least(F.pow(F.lit(2.0), doubled), F.lit(most)).cast("int")
    ranks = F.array(*[F.lit(i / most) for i in range(1, most)])
    marks = F.kll_sketch_get_quantile_double("_sketch", ranks)
    step = F.lit(most) / chunks
    picked = F.filter(marks, lambda _, i: F.pmod(i + 1, step.cast("int")) == 0)
    borders = F.when(chunks > 1, F.array_distinct(picked))
    path = new_folder(spark, "borders")
    made = sketched.select(*keys, "_rows", borders.alias("_borders"))
    made.write.parquet(path)
    made = spark.read.schema(made.schema).parquet(path)
    largest = made.agg(F.max("_rows")).first()[0] or 0
    found = made.drop("_rows")
    if keys:
        joined = _join_carry(df, found, keys, "left")
    else:
        joined = df.withColumn("_borders", found.scalar())
    at = F.coalesce("_borders", F.array().cast("array<double>"))
    number = F.col(value).cast("double")

    def halved(span: Column, _: Column) -> Column:
        low, high = span.getField("low"), span.getField("high")
        middle = F.floor((low + high) / 2).cast("int")
        above = F.get(at, middle) < number
        return F.when(low >= high, span).otherwise(
            F.struct(
                F.when(above, middle + 1).otherwise(low).alias("low"),
                F.when(above, high).otherwise(middle).alias("high"),
            )
        )

    steps = F.sequence(F.lit(1), F.lit(most.bit_length()))
    whole = F.struct(F.lit(0).alias("low"), F.size(at).alias("high"))
    piece = F.aggregate(steps, whole, halved).getField("low")
    return joined.withColumn("_piece", piece).drop("_borders"), largest


def carried(
    chunks: DataFrame,
    keys: Sequence[str],
    path: Sequence[str],
    values: Mapping[str, str],
    total: Callable[[str, Column], Column],
    fold: Callable[[str, WindowSpec], Column],
    merge: Callable[[Column, Column], Column],
    descending: bool = False,
) -> DataFrame:
    """For one row per (key, chunk): ``values`` folded over all earlier chunks of the key.

    ``path`` names the columns that order a key's chunks; each prefix of it is a level.  A window
    sees the chunks of one parent only, parents are combined (``total``) and carried in the same
    way, and ``merge`` puts what the earlier parents give before what the earlier siblings give.
    ``values`` maps columns of ``chunks`` to the names of the results.
    """
    if len(path) == 1 and isinstance(chunks.schema[path[0]].dataType, IntegralType):
        if path[0] != BLOCK:
            blocked = chunks.withColumn(BLOCK, F.floor(F.col(path[0]) / BLOCK_CHUNKS))
            made = carried(
                blocked, keys, [BLOCK, path[0]], values, total, fold, merge, descending
            )
            return made.drop(BLOCK)
    *parents, own = path
    order = F.desc(own) if descending else F.asc(own)
    earlier = (
        Window.partitionBy(*keys, *parents)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    level = chunks.select(
        *keys, *path, *[fold(c, earlier).alias(name) for c, name in values.items()]
    )
    if not parents:
        return level
    above = chunks.groupBy(*keys, *parents).agg(
        *[total(c, F.col(own)).alias(c) for c in values]
    )
    upper = carried(above, keys, parents, values, total, fold, merge, descending)
    upper = upper.withColumnsRenamed({name: f"_up{name}" for name in values.values()})
    return _join_carry(level, upper, [*keys, *parents]).select(
        *keys,
        *path,
        *[merge(F.col(f"_up{name}"), F.col(name)).alias(name) for name in values.values()],
    )


def sums_before(
    chunks: DataFrame,
    keys: Sequence[str],
    path: Sequence[str],
    values: Mapping[str, str],
    descending: bool = False,
) -> DataFrame:
    """Sums of ``values`` over all earlier chunks; 0 for the first."""
    return carried(
        chunks,
        keys,
        path,
        values,
        lambda c, _: F.sum(c),
        lambda c, earlier: F.coalesce(F.sum(c).over(earlier), F.lit(0)),
        lambda up, own: up + own,
        descending,
    )


def last_before(
    chunks: DataFrame, keys: Sequence[str], path: Sequence[str], values: Mapping[str, str]
) -> DataFrame:
    """The last value that is not null among all earlier chunks; null if there is none."""
    return carried(
        chunks,
        keys,
        path,
        values,
        lambda c, at: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(at))),
        lambda c, earlier: F.last(c, ignorenulls=True).over(earlier),
        lambda up, own: F.coalesce(own, up),
    )


def _with_chunks(df: DataFrame, chunk: Sequence[Column]) -> tuple[DataFrame, list[str]]:
    names = [f"{CHUNK_PREFIX}{i}" for i in range(len(chunk))]
    return df.withColumns(dict(zip(names, chunk))), names


def _join_carry(
    rows: DataFrame, carry: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Null-safe join that keeps the left copy of the keys."""
    renamed = carry.withColumnsRenamed({k: f"_r{k}" for k in on})
    match = [F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in on]
    return rows.join(renamed, match, how).drop(*[f"_r{k}" for k in on])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    chunk: Sequence[Column],
    order: Sequence[Column],
    totals: Mapping[str, Column],
    descending: bool = False,
) -> DataFrame:
    """Cumulative sums per key along ``order``, rows with equal order values included.

    ``chunk`` must not decrease when ``order`` increases.  Several columns are several levels: the
    chunks of one parent are carried in one window, and blocks of numbered chunks are parents too.
    """
    towards = F.desc if descending else F.asc
    rows, chunks = _with_chunks(df, chunk)
    part = [*keys, *chunks]
    inside = (
        Window.partitionBy(*part)
        .orderBy(*[towards(c) for c in order])
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = rows.select("*", *[F.sum(c).over(inside).alias(f"_in_{n}") for n, c in totals.items()])
    per_chunk = rows.groupBy(*part).agg(*[F.sum(c).alias(f"_of_{n}") for n, c in totals.items()])
    before = {f"_of_{n}": f"_pre_{n}" for n in totals}
    carry = sums_before(per_chunk, keys, chunks, before, descending)
    joined = _join_carry(local, carry, part)
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_in_{n}") + F.col(f"_pre_{n}")).alias(n)
            for n in totals
        ],
    )


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    chunk: Sequence[Column],
    order: Sequence[str],
    value: Column,
    name: str,
) -> DataFrame:
    """Adds ``value`` of the previous row per key in ``order`` (null for the first row).

    ``order`` has to be unique within a key.
    """
    rows, chunks = _with_chunks(df.withColumn("_value", F.struct(value.alias("v"))), chunk)
    part = [*keys, *chunks]
    inside = Window.partitionBy(*part).orderBy(*order)
    local = rows.withColumn("_prev", F.lag("_value").over(inside))
    last = rows.groupBy(*part).agg(F.max_by("_value", F.struct(*order)).alias("_last"))
    carry = last_before(last, keys, chunks, {"_last": "_carried"})
    return _join_carry(local, carry, part).select(
        *df.columns, F.coalesce(F.col("_prev"), F.col("_carried")).getField("v").alias(name)
    )


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    chunk: Column | None = None,
) -> DataFrame:
    """Interpolated quantiles of a numeric column per key, one row per key.

    Equal values are counted first and located by running count, so no task ever holds all
    values of a key.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count("*").alias("_n")
    )
    if chunk is None:
        cut = equal_depth(counted, keys, value)
        placed = running_totals(cut, keys, [F.col("_piece")], [F.col(value)], {"_upto": F.col("_n")})
    else:
        placed = running_totals(counted, keys, [chunk], [F.col(value)], {"_upto": F.col("_n")})
    size = counted.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    if keys:
        placed = _join_carry(placed, size, keys)
    else:
        placed = placed.withColumn("_size", size.scalar())

    def value_at(index: Column) -> Column:
        covers = (F.col("_upto") - F.col("_n") <= index) & (index < F.col("_upto"))
        return F.max(F.when(covers, F.col(value).cast("double")))

    columns = []
    for name, q in quantiles.items():
        position = (F.col("_size") - 1) * F.lit(float(q))
        below, above = value_at(F.floor(position)), value_at(F.ceil(position))
        share = F.max(position - F.floor(position))
        columns.append((below + (above - below) * share).alias(name))
    return placed.groupBy(*keys).agg(*columns)
