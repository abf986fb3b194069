"""Expressions and small helpers that the operators of this package share."""

from __future__ import annotations

import contextlib
import contextvars
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_folder

#: A word: a run of characters other than blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Shuffle files go when the execution that wrote them ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class _Paths:
    """Paths written in the innermost ``scratch`` block; tasks that carry this module have none."""

    def __init__(self):
        self._held = contextvars.ContextVar("paths", default=None)
        self.get, self.set, self.reset = self._held.get, self._held.set, self._held.reset

    def __reduce__(self):
        return type(self), ()


_paths = _Paths()


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for what is planned inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors.

    Inside a ``scratch`` block the table goes when the block ends.
    """
    return _written(df, label, compression, _paths.get())


def _written(
    df: DataFrame, label: str, compression: str | None, paths: list[str] | None
) -> DataFrame:
    spark = df.sparkSession
    path = new_folder(spark, label)
    if paths is not None:
        paths.append(path)
    with setting(spark, CLEANUP, "true"):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Tables ``written`` inside are deleted at the end.

    Yields ``keep``, which writes a table that outlives the block; in an outer block, until that
    one ends.
    """
    outer, paths = _paths.get(), []

    def keep(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
        return _written(df, label, compression, outer)

    token = _paths.set(paths)
    try:
        yield keep
    finally:
        _paths.reset(token)
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


@contextlib.contextmanager
def scan_filters(spark: SparkSession) -> Iterator[None]:
    """Joins planned inside send a Bloom filter of the smaller table's keys to the larger scan.

    Spark does so by itself for large scans; for the joins planned here, which keep a small part
    of the documents, it always pays, since what the filter drops is not shuffled.
    """
    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    with setting(spark, size, "0"):
        yield


#: Words of 64 bits of a key filter: at most so many rows of two numbers (about 20 MB) travel.
FILTER_WORDS = 1 << 19


def possible(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``df`` with ``_possible``: false for rows whose key is surely not the one column of ``keys``.

    A Bloom filter with one hash as a table of words of bits, bounded whatever the number of keys.
    The more keys, the more rows pass that have none, so callers join what passes; rows that do
    not pass need no shuffle.
    """
    word, bit = f"h & {FILTER_WORDS - 1}", "cast(shiftrightunsigned(h, 58) as int)"
    bits = written(
        keys.select(F.xxhash64(keys.columns[0]).alias("h"))
        .groupBy(F.expr(word).alias("_word"))
        .agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("_bits")),
        "key-filter",
    )
    hashed = df.withColumn("_h", F.xxhash64(key))
    looked = hashed.join(
        F.broadcast(bits), F.expr(word.replace("h", "_h", 1)) == F.col("_word"), "left"
    )
    found = F.expr(f"(shiftrightunsigned(_bits, {bit.replace('(h', '(_h')}) & 1L) = 1L")
    return looked.withColumn("_possible", F.coalesce(found, F.lit(False))).drop(
        "_h", "_word", "_bits"
    )


def without(df: DataFrame, id_col: str, kept: DataFrame) -> DataFrame:
    """The rows of ``df`` with an id that some row of ``kept`` (id, ``kept``) keeps.

    ``kept`` has every id of ``df``.  Only rows whose id may be one that goes are shuffled.
    """
    gone = written(
        kept.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_gone"))
        .agg(F.bool_or("kept").alias("_kept"))
        .where("not coalesce(_kept, false)")
        .select("_gone"),
        "gone",
    )
    marked = possible(df.where(F.col(id_col).isNotNull()), F.col(id_col), gone)
    stays = marked.where("not _possible").drop("_possible")
    looked = marked.where("_possible").drop("_possible")
    return stays.unionByName(looked.join(gone, F.col(id_col) == F.col("_gone"), "left_anti"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of this package, with its check SQL where SQL can express it."""

    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            CHECKS[name] = sql
        return build

    return register
