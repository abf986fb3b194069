"""Latest-value snapshots per entity, the online store table, and lookups against it."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.messages import MISSING_FEATURES, missing_features
from tidemark.session import new_folder
from tidemark.sources import tables

MAX_LOOKUP_RETRIES = 1  # fixed value


def latest_per_entity(df: DataFrame, entity: str, order: Sequence[str]) -> DataFrame:
    """The last row per entity; an aggregate, so a hot entity combines before the shuffle."""
    rest = [c for c in df.columns if c != entity]
    # Where the order takes in all columns, it is the row.
    whole = set(rest) == set(order)
    last = F.max(F.struct(*order)) if whole else F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(entity).agg(last.alias("_r")).select(entity, "_r.*").select(*df.columns)


def feature_view(df: DataFrame, name: str, entity: str, order: Sequence[str]) -> DataFrame:
    """Bind a name to the latest rows of an offline table; repeating it is harmless."""
    view = latest_per_entity(df, entity, order)
    view.createOrReplaceTempView(name)
    return view


def merge_latest(
    changes: DataFrame, entity: str, features: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Newest non-null value per entity and feature; a null never replaces a value."""
    rank = F.struct(*order)
    return changes.groupBy(entity).agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), rank)).alias(f) for f in features],
        *[F.max(o).alias(o) for o in order],
    )


def store_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature values as the store types them: numbers as double, anything else as text."""
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean"}
    types = dict(df.dtypes)

    def typed(name: str) -> Column:
        if types[name].startswith("array"):
            return F.col(name)
        number = types[name] in numeric or types[name].startswith("decimal")
        return F.col(name).cast("double" if number else "string").alias(name)

    return df.select(*[typed(c) if c in features else F.col(c) for c in df.columns])


#: Rows of a base per bucket, and bits of the key's hash that a bucket number has at most.
BUCKET_ROWS, MOST_BITS = 4096, 14
#: Bits of the bucket numbers of a change batch, which has few rows.
CHANGE_BITS = 4


def bucket(entity: str, bits: int) -> Column:
    """The first ``bits`` bits of the key's hash: buckets of fewer bits contain those of more."""
    hashed = F.xxhash64(F.col(entity).cast("string"))
    return F.shiftrightunsigned(hashed, 64 - bits).cast("int") if bits else F.lit(0)


def bits_for(rows: int) -> int:
    return min(max(math.ceil(math.log2(max(rows, 1) / BUCKET_ROWS)), 0), MOST_BITS)


@dataclass(frozen=True, order=True)
class Base:
    """A whole base: its number, the last batch it contains, the bits of its buckets."""

    generation: int
    contains: int
    bits: int

    @property
    def name(self) -> str:
        return f"_base={self.generation:012d}-{self.contains + 1:012d}-{self.bits:02d}"


class OnlineStore:
    """Key -> latest feature values, kept as a base table plus appended change batches.

    Base and changes are partitioned by a bucket of the key's hash and sorted by key within it.
    A lookup collects the buckets of its keys (at most 2 ** ``MOST_BITS`` small numbers) and reads
    no others; the number of buckets of a base follows its rows, so that a bucket stays small.

    A micro-batch appends only its own rows, so the cost of an upsert follows the batch and
    not the store.  ``snapshot`` merges base and changes; ``compact`` writes that merge as the
    next base.  Change folders are named by batch, so replaying a batch replaces itself.  Bases
    have a number of their own, and name the last batch that they contain: later changes come on
    top of a base whoever wrote it.
    """

    ORDER = ("feature_timestamp", "batch_id")

    def __init__(self, spark: SparkSession, path: str, entity: str, features: Sequence[str]):
        self.spark, self.path, self.entity = spark, path, entity
        self.features = list(features)
        self._opened: dict[Base, DataFrame | None] = {}

    def _rows(self, df: DataFrame, batch_id: int) -> DataFrame:
        return store_values(df, self.features).select(
            self.entity,
            *self.features,
            F.col("feature_timestamp").cast("timestamp"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )

    def _write(self, df: DataFrame, name: str, bits: int) -> None:
        """Each bucket is one file, whose rows are sorted by key."""
        rows = df.withColumn("_bucket", bucket(self.entity, bits)).repartition("_bucket")
        rows.sortWithinPartitions("_bucket", self.entity).write.mode("overwrite").partitionBy(
            "_bucket"
        ).parquet(f"{self.path}/{name}")

    def upsert(self, df: DataFrame, batch_id: int) -> None:
        rows = merge_latest(self._rows(df, batch_id), self.entity, self.features, self.ORDER)
        self._write(rows, f"_change={batch_id:012d}", CHANGE_BITS)

    def _write_base(self, df: DataFrame, rows: int, contains: int) -> None:
        bases, _ = self._folders()
        generation = 1 + max((base.generation for base in bases), default=-1)
        base = Base(generation, contains, bits_for(rows))
        self._write(df, base.name, base.bits)

    def sync(self, offline: DataFrame) -> None:
        """Rebuild the store from the latest offline row of every entity.

        Batches stored by now are in the offline table already, as streams write there first.
        """
        bases, changes = self._folders()
        contains = max([*changes, *(base.contains for base in bases)], default=-1)
        entities = offline.agg(F.approx_count_distinct(self.entity)).first()[0]
        order = ["feature_timestamp", *self.features]
        latest = latest_per_entity(offline.select(self.entity, *order), self.entity, order)
        self._write_base(self._rows(latest, contains), entities, contains)

    def compact(self, batch_id: int) -> None:
        """Write everything up to ``batch_id`` as the new base; readers switch when it is whole.

        What the base before it had already replaced is removed: its readers are long done.
        """
        bases, changes = self._folders()
        stored = self._stored(batch_id)
        if stored is None:
            return
        # Rows before the merge, from the files' footers: at least as many as after it.
        self._write_base(self._merged(stored, batch_id), stored.count(), batch_id)
        if bases:
            latest = bases[-1]
            replaced = [base.name for base in bases[:-1]]
            replaced += [f"_change={n:012d}" for n in changes if n <= latest.contains]
            tables.remove_folders(self.spark, self.path, replaced)

    def _folders(self) -> tuple[list[Base], list[int]]:
        """Whole bases, the newest last, and the numbers of whole changes."""
        bases, changes = [], []
        for name in tables.committed_folders(self.spark, self.path):
            kind, _, numbers = name.partition("=")
            if kind == "_base":
                generation, after, bits = map(int, numbers.split("-"))
                bases.append(Base(generation, after - 1, bits))
            elif kind == "_change":
                changes.append(int(numbers))
        return sorted(bases), sorted(changes)

    def _parts(self, upto: int | None = None) -> tuple[Base | None, list[int]]:
        """What makes up the state: the newest whole base and the changes it lacks."""
        bases, changes = self._folders()
        if upto is not None:
            bases = [base for base in bases if base.contains <= upto]
            changes = [n for n in changes if n <= upto]
        base = bases[-1] if bases else None
        return base, [n for n in changes if base is None or n > base.contains]

    def parts(self, upto: int | None = None) -> list[str]:
        """Folders that make up the state."""
        base, changes = self._parts(upto)
        names = [] if base is None else [base.name]
        return [f"{self.path}/{name}" for name in [*names, *(f"_change={n:012d}" for n in changes)]]

    def _read(self, paths: list[str]) -> DataFrame | None:
        """The folders' rows with their ``_bucket``; None when none of them has a row."""
        try:
            return self.spark.read.option("basePath", self.path).parquet(*paths)
        except AnalysisException as problem:
            if problem.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return None
            raise

    def _base(self, base: Base) -> DataFrame | None:
        """A base never changes, so its files are listed once however many lookups follow."""
        if base not in self._opened:
            self._opened = {base: self._read([f"{self.path}/{base.name}"])}
        return self._opened[base]

    def _stored(self, upto: int | None, buckets: set[int] | None = None) -> DataFrame | None:
        """Rows of base and changes, of some buckets (numbers of ``MOST_BITS`` bits) or of all."""
        base, changes = self._parts(upto)
        found = []
        if base is not None:
            found.append((self._base(base), base.bits))
        if changes:
            paths = [f"{self.path}/_change={n:012d}" for n in changes]
            found.append((self._read(paths), CHANGE_BITS))
        frames = []
        for rows, bits in found:
            if rows is None:
                continue
            if buckets is not None and bits:
                own = sorted({number >> (MOST_BITS - bits) for number in buckets})
                rows = rows.where(F.col("_bucket").isin(own))
            frames.append(rows.select(self.entity, *self.features, *self.ORDER))
        return functools.reduce(DataFrame.unionByName, frames) if frames else None

    def _merged(self, rows: DataFrame, upto: int | None = None) -> DataFrame:
        """One row per key; a base has no more than that, so only changes make a merge."""
        if not self._parts(upto)[1]:
            return rows
        return merge_latest(rows, self.entity, self.features, self.ORDER)

    def snapshot(self, upto: int | None = None) -> DataFrame | None:
        stored = self._stored(upto)
        return None if stored is None else self._merged(stored, upto)

    def lookup(self, keys: DataFrame, upto: int | None = None) -> DataFrame | None:
        """Snapshot rows of the wanted keys only, read from the buckets these keys are in."""
        wanted = keys.where(F.col(self.entity).isNotNull()).select(self.entity).distinct()
        numbers = wanted.select(bucket(self.entity, MOST_BITS).alias("n")).distinct().collect()
        stored = self._stored(upto, {r.n for r in numbers})
        if stored is None:
            return None
        return self._merged(stored.join(wanted, self.entity, "left_semi"), upto)


def new_store(spark: SparkSession, entity: str, features: Sequence[str]) -> OnlineStore:
    return OnlineStore(spark, new_folder(spark, "online"), entity, features)


def enrich(
    messages: DataFrame, snapshot: DataFrame, entity: str, features: Sequence[str]
) -> DataFrame:
    """Left join on the entity; ``missing`` lists absent features, empty when complete."""
    known = snapshot.select(entity, *features)
    return messages.join(known, entity, "left").withColumn("missing", missing_features(features))


def enrich_with_retry(
    messages: DataFrame,
    snapshots: Sequence[DataFrame],
    entity: str,
    features: Sequence[str],
    max_retries: int = MAX_LOOKUP_RETRIES,
) -> DataFrame:
    """Look incomplete messages up again in the next snapshot, up to ``max_retries`` times.

    Adds the features, ``missing`` and ``retry_count``.  Retries wait for the next snapshot
    (micro-batch) instead of sleeping in a task.
    """
    tried = enrich(messages, snapshots[0], entity, features).withColumn(
        "retry_count", F.lit(0).cast("bigint")
    )
    for attempt in range(1, max_retries + 1):
        later = snapshots[min(attempt, len(snapshots) - 1)]
        complete = F.size("missing") == 0
        again = enrich(
            tried.where(~complete).drop(*features, "missing"), later, entity, features
        ).withColumn("retry_count", F.col("retry_count") + 1)
        tried = tried.where(complete).unionByName(again)
    return tried


def missing_error() -> Column:
    """Error struct of a message whose features are incomplete, null when complete."""
    return F.when(
        F.size("missing") > 0,
        F.struct(
            F.lit(MISSING_FEATURES).alias("error_type"),
            F.concat(F.lit("Missing features: "), F.array_join("missing", ", ")).alias(
                "error_message"
            ),
        ),
    )
