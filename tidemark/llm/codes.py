"""Vector code compression: product codes whose nearest entries an equal-average search finds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import query, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Integer components are held within this border, so that their sums fit 38 digits.
LARGEST = 1 << 96
LONG = (1 << 63) - 1
TOTAL = T.DecimalType(38, 0)


class Codebook:
    """The entries of one part, ordered by the sum of their components.

    By Cauchy and Schwarz the squared gap of two sums, over the number of components, is at most
    the squared distance.  So the search starts at the part's own sum, goes outward to either
    side, nearest gap first, and ends once the gap alone exceeds the best distance strictly; an
    entry at an equal distance and a lower index is therefore never missed.
    """

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(1)
        self.order = np.argsort(sums, kind="stable")
        self.sums, self.entries = sums[self.order], entries[self.order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of every row, and its squared distance."""
        n, width = parts.shape
        last = len(self.sums) - 1
        own = parts.sum(1)
        right = np.searchsorted(self.sums, own)
        left = right - 1
        best = np.full(n, -1, parts.dtype)
        code = np.full(n, len(self.order), np.int64)
        rows = np.arange(n)
        while len(rows):
            at_left, at_right, s = left[rows], right[rows], own[rows]
            below = s - self.sums[np.maximum(at_left, 0)]
            above = self.sums[np.minimum(at_right, last)] - s
            down = (at_left >= 0) & ((at_right > last) | (below <= above))
            gap = np.where(down, below, above)
            more = (down | (at_right <= last)) & (
                (best[rows] < 0) | (gap * gap <= best[rows] * width)
            )
            rows, down = rows[more], down[more]
            entry = np.where(down, left[rows], right[rows])
            off = parts[rows] - self.entries[entry]
            distance, index = (off * off).sum(1), self.order[entry]
            known = best[rows]
            better = (known < 0) | (distance < known) | ((distance == known) & (index < code[rows]))
            best[rows[better]], code[rows[better]] = distance[better], index[better]
            left[rows[down]] -= 1
            right[rows[~down]] += 1
        return code, best


def integers(vectors: list | pa.Array, width: int) -> np.ndarray:
    """floor(4096 x) of every component, filled up with zeros; 64 bits where they are enough."""
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    filled = np.zeros((len(sizes), width))
    starts = np.cumsum(sizes) - sizes
    filled[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(starts, sizes)] = flat
    most = LARGEST / SCALE
    scaled = np.floor(np.clip(filled, -most, most) * SCALE)
    if not scaled.size or width * np.abs(scaled).max() < 1 << 29:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], object).reshape(scaled.shape)


def search(vectors: pa.Array, width: int, books: np.ndarray) -> Iterator[tuple]:
    """For every part position: its number, the parts, their entries and squared distances."""
    rows, size = integers(vectors, width), width // PARTS
    small = rows.dtype == np.int64 and (not books.size or width * max(map(abs, books.ravel())) < 1 << 29)
    kind = np.int64 if small else object
    for p in range(PARTS):
        parts = rows[:, p * size : (p + 1) * size].astype(kind)
        code, best = Codebook(books[p].astype(kind)).nearest(parts)
        yield p, parts, code, best


def _totals(rows: DataFrame, width: int, books: np.ndarray) -> DataFrame:
    """Number and component sums of the parts of every entry; a row per task and entry, summed."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((PARTS, ENTRIES), np.int64)
        sums = np.zeros((PARTS, ENTRIES, width // PARTS), object)
        for batch in batches:
            for p, parts, code, _ in search(batch.column(0), width, books):
                for entry in np.unique(code):
                    own = parts[code == entry]
                    count[p, entry] += len(own)
                    sums[p, entry] += own.sum(0)
        at = np.argwhere(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(at[:, 0], pa.int32()),
                pa.array(at[:, 1], pa.int32()),
                pa.array(count[count > 0], pa.int64()),
                pa.array([list(map(int, sums[p, e])) for p, e in at], pa.list_(pa.decimal128(38, 0))),
            ],
            ["part", "entry", "count", "sums"],
        )

    shards = rows.select("_vector").mapInArrow(
        total, "part int, entry int, count long, sums array<decimal(38,0)>"
    )
    position = [F.sum(F.col("sums")[i]).cast(TOTAL).alias(f"s{i}") for i in range(width // PARTS)]
    return shards.groupBy("part", "entry").agg(F.sum("count").alias("count"), *position)


def fit(rows: DataFrame, width: int, rounds: int = ROUNDS) -> np.ndarray:
    """The final codebooks [part, entry, component]; the driver holds ``ENTRIES`` vectors only."""
    first = rows.orderBy(F.col("_id").asc_nulls_last(), "_vector").limit(ENTRIES)
    start = first.select("_vector").toArrow().column(0).combine_chunks()
    books = np.stack(np.split(integers(start, width).astype(object), PARTS, 1))
    for _ in range(rounds):
        books = books.copy()
        for r in _totals(rows, width, books.copy()).collect():
            books[r.part, r.entry] = [int(s) // r["count"] for s in r[3:]]
    return books


def _saturated(total: Column) -> Column:
    return F.least(total, F.lit(LONG).cast(TOTAL)).cast("long")


def compress(
    df: DataFrame, id_col: str, vector: str, label: str, rounds: int = ROUNDS
) -> DataFrame:
    """One row per vector: id, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    Rows whose vector is null or holds null or non-finite components are dropped.  Vectors that
    are shorter than the longest, or of a length that eight does not divide, are filled up with
    zeros, which change no distance; an empty vector counts as zeros.  With fewer than 16 vectors
    there are as many entries.  Rows with the same id are kept one by one; a null id comes last,
    equal ids in the order of their vectors.  Integers beyond 2 ** 96 are held there and errors
    beyond a long at the largest long.  An empty table gives an empty result.  Other columns are
    not looked at.

    Every round is one pass that sends 128 rows a task; the codebooks (16 vectors) are all that
    the driver and the tasks hold besides a batch.  Sums are exact, so a repeated task changes
    nothing.
    """
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = df.where(F.col(vector).isNotNull() & finite).select(
        F.col(id_col).alias("_id"),
        F.col(vector).cast("array<double>").alias("_vector"),
        F.col(label).alias("_label"),
    )
    longest = rows.agg(F.max(F.size("_vector"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    books = fit(rows, width, rounds)
    text = ",".join(str(x) for x in books.ravel())
    digest = hashlib.sha256(text.encode()).hexdigest()
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("_id", "_label")}

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.full(len(batch), "", object)
            error = np.zeros(len(batch), object)
            for _, _, found, best in search(batch.column(1), width, books):
                names += np.array([f"{x:02x}" for x in range(ENTRIES)], object)[found]
                error += best
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array(names, pa.string()),
                    pa.array([min(int(x), LONG) for x in error], pa.int64()),
                ],
                ["_id", "_label", "code", "error"],
            )

    coded = rows.mapInArrow(
        code, f"_id {kinds['_id']}, _label {kinds['_label']}, code string, error long"
    )
    coded = written(coded, "codes")
    totals = coded.groupBy("_label").agg(_saturated(F.sum(F.col("error").cast(TOTAL))).alias("label_error"))
    # Written, so that Spark knows its size: a small one is sent to the codes, which then stay.
    totals = written(totals.withColumnRenamed("_label", "_of"), "label-errors")
    return coded.join(totals, F.col("_label").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias(id_col),
        "code",
        "error",
        "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


def _round_sql(k: int) -> str:
    """The assignment to codebook ``k`` and, from it, the next one."""
    return f"""
    a{k} AS MATERIALIZED (
      SELECT vec_id, p, min(struct_pack(d := d, e := e)) AS found
      FROM (SELECT x.vec_id, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) AS d
        FROM x JOIN b{k} b ON x.p = b.p AND x.j = b.j GROUP BY ALL) GROUP BY ALL),
    b{k + 1} AS MATERIALIZED (
      SELECT b.p, b.e, b.j, coalesce((s - ((s % n) + n) % n) // n, b.v) AS v
      FROM b{k} b LEFT JOIN (
        SELECT x.p, found.e AS e, x.j, sum(x.v) AS s, count(*) AS n
        FROM x JOIN a{k} a ON x.vec_id = a.vec_id AND x.p = a.p GROUP BY ALL) t
      ON b.p = t.p AND b.e = t.e AND b.j = t.j)"""


SQL = f"""
    WITH kept AS (
      SELECT vec_id, label, [CAST(floor({SCALE} * CAST(c AS DOUBLE)) AS HUGEINT) FOR c IN embedding] AS v
      FROM embeddings
      WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
    x AS MATERIALIZED (
      SELECT vec_id, (i - 1) // (w // {PARTS}) AS p, (i - 1) % (w // {PARTS}) AS j, v[i] AS v
      FROM (SELECT vec_id, v, len(v) AS w, unnest(range(1, len(v) + 1)) AS i FROM kept)),
    b0 AS (
      SELECT p, e, j, v FROM x JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (vec_id)
      WHERE e < {ENTRIES}),
    {",".join(_round_sql(k) for k in range(ROUNDS + 1))},
    coded AS (
      SELECT vec_id, label, code, error FROM kept JOIN (
        SELECT vec_id, string_agg(printf('%02x', CAST(found.e AS BIGINT)), '' ORDER BY p) AS code,
          CAST(sum(found.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY 1) USING (vec_id))
    SELECT vec_id, code, error,
      CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
      (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, j)) FROM b{ROUNDS})
        AS codebooks_sha256
    FROM coded
    """


@query("op13_vector_codes", SQL)
def op13_vector_codes(spark, folder):
    """Code and errors of every vector of ``embeddings`` that can be coded."""
    vectors = spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")
    return compress(vectors, "vec_id", "embedding", "label")
