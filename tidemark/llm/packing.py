"""Packing documents into windows of tokens, best fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.shared import documents, query, written

#: Tokens of a window, and the id that ends each document.
WINDOW, END = 2048, 1
#: Pieces (short of a window) that one task packs together.
SHARD_PIECES = 8192


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree over the capacities.

    A node holds the number of windows below it; the tightest window for a piece is at the
    smallest capacity that is not under the piece's length, found in one way down the tree.
    """

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._count = [0] * (2 * self._leaves)
        self._windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, capacity: int, window: int) -> None:
        self._windows[capacity].append(window)
        self._step(capacity, 1)

    def _step(self, capacity: int, by: int) -> None:
        node = self._leaves + capacity
        while node:
            self._count[node] += by
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Removes and returns (capacity, window) of the tightest fit, if any."""
        node = self._leaves + length
        if not self._count[node]:
            # Up to the first right neighbour with a window, then down to its smallest capacity.
            while node > 1 and (node & 1 or not self._count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node = 2 * node if self._count[2 * node] else 2 * node + 1
        capacity = node - self._leaves
        self._step(capacity, -1)
        return capacity, self._windows[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """Window and offset of each piece, longest pieces first, and the number of windows."""
    at, offsets, opened = [0] * len(lengths), [0] * len(lengths), 0
    open_windows = OpenWindows(window)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = open_windows.take(lengths[i])
        if found is None:
            found, opened = (window, opened), opened + 1
        capacity, at[i] = found
        offsets[i] = window - capacity
        if capacity > lengths[i]:
            open_windows.add(capacity - lengths[i], at[i])
    return at, offsets, opened


def pieces(df: DataFrame, id_col: str, text: str, path: str, window: int, end: int) -> DataFrame:
    """Documents as pieces: full windows and what remains, with the check sum of their ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = bpe.encoder(path).ids, end.to_bytes(4, "little")
        for batch in batches:
            rows, columns = [], [[] for _ in range(4)]
            for i, one in enumerate(batch.column(1).to_pylist()):
                ids = encode(one or "") + last
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    rows.append(i)
                    values = (start, len(part) // 4, zlib.crc32(part), total)
                    for column, value in zip(columns, values):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    *(pa.array(c, pa.int64()) for c in columns),
                ],
                ["_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    return rows.mapInArrow(
        cut, f"_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    )


def pack(
    df: DataFrame,
    id_col: str,
    text: str,
    path: str,
    window: int = WINDOW,
    end: int = END,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece with its place: ``sequence_id`` and ``offset`` in that window.

    A document is its ids and the id ``end``; null and empty texts are that id alone.  Longer
    documents are first cut into full windows, each a sequence of its own.  Remaining pieces are
    dealt evenly into as many shards as their number asks for, and each shard is packed best fit
    decreasing.  Rows with the same id are packed one by one.  An empty table gives no piece.
    Columns: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.
    """
    cut = written(pieces(df, id_col, text, path, window, end), "pieces")
    short = F.col("length") < window
    shards = cut.agg(
        F.greatest(F.ceil(F.count_if(short) / shard_pieces), F.lit(1)).alias("n")
    ).first()["n"]
    columns = ["_id", "start", "length", "ids_crc32", "doc_tokens"]
    dealt = cut.withColumn("_shard", F.pmod(F.xxhash64("_id", "start"), F.lit(shards)))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "_id", "start"], kind="stable").reset_index(drop=True)
        at, offsets, _ = best_fit_decreasing(group["length"].tolist(), window)
        # Sequences of shards take turns: 2 * (window * shards + shard) + 1.
        group["sequence_id"] = [2 * (w * shards + int(group["_shard"].iloc[0])) + 1 for w in at]
        group["offset"] = offsets
        return group[[*columns, "sequence_id", "offset"]]

    kind = df.schema[id_col].dataType.simpleString()
    made = ", ".join(f"{n} long" for n in [*columns[1:], "sequence_id", "offset"])
    packed = dealt.where(short).groupBy("_shard").applyInPandas(place, f"_id {kind}, {made}")
    # Full windows have even numbers.
    full = (
        cut.where(~short)
        .select(*columns, (2 * F.monotonically_increasing_id()).alias("sequence_id"))
        .withColumn("offset", F.lit(0).cast("long"))
    )
    return packed.unionByName(full).withColumnRenamed("_id", id_col)


def pack_documents(df: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(df, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))


def pack_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, packed."""
    return pack_documents(docs)


@query("op10_packing")
def op10_packing(spark, folder):
    """Every document's pieces and their places."""
    return pack_documents(documents(spark, folder))
