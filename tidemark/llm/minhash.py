"""Near duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.components import components
from tidemark.llm.crowds import frequent_links, ordered_sets, rare_pairs, unsettled
from tidemark.llm.shared import documents, query, scan_filters, scratch, without, written

#: Words of a shingle, and the least similarity of a link in percent.
SHINGLE, PERCENT = 5, 75
#: Trees of the forest and hashes of each tree's order.
TREES, DEPTH = 20, 8
#: Hashes that must agree before two documents can be candidates in a tree.
LEAST_DEPTH = 2
#: Depths at which each region and its parts have anchors.
ANCHOR_DEPTHS = (2, 3, 4, 6)
#: Neighbours on either side in each order.
NEIGHBOURS = 4

_U64 = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def _stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return _mixed((np.arange(1, n + 1, dtype=_U64) + _U64(seed << 32)) * _U64(0x9E3779B97F4A7C15))


class Shingles:
    """Hashed word shingles of texts; words are hashed by differences of one running sum."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, n: int):
        self._n = n
        self._byte = _stream(256, 1)
        self._at = _stream(n, 2) | _U64(1)
        self._space = np.zeros(256, bool)
        self._space[[9, 10, 11, 12, 13, 32]] = True
        self._powers = self._inverses = np.ones(1, _U64)

    def _grow(self, length: int) -> None:
        if len(self._powers) < length:
            size = 1 << (length - 1).bit_length()
            steps = np.full(size, _U64(self.BASE))
            back = np.full(size, _U64(pow(self.BASE, -1, 1 << 64)))
            steps[0] = back[0] = 1
            self._powers, self._inverses = np.cumprod(steps), np.cumprod(back)

    def of(self, text: str) -> np.ndarray:
        """The distinct shingles of a text, sorted; a shorter text is one shingle."""
        raw = np.frombuffer(text.encode().lower(), np.uint8)
        self._grow(len(raw))
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = ~self._space[raw]
        edges = np.flatnonzero(np.diff(inside))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return np.empty(0, _U64)
        sums = np.zeros(len(raw) + 1, _U64)
        np.cumsum(self._byte[raw] * self._powers[: len(raw)], out=sums[1:])
        words = _mixed((sums[ends] - sums[starts]) * self._inverses[starts])
        count = max(1, len(words) - self._n + 1)
        made = np.zeros(count, _U64)
        for k in range(min(self._n, len(words))):
            made += words[k : k + count] * self._at[k]
        return np.unique(_mixed(made + _U64(min(self._n, len(words)))))


class Signer:
    """MinHash signatures: the upper halves of the minima of ``n`` linear maps."""

    def __init__(self, n: int):
        self._factor = (_stream(n, 3) | _U64(1))[:, None]
        self._term = _stream(n, 4)[:, None]

    def of(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self._factor), np.iinfo(_U64).max, _U64)
        for at in range(0, len(shingles), 2048):
            block = shingles[None, at : at + 2048] * self._factor
            block += self._term
            np.minimum(least, block.min(axis=1), out=least)
        return (least >> _U64(32)).astype(">u4")


def signed(df: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """``id``, ``n_shingles``, two halves of a digest of the set, and the signature.

    Texts without a word have no shingles, a null digest and a null signature.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, signer = Shingles(shingle), Signer(TREES * DEPTH)
        for batch in batches:
            sizes, highs, lows, signatures = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingles.of(text or "")
                sizes.append(len(found))
                some = len(found) > 0
                highs.append(int(found.sum().view(np.int64)) if some else None)
                lows.append(int(_mixed(found).sum().view(np.int64)) if some else None)
                signatures.append(signer.of(found).tobytes() if some else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(highs, pa.int64()),
                    pa.array(lows, pa.int64()),
                    pa.array(signatures, pa.binary()),
                ],
                ["id", "n_shingles", "high", "low", "signature"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(
        sign, f"id {kind}, n_shingles long, high long, low long, signature binary"
    )


def forest_regions(sets: DataFrame) -> DataFrame:
    """The trees' regions of rows (``id``, ``n_shingles``, ``copies``, ``signature``).

    Each tree orders documents by its own hashes.  A region is a run with the same first hashes;
    documents alone in their region leave that tree.
    """
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    width = 4 * DEPTH
    rows = sets.select("id", "n_shingles", "copies", "signature", tree.alias("tree")).select(
        "id",
        "n_shingles",
        "copies",
        F.expr(f"substring(signature, tree * {width} + 1, {width})").alias("order"),
        F.expr(
            f"xxhash64(tree, substring(signature, tree * {width} + 1, {4 * LEAST_DEPTH}))"
        ).alias("region"),
    )
    shared = rows.groupBy("region").count().where("count > 1").select("region")
    return written(rows.join(shared, "region"), "regions")


def forest_candidates(crowded: DataFrame) -> DataFrame:
    """Candidate pairs ``a`` < ``b`` of documents in the regions of a forest.

    In a region each document is paired with its
    neighbours in order, so the depth to which they agree adapts to how crowded it is.  For what
    neighbours leave out in a crowded region, each document is also paired with three anchors: the
    smallest one (of documents that share one passage it is similar to all that are similar to
    any), the one with most exact copies, and the one that is most often on the commonest full
    signature of its regions (of many edited copies of one text that is the text itself, or the
    copy nearest to it).  ``crowd_links`` finds what all of these leave out.
    """
    ordered = crowded.repartitionByRange("region", "order", "id").sortWithinPartitions(
        "region", "order", "id"
    )

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: list[tuple] = []
        first: list[tuple] = []
        for batch in batches:
            a, b = [], []
            for row in zip(*(batch.column(i).to_pylist() for i in range(3))):
                region, one, size = row
                for other_region, other, other_size in tail:
                    if other_region == region and _alike(size, other_size) and one != other:
                        a.append(min(one, other))
                        b.append(max(one, other))
                tail = [*tail[-NEIGHBOURS + 1 :], row]
                if len(first) < NEIGHBOURS:
                    first.append(row)
            yield _pairs(a, b)
        # The ends of a partition: their neighbours may be in the next one.
        for region, one, size in first:
            yield _pairs([one], [None], region, size, True)
        for region, one, size in tail:
            yield _pairs([one], [None], region, size, False)

    def _pairs(a, b, region=None, size=None, head=None) -> pa.RecordBatch:
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(a, kind_arrow),
                pa.array(b, kind_arrow),
                pa.array([region] * n, pa.int64()),
                pa.array([size] * n, pa.int64()),
                pa.array([head] * n, pa.bool_()),
            ],
            ["a", "b", "region", "size", "head"],
        )

    kind = crowded.schema["id"].dataType.simpleString()
    kind_arrow = to_arrow_type(crowded.schema["id"].dataType)
    found = written(
        ordered.select("region", "id", "n_shingles").mapInArrow(
            neighbours, f"a {kind}, b {kind}, region long, size long, head boolean"
        ),
        "neighbours",
    )
    inside = found.where("b is not null").select("a", "b")
    # A region that goes on in the next partition ends one and starts another: at most
    # 2 * NEIGHBOURS rows a partition meet here.
    ends = found.where("b is null").select(F.col("a").alias("id"), "region", "size", "head")
    across = (
        ends.where(~F.col("head"))
        .join(
            ends.where("head").select(
                F.col("id").alias("other"), "region", F.col("size").alias("other_size")
            ),
            "region",
        )
        .where(F.col("id") != F.col("other"))
        .where(_alike_columns(F.col("size"), F.col("other_size")))
        .select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
    )
    to_anchor = _anchored(crowded)
    return inside.unionByName(across).unionByName(to_anchor).distinct()


def _anchored(crowded: DataFrame) -> DataFrame:
    """Pairs of each document and the anchors of its regions, at several depths."""
    keys = crowded.groupBy("region", "order").count().where("count > 1")
    commonest = keys.groupBy("region").agg(F.max(F.struct("count", "order")).alias("top"))
    typical = crowded.join(
        commonest.select("region", F.col("top.order").alias("order")), ["region", "order"]
    )
    scores = typical.groupBy("id").agg(F.count("*").alias("score"))
    depth = F.explode(F.array(*[F.lit(4 * d) for d in ANCHOR_DEPTHS]))
    parts = (
        crowded.join(scores, "id", "left")
        .select("id", "n_shingles", "copies", "score", "region", "order", depth.alias("width"))
        .select(
            "id",
            "n_shingles",
            "copies",
            F.coalesce("score", F.lit(0)).alias("score"),
            F.expr("xxhash64(region, substring(order, 1, width))").alias("part"),
        )
    )
    one = F.struct("id", "n_shingles").alias("one")
    anchors = parts.groupBy("part").agg(
        F.array_distinct(
            F.array(
                F.min(F.struct("n_shingles", "id", one))["one"],
                F.max(F.struct("copies", one))["one"],
                F.max(F.struct("score", one))["one"],
            )
        ).alias("anchors")
    )
    return (
        parts.join(anchors, "part")
        .select("id", "n_shingles", F.explode("anchors").alias("anchor"))
        .where(F.col("id") != F.col("anchor.id"))
        .where(_alike_columns(F.col("n_shingles"), F.col("anchor.n_shingles")))
        .select(F.least("id", "anchor.id").alias("a"), F.greatest("id", "anchor.id").alias("b"))
    )


def _alike(n: int, m: int) -> bool:
    """Sizes that allow a link."""
    return 100 * min(n, m) >= PERCENT * max(n, m)


def _alike_columns(n, m):
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def confirmed(pairs: DataFrame, df: DataFrame, id_col: str, text: str, shingle: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough; sets are made for their rows only."""
    wanted = written(
        pairs.select(F.explode(F.array("a", "b")).alias("id"))
        .distinct()
        .withColumn("n", F.lit(1)),
        "wanted",
    )
    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    rows = rows.join(wanted.where("n > 0").select("id"), "id", "left_semi").dropDuplicates(["id"])
    kind = df.schema[id_col].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(shingle)
        for batch in batches:
            made = [shingles.of(t or "").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.binary())], ["id", "shingles"]
            )

    with scan_filters(df.sparkSession):
        full = written(rows.mapInArrow(sets, f"id {kind}, shingles binary"), "shingles")
    both = pairs.join(
        full.select(F.col("id").alias("a"), F.col("shingles").alias("of_a")), "a"
    ).join(full.select(F.col("id").alias("b"), F.col("shingles").alias("of_b")), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x = np.frombuffer(left.as_buffer(), _U64)
                y = np.frombuffer(right.as_buffer(), _U64)
                x, y = (x, y) if len(x) < len(y) else (y, x)
                at = np.searchsorted(y, x)
                common = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "of_a", "of_b").mapInArrow(compare, f"a {kind}, b {kind}")


def crowd_links(
    regions: DataFrame, named: DataFrame, df: DataFrame, id_col: str, text: str, shingle: int
) -> DataFrame | None:
    """Links between components (``comp`` of ``named``) in crowded regions; none if all is settled.

    In a region of up to ``NEIGHBOURS + 1`` documents all are neighbours, so only larger ones that
    hold several components can have lost a link.
    """
    left = unsettled(regions, named, NEIGHBOURS + 1)
    if left.isEmpty():
        return None
    texts = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    sets = ordered_sets(left, texts, lambda: Shingles(shingle).of, PERCENT)
    rare = written(rare_pairs(sets, PERCENT), "rare-pairs")
    found = confirmed(rare, df, id_col, text, shingle)
    return found.unionByName(frequent_links(sets, PERCENT))


def near_groups(df: DataFrame, id_col: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """One row per input row: its set's size, its component and whether it stays.

    Documents with equal sets are one node.  Links are confirmed on full sets; a component is
    named by its smallest id, and that row stays.  Rows without a word are linked with nothing.
    Rows with the same id count as one document.  Columns: id, ``n_shingles``, ``component_id``,
    ``kept``.
    """
    with scratch(df.sparkSession) as keep:
        rows = written(signed(df, id_col, text, shingle), "signatures")
        classes = written(
            rows.where("n_shingles > 0")
            .groupBy("high", "low", "n_shingles")
            .agg(F.min("id").alias("first"), F.count("*").alias("copies")),
            "classes",
        )
        sets = (
            rows.where("signature is not null")
            .join(classes.withColumnRenamed("first", "id"), ["high", "low", "n_shingles", "id"])
            .select("id", "n_shingles", "copies", "signature")
            .dropDuplicates(["id"])
        )
        regions = forest_regions(sets)
        pairs = written(forest_candidates(regions), "candidates")
        links = confirmed(pairs, df, id_col, text, shingle)
        grouped = components(links)
        named = written(
            classes.join(grouped, classes["first"] == grouped["node"], "left").select(
                F.col("first").alias("id"), "n_shingles", F.coalesce("component", "first").alias("comp")
            ).dropDuplicates(["id"]),
            "named",
        )
        more = crowd_links(regions, named, df, id_col, text, shingle)
        if more is not None:
            grouped = components(
                grouped.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
            )
        named = classes.join(grouped, classes["first"] == grouped["node"], "left").select(
            "high", "low", "n_shingles", F.coalesce("component", "first").alias("_component")
        )
        joined = rows.drop("signature").join(named, ["high", "low", "n_shingles"], "left")
        component = F.coalesce("_component", "id")
        made = joined.select(
            F.col("id").alias(id_col),
            "n_shingles",
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        )
        return keep(made, "near-groups")


def near_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that stay: one of each component."""
    return without(docs, "doc_id", near_groups(docs, "doc_id", "text"))


@query("op3_minhash_near_dedup")
def op3_minhash_near_dedup(spark, folder):
    """Every document's component of near duplicates."""
    return near_groups(documents(spark, folder), "doc_id", "text")
