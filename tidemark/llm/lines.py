"""Fuzzy line deduplication: MinHash bands, exact Jaccard verification, union-find."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import FILTER_WORDS, documents, possible, query, scratch, written

#: Characters of a shingle and the least similarity of two lines' shingle sets, in percent.
SHINGLE, PERCENT = 5, 75
#: Bands and hashes of a band: lines at the least similarity meet in one with 97.8 %.
BANDS, ROWS = 10, 4
#: A band key ends with a sketch: a size step and one bit of each of the first minima.
SIZE_BITS, SKETCH_BITS = 6, 22
#: Bits of two sketches that agree at least; lines at the least similarity do with 99.6 %.
AGREEING = 15
#: Rows on either side of a cut between partitions that are compared across it.
ENDS = 4
#: Characters that are signed at a time, and repeated lines that a worker recognises.
BLOCK, SEEN = 1 << 16, 200_000
#: Pairs of lines that are compared at a time.
TOGETHER = 200
#: Distinct lines of a band up to which the first and the previous one are all the others.
WHOLE = 3
#: Lines and characters of a part of a crowded band; larger bands are compared part by part.
PART_LINES, PART_CHARS = 1000, 1 << 22
#: Bits of a line's parities: a power of two, from its number of distinct shingles on.
LEAST_BITS, MOST_BITS = 64, 1 << 16
#: Pairs a line up to which a part's possible pairs are listed; bins a shingle in other parts.
LISTED, BINS = 2, 16
#: Rows of bands or parts, and words of parities, that are looked at together.
AT_ONCE, WORDS = 1 << 17, 1 << 18

_U64 = np.uint64
Keep = Callable[[DataFrame, str], DataFrame]
_TAIL = SIZE_BITS + SKETCH_BITS


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values."""
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


def _fixed(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit values."""
    return _mixed(np.arange(1, n + 1, dtype=_U64) + _U64(seed << 32)) | _U64(1)


class LineSigner:
    """MinHash bands of lines from one hash of each character shingle.

    Hashes fall into bins and each bin's least one is a MinHash; an empty bin borrows from a
    full one that its own fixed sequence of bins meets first, so the result depends on the set
    of shingles alone.
    """

    def __init__(self):
        self._at = _fixed(SHINGLE, 1)
        self._row = _fixed(ROWS, 2)
        self._band = _fixed(BANDS, 3)
        bins = BANDS * ROWS
        draws = _mixed(np.arange(bins * 32, dtype=_U64) + _U64(7 << 32)) % _U64(bins)
        self._lenders = draws.astype(np.int64).reshape(32, bins)

    def hashes(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The hashed shingles of all lines, repeats included, and how many each line has.

        A line that is shorter than a shingle is one.
        """
        gap = "\n" * (SHINGLE - 1)
        codes = np.frombuffer((gap.join(lines) + gap).encode("utf-32-le", "surrogatepass"), "<u4")
        lengths = np.fromiter(map(len, lines), np.int64, len(lines))
        counts = np.maximum(lengths - SHINGLE + 1, 1)
        parts = np.empty(2 * len(lines), np.int64)
        parts[::2], parts[1::2] = counts, lengths + len(gap) - counts
        real = np.repeat(np.tile([True, False], len(lines)), parts)
        codes = np.concatenate([codes, np.zeros(SHINGLE - 1, codes.dtype)]).astype(_U64)
        made = codes[: len(real)] * self._at[0]
        for k in range(1, SHINGLE):
            made += codes[k : k + len(real)] * self._at[k]
        return _mixed(made[real]), counts

    def parities(self, lines: list[str], bits: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """How many distinct shingles each line has, and for each of the bins whether it is odd.

        Two lines with d shingles that only one of them has differ in d bins at most.
        """
        each, sizes = self._distinct(*self.hashes(lines))
        odd = self._odd(each, np.full(len(lines), bits))
        return sizes, odd.view(np.int64).reshape(len(lines), -1)

    @staticmethod
    def _distinct(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each line's number above 40 bits of each of its distinct shingles; how many those are."""
        line = np.repeat(np.arange(len(counts), dtype=_U64), counts)
        each = np.sort(line << _U64(40) | hashes & _U64((1 << 40) - 1))
        each = each[np.diff(each, prepend=~each[:1]) != 0]
        return each, np.bincount((each >> _U64(40)).astype(np.int64), minlength=len(counts))

    @staticmethod
    def _odd(each: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """The parities of so many bins of each line, packed, line after line."""
        owner = (each >> _U64(40)).astype(np.int64)
        bins = (np.cumsum(bits) - bits)[owner] + (each.astype(np.int64) & (bits - 1)[owner])
        return np.packbits((np.bincount(bins, minlength=bits.sum()) & 1).astype(np.uint8))

    def of(self, lines: list[str]) -> np.ndarray:
        """For each line its band keys: a hash of the band, then the line's sketch."""
        return self.signed(lines)[0]

    def signed(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Band keys, numbers of distinct shingles, bytes of parities, and all parities.

        A line has as many bins as distinct shingles at least, if not more than ``MOST_BITS``.
        """
        bins = BANDS * ROWS
        hashes, counts = self.hashes(lines)
        places = ((hashes >> _U64(40)) * _U64(bins) >> _U64(24)).astype(np.int64)
        places += np.repeat(np.arange(len(lines)) * bins, counts)
        none = np.iinfo(_U64).max
        least = np.full(len(lines) * bins, none, _U64)
        np.minimum.at(least, places, hashes)
        least = least.reshape(len(lines), bins)
        line, at = np.nonzero(least == none)
        if len(line):
            whole, least = least, least.copy()
            for lenders in self._lenders:
                lent = whole[line, lenders[at]]
                least[line, at] = lent
                left = lent == none
                line, at = line[left], at[left]
                if not len(line):
                    break
            least[line, at] = whole.min(axis=1)[line]
        keys = (least.reshape(len(lines), BANDS, ROWS) * self._row).sum(axis=2, dtype=_U64)
        keys = _mixed(keys * self._band + self._band)
        signs = (_mixed(least[:, :SKETCH_BITS]) & _U64(1)) << np.arange(SKETCH_BITS, dtype=_U64)
        # Steps of a quarter of the distinct shingles: similar lines are at most two steps apart.
        each, sizes = self._distinct(hashes, counts)
        step = np.minimum(np.log(sizes) / np.log(4 / 3), 2**SIZE_BITS - 1).astype(_U64)
        sketch = signs.sum(axis=1, dtype=_U64) | step << _U64(SKETCH_BITS)
        keys = (keys >> _U64(_TAIL) << _U64(_TAIL) | sketch[:, None]).view(np.int64)
        bits = np.clip(1 << np.ceil(np.log2(sizes)).astype(np.int64), LEAST_BITS, MOST_BITS)
        return keys, sizes, bits // 8, self._odd(each, bits)


def _alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the sketches of two rows of band keys allow a link."""
    low = np.int64((1 << SKETCH_BITS) - 1)
    differ = np.bitwise_count((x ^ y) & low)
    steps = np.int64((1 << SIZE_BITS) - 1)
    apart = ((x >> SKETCH_BITS) & steps) - ((y >> SKETCH_BITS) & steps)
    return (differ <= SKETCH_BITS - AGREEING) & (np.abs(apart) <= 2)


def numbered(text: str | None) -> Iterator[tuple[int, str]]:
    """The lines with a word, without blanks at their ends, and their numbers."""
    for at, line in enumerate((text or "").split("\n")):
        line = line.strip(" ")
        if line.strip("\t\x0b\x0c\r "):
            yield at, line


def digest_of(line: str) -> bytes:
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _key_bits(keys: DataFrame) -> np.ndarray:
    """As in ``possible``, a bounded table of words whose bits tell which lines may be wanted.

    First halves of digests are as good as hashed.
    """
    name = keys.columns[0]
    bits = keys.groupBy(F.expr(f"{name} & {FILTER_WORDS - 1}").alias("word")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned({name}, 58) as int)))").alias("bits")
    )
    found = bits.toArrow()  # at most FILTER_WORDS rows of two numbers
    table = np.zeros(FILTER_WORDS, np.int64)
    table[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return table


def line_texts(df: DataFrame, text: str, sent: Broadcast[np.ndarray]) -> DataFrame:
    """``k1``, ``k2`` and the text of the lines that may be wanted by ``_key_bits``.

    Repeats within a batch come once.  Workers look the bits up, so that all other lines stay
    where they are cut.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value.view(_U64)
        for batch in batches:
            lines = list({line for one in batch.column(0) for _, line in numbered(one.as_py())})
            keys = np.frombuffer(b"".join(map(digest_of, lines)), np.int64).reshape(-1, 2)
            hashed = keys[:, 0].copy().view(_U64)
            word = table[(hashed & _U64(FILTER_WORDS - 1)).astype(np.int64)]
            wanted = np.flatnonzero(word >> (hashed >> _U64(58)) & _U64(1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[wanted, 0]),
                    pa.array(keys[wanted, 1]),
                    pa.array([lines[at] for at in wanted], pa.string()),
                ],
                ["k1", "k2", "line"],
            )

    return df.select(text).mapInArrow(split, "k1 long, k2 long, line string")


def places(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """One row per line with a word: ``doc``, ``at``, two halves of a digest, and its signs.

    Those are its band keys, ``chars``, the number ``size`` of its distinct shingles and their
    parities ``odd``.  A line that a worker has just seen has null bands and no other signs.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, seen = LineSigner(), set()
        for batch in batches:
            of, ats, digests, new, chars = [], [], [], [], []
            waiting, size, made = [], 0, []
            for row, one in enumerate(batch.column(1)):
                for at, line in numbered(one.as_py()):
                    digest = digest_of(line)
                    of.append(row)
                    ats.append(at)
                    digests.append(digest)
                    new.append(digest not in seen)
                    chars.append(len(line))
                    if new[-1]:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(digest)
                        waiting.append(line)
                        size += len(line)
                        if size >= BLOCK:
                            made.append(signer.signed(waiting))
                            waiting, size = [], 0
            if waiting:
                made.append(signer.signed(waiting))
            keys = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            none = [np.empty((0, BANDS), np.int64), *[np.empty(0, np.int64)] * 2, np.empty(0, np.uint8)]
            signed, sizes, lengths, odd = map(np.concatenate, zip(*made)) if made else none
            new = np.array(new, bool)
            ends = np.concatenate([[0], np.cumsum(new, dtype=np.int64) * BANDS]).astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(ends, mask=None), pa.array(signed.ravel()), mask=pa.array(~new)
            )
            size, cuts = np.zeros(len(new), np.int64), np.zeros(len(new) + 1, np.int64)
            size[new], cuts[1:][new] = sizes, lengths
            cuts = pa.py_buffer(np.cumsum(cuts).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(of, pa.int64())),
                    pa.array(ats, pa.int32()),
                    pa.array(keys[:, 0].copy()),
                    pa.array(keys[:, 1].copy()),
                    lists,
                    pa.array(chars, pa.int64()),
                    pa.array(size),
                    pa.Array.from_buffers(pa.binary(), len(new), [None, cuts, pa.py_buffer(odd)]),
                ],
                ["doc", "at", "k1", "k2", "bands", "chars", "size", "odd"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("doc"), F.col(text).alias("text")).mapInArrow(
        sign,
        f"doc {kind}, at int, k1 long, k2 long, bands array<bigint>, chars long, size long, odd binary",
    )


def band_pairs(lines: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """Pairs ``k1`` - ``other`` of lines that share a band and have sketches that allow a link.

    Also the lines ``run``, ``k1`` of crowded bands, in which these are not all the pairs.

    Rows are sorted by band over all partitions, so a band of any size may be cut.  Within one,
    each line is paired with the first and with the one before, which has the nearest sketch of
    those sorted before it.  First keys stand for lines here; should two lines have the same
    one, both are compared.
    """
    rows = lines.where("bands is not null").select(F.explode("bands").alias("band"), "k1")
    # Sorted by one number, which Spark does by radix; equal bands are ordered by key below.
    rows = rows.repartitionByRange("band", "k1").sortWithinPartitions("band")

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = None, None
        for bands, keys, ended in _whole_runs(batches):
            order = np.lexsort((keys, bands))
            bands, keys = bands[order], keys[order]
            runs = bands >> _TAIL
            starts = np.flatnonzero(np.diff(runs, prepend=runs[0] - 1))
            lengths = np.diff(starts, append=len(runs))
            leader, here = np.repeat(starts, lengths), np.arange(len(runs))
            fresh = np.ones(len(runs), bool)
            fresh[1:] = (np.diff(bands) != 0) | (np.diff(keys) != 0)
            crowded = np.add.reduceat(fresh, starts, dtype=np.int64) > WHOLE
            # Bands at the ends may be crowded together with another partition's lines.
            crowded[0] |= first is None
            crowded[-1] |= ended
            members = fresh & np.repeat(crowded, lengths)
            yield _rows(runs[members], keys[members], None, True)
            a, b = [], []
            for there in (leader, np.maximum(here - 1, leader)):
                good = (keys != keys[there]) & _alike(bands, bands[there])
                a.append(keys[good])
                b.append(keys[there][good])
            a, b = np.concatenate(a), np.concatenate(b)
            yield _rows(np.minimum(a, b), np.maximum(a, b), None)
            if first is None:
                first = keys[:ENDS], bands[:ENDS]
                yield _rows(*first, True)
            if ended:
                last = np.unique([*here[-ENDS:], leader[-1]])
                yield _rows(keys[last], bands[last], False)

    def _rows(k1, other, head, crowd=False) -> pa.RecordBatch:
        heads = pa.nulls(len(k1), pa.bool_()) if head is None else pa.array(np.full(len(k1), head))
        return pa.RecordBatch.from_arrays(
            [pa.array(k1), pa.array(other), heads, pa.array(np.full(len(k1), crowd))],
            ["k1", "other", "head", "crowd"],
        )

    found = keep(
        rows.mapInArrow(pair, "k1 long, other long, head boolean, crowd boolean"), "band-pairs"
    )
    members = found.where("crowd").select(F.col("k1").alias("run"), F.col("other").alias("k1"))
    found = found.where("not crowd")
    # The ends of partitions (a few rows each), where a band may go on in the next one.
    ends = found.where("head is not null").select(
        "k1", F.shiftright("other", _TAIL).alias("band"), F.col("other").alias("x"), "head"
    )
    after = ends.where("head").select(F.col("k1").alias("k"), "band", F.col("x").alias("y"))
    across = (
        ends.where("not head")
        .join(after, "band")
        .where("k1 != k")
        .select(F.least("k1", "k").alias("k1"), F.greatest("k1", "k").alias("other"))
    )
    pairs = found.where("head is null").select("k1", "other").unionByName(across).distinct()
    return keep(pairs, "line-pairs"), members


def _whole_runs(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Sorted band keys and lines, in blocks that end with a band, and whether all have come."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([batch.column(at).to_numpy() for at in range(2)])
        n += batch.num_rows
        if n < AT_ONCE:
            continue
        bands, keys = map(np.concatenate, zip(*held))
        cut = int(np.searchsorted(bands >> _TAIL, bands[-1] >> _TAIL))
        if cut:
            yield bands[:cut], keys[:cut], False
        # A band that fills the block waits for more, up to all that the partition has of it.
        held, n = [[bands[cut:], keys[cut:]]], 0
    if held:
        bands, keys = map(np.concatenate, zip(*held))
        yield bands, keys, True


def line_parities(
    pairs: DataFrame, members: DataFrame, lines: DataFrame, keep: Keep
) -> DataFrame:
    """``k1``, ``k2``, ``chars``, ``size``, ``odd`` of the lines of pairs and of crowded bands.

    ``odd`` are the parities of ``LineSigner.signed``, which stand for the lines until few pairs
    are left.
    """
    keys = pairs.select(F.explode(F.array("k1", "other")).alias("k1")).unionByName(members.select("k1"))
    with scratch(lines.sparkSession):
        wanted = written(keys.distinct(), "wanted-lines")
        new = lines.where("bands is not null").select("k1", "k2", "chars", "size", "odd")
        found = possible(new, F.col("k1"), wanted).where("_possible").drop("_possible")
        found = found.join(wanted, "k1", "left_semi").dropDuplicates(["k1", "k2"])
        return keep(found, "line-parities")


def wanted_texts(keys: DataFrame, df: DataFrame, text: str) -> DataFrame:
    """``k1``, ``k2``, ``line`` of the lines with the given ``k1``, cut out of ``df`` again."""
    with scratch(df.sparkSession) as keep:
        wanted = written(keys.distinct(), "wanted-lines")
        sent = df.sparkSession.sparkContext.broadcast(_key_bits(wanted))
        found = line_texts(df, text, sent).join(wanted, "k1", "left_semi")
        made = keep(found.dropDuplicates(["k1", "k2"]), "line-texts", "zstd")
        sent.destroy()
        return made


class Parities:
    """Parities of lines, each of as many words as it has."""

    def __init__(self, words: np.ndarray, widths: np.ndarray):
        self._words, self._widths = words, widths
        self._starts = np.cumsum(widths) - widths

    @classmethod
    def column(cls, column: pa.Array) -> Parities:
        """Those of a binary column without nulls."""
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1]
        words = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].copy()
        return cls(words.view(_U64), np.diff(ends).astype(np.int64) // 8)

    @classmethod
    def joined(cls, one: Parities, two: Parities) -> Parities:
        """Those of one and then those of the other."""
        pairs = (one._words, two._words), (one._widths, two._widths)
        return cls(*map(np.concatenate, pairs))

    def allow(self, sizes: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether the lines of two numbers each may be similar; none that are is left out.

        Of n + m shingles of two similar lines at most a seventh stand in one of them only.
        """
        less, more = np.minimum(sizes[one], sizes[two]), np.maximum(sizes[one], sizes[two])
        good = 100 * less >= PERCENT * more
        width = np.minimum(self._widths[one], self._widths[two])
        for w in np.unique(width[good]):
            here = np.flatnonzero(good & (width == w))
            for part in np.split(here, range(WORDS // w, len(here), WORDS // w)):
                differ = self._folded(one[part], w) ^ self._folded(two[part], w)
                apart = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
                good[part] = (100 + PERCENT) * apart <= (100 - PERCENT) * (less + more)[part]
        return good

    def _folded(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Words of that many bins: a bin is odd if an odd number of those it takes in are."""
        at = self._starts[rows][:, None] + np.arange(width)
        made = self._words[at]
        left = self._widths[rows]
        for step in range(1, int(left.max(initial=0)) // width):
            more = left > step * width
            made[more] ^= self._words[at[more] + step * width]
        return made


def plausible(pairs: DataFrame, parities: DataFrame) -> DataFrame:
    """The pairs that the parities do not rule out; see ``Parities.allow``."""
    mine = parities.select("k1", "size", "odd")
    theirs = mine.withColumnsRenamed({"k1": "other", "size": "_size", "odd": "_odd"})
    less, more = "least(size, _size)", "greatest(size, _size)"
    both = pairs.join(mine, "k1").join(theirs, "other").where(f"100 * {less} >= {PERCENT} * {more}")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                sizes = np.concatenate([batch.column(at).to_numpy() for at in (2, 4)])
                odd = Parities.joined(*(Parities.column(batch.column(at)) for at in (3, 5)))
                good = odd.allow(sizes, np.arange(n), np.arange(n, 2 * n))
                yield batch.select([0, 1]).filter(pa.array(good))

    both = both.select("k1", "other", "size", "odd", "_size", "_odd")
    return both.mapInArrow(look, "k1 long, other long").distinct()


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a`` - ``b`` of lines whose full character-shingle sets are similar enough."""
    key = F.struct("k1", "k2")
    mine = texts.select("k1", key.alias("a"), F.col("line").alias("x"))
    theirs = texts.select(F.col("k1").alias("other"), key.alias("b"), F.col("line").alias("y"))
    both = pairs.join(mine, "k1").join(theirs, "other")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleSets()
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                keep = sets.alike(part.column(2).to_pylist(), part.column(3).to_pylist())
                yield part.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    node = "struct<k1: bigint, k2: bigint>"
    return both.select("a", "b", "x", "y").mapInArrow(compare, f"a {node}, b {node}")


def possible_pairs(
    sizes: np.ndarray,
    words: Parities | np.ndarray,
    group: np.ndarray,
    part: np.ndarray | None = None,
    done: np.ndarray | None = None,
    side: np.ndarray | None = None,
) -> Iterator[np.ndarray]:
    """Blocks of pairs of rows of different groups that may be similar; none that are is left out.

    Rows of different parts are not paired, nor are those of one of a part's two sides, 1 and 2.
    Parts that are marked as done after a block get no more pairs.  All parts are looked at
    together: rows stand by size, and each meets the ones after it while they are close enough.
    """
    if isinstance(words, np.ndarray):
        words = Parities(words.ravel(), np.full(len(words), words.shape[1]))
    part = np.zeros(len(sizes), np.int64) if part is None else part
    side = np.zeros(len(sizes), np.int64) if side is None else side
    order = np.lexsort((sizes, part))
    sizes_, part_, group_, side_ = sizes[order], part[order], group[order], side[order]
    rows, step = np.arange(len(order)), 0
    one, two, n = [], [], 0
    while len(rows):
        step += 1
        rows = rows[: np.searchsorted(rows, len(order) - step)]
        near = part_[rows] == part_[rows + step]
        rows = rows[near & (100 * sizes_[rows] >= PERCENT * sizes_[rows + step])]
        met = group_[rows] != group_[rows + step]
        met &= (side_[rows] == 0) | (side_[rows] != side_[rows + step])
        one.append(rows[met])
        two.append(rows[met] + step)
        n += len(one[-1])
        if n >= AT_ONCE or not len(rows):
            a, b = order[np.concatenate(one)], order[np.concatenate(two)]
            good = words.allow(sizes, a, b)
            a, b = a[good], b[good]
            yield np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)
            one, two, n = [], [], 0
            if done is not None:
                rows = rows[~done[part_[rows]]]


def crowd_links(
    members: DataFrame, parities: DataFrame, grouped: DataFrame, df: DataFrame, text: str
) -> DataFrame:
    """Links ``a`` - ``b`` that join what is still apart in crowded bands.

    ``grouped`` has the groups of lines linked so far.  A band whose lines are all in one group is
    settled.  In any other, every line is compared with all lines of other groups; large bands are
    cut into parts, and each two parts meet in a task of their own.  Bands get the parities of
    their lines, which rule out most pairs for certain; each other pair is compared exactly once,
    in however many bands it stands.  Only parts with many such pairs get their lines.
    """
    with scratch(df.sparkSession) as keep:
        named = written(
            parities.join(
                grouped.select(
                    F.col("node.k1").alias("k1"),
                    F.col("node.k2").alias("k2"),
                    F.col("component.k1").alias("c1"),
                    F.col("component.k2").alias("c2"),
                ),
                ["k1", "k2"],
                "left",
            ).withColumns({"c1": F.coalesce("c1", "k1"), "c2": F.coalesce("c2", "k2")}),
            "line-groups",
        )
        group = F.struct("c1", "c2")
        open_runs = written(
            members.join(named.select("k1", "c1", "c2", "chars"), "k1")
            .groupBy("run")
            .agg(
                F.min(group).alias("low"),
                F.max(group).alias("high"),
                F.greatest(
                    F.ceil(F.count("*") / PART_LINES), F.ceil(F.sum("chars") / PART_CHARS)
                ).alias("parts"),
            )
            .where("low != high")
            .select("run", "parts"),
            "open-bands",
        )
        pairs = written(
            _possible_links(_dealt(members, open_runs).join(named.select("k1", "c1", "c2", "size", "odd"), "k1")), "crowd-pairs"
        )
        listed = pairs.where("run is null").select("k1", "other").distinct()
        keys = listed.select(F.explode(F.array("k1", "other")).alias("k1"))
        crowded = pairs.where("run is not null").select("run", "x", "y")
        if crowded.isEmpty():
            return keep(similar(listed, wanted_texts(keys, df, text)), "crowd-links")
        dealt = _dealt(members, open_runs.join(crowded.select("run").distinct(), "run"))
        dealt = dealt.join(crowded, ["run", "x", "y"]).join(named.select("k1", "c1", "c2"), "k1")
        dealt = written(dealt, "crowd-parts")
        texts = wanted_texts(keys.unionByName(dealt.select("k1")), df, text)
        links = similar(listed, texts).unionByName(_exact_links(dealt.join(texts, "k1")))
        return keep(links, "crowd-links")


def _dealt(members: DataFrame, runs: DataFrame) -> DataFrame:
    """The lines of each two parts ``x``, ``y`` of a band, and of each part by itself.

    Lines of two parts that meet are on two sides: those of one part meet among themselves.
    """
    part = F.pmod(F.xxhash64("k1"), "parts").cast("int")
    other = F.explode(F.expr("sequence(0, cast(parts - 1 as int))"))
    side = F.expr("cast(case when x = y then 0 when x < y then 1 else 2 end as long)")
    both = members.join(runs, "run").select("run", "k1", part.alias("x"), other.alias("y"))
    ends = F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")
    return both.select("run", *ends, "k1", side.alias("side"))


def _possible_links(dealt: DataFrame) -> DataFrame:
    """Pairs ``k1`` - ``other`` of all parts that may be similar; parts with many are listed instead."""
    rows = (
        dealt.select("run", "x", "y", "k1", "c1", "c2", "side", "size", "odd")
        .repartition("run", "x", "y")
        .sortWithinPartitions("run", "x", "y")
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, starts in _parts(batches):
            k1, c1, c2, side, size = (part.column(at).to_numpy() for at in range(3, 8))
            lengths = np.diff(starts, append=part.num_rows)
            number = np.repeat(np.arange(len(starts)), lengths)
            order = np.lexsort((c2, c1))
            group = np.zeros(len(order), np.int64)
            group[order[1:]] = np.cumsum((np.diff(c1[order]) != 0) | (np.diff(c2[order]) != 0))
            listed, n = [], np.zeros(len(starts), np.int64)
            done = n > 0
            odd = Parities.column(part.column(8))
            for block in possible_pairs(size, odd, group, number, done, side):
                listed.append(block)
                n += np.bincount(number[block[:, 0]], minlength=len(n))
                done[:] = n > LISTED * lengths
            ends = np.concatenate([np.empty((0, 2), np.int64), *listed])
            ends = k1[ends[~done[number[ends[:, 0]]]]]
            first = part.select([0, 1, 2]).take(pa.array(starts[done]))
            yield _rows(pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1)), *[None] * 3)
            yield _rows(None, None, *first.columns)

    def _rows(*columns: pa.Array | None) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        n = next(len(one) for one in columns if one is not None)
        filled = [pa.nulls(n, k) if one is None else one.cast(k) for one, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(filled, ["k1", "other", "run", "x", "y"])

    return rows.mapInArrow(look, "k1 long, other long, run long, x int, y int")


def _exact_links(dealt: DataFrame) -> DataFrame:
    """Links that join the groups of each part, with all shingles of its lines."""
    rows = (
        dealt.select("run", "x", "y", "k1", "k2", "c1", "c2", "side", "line")
        # A number of partitions is kept, while Spark would join small ones by their bytes.
        .repartition(int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")), "run", "x", "y")
        .sortWithinPartitions("run", "x", "y")
    )

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ShingleSets()
        for rows, starts in _parts(batches, 1):
            for start, end in zip(starts, [*starts[1:], rows.num_rows]):
                part = rows.slice(start, end - start)
                k = [part.column(at).to_numpy() for at in range(3, 8)]
                _, group = np.unique(np.stack(k[2:4], axis=1), axis=0, return_inverse=True)
                a, b = sets.joining(part.column(8).to_pylist(), group.ravel(), k[4])
                halves = [pa.array(k[0]), pa.array(k[1])]
                nodes = pa.StructArray.from_arrays(halves, ["k1", "k2"])
                yield pa.RecordBatch.from_arrays(
                    [nodes.take(pa.array(a, pa.int64())), nodes.take(pa.array(b, pa.int64()))], ["a", "b"]
                )

    node = "struct<k1: bigint, k2: bigint>"
    return rows.mapInArrow(settle, f"a {node}, b {node}")


def _parts(
    batches: Iterator[pa.RecordBatch], least: int = AT_ONCE
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of whole parts of bands, ``least`` or more at a time, and where each part begins."""
    held, n = [], 0

    def cut(rows: pa.RecordBatch) -> np.ndarray:
        keys = np.stack([rows.column(at).to_numpy().astype(np.int64) for at in range(3)], axis=1)
        return np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= least:
            rows = pa.concat_batches(held)
            starts = cut(rows)
            if len(starts) > 1:
                yield rows.slice(0, starts[-1]), starts[:-1]
            held, n = [rows.slice(starts[-1])], 0
    if held:
        rows = pa.concat_batches(held)
        yield rows, cut(rows)


class ShingleSets:
    """Sets of hashed shingles; those of the last lines are kept, up to a number of shingles."""

    def __init__(self, most: int = 1 << 21):
        self._signer, self._most = LineSigner(), most
        self._sets, self._held = {}, 0

    def _load(self, lines: set[str]) -> None:
        if self._held > self._most:
            self._sets.clear()
            self._held = 0
        new = [line for line in lines if line not in self._sets]
        if new:
            hashes, counts = self._signer.hashes(new)
            for line, made in zip(new, np.split(hashes, np.cumsum(counts)[:-1])):
                made = np.sort(made)
                self._sets[line] = made[np.diff(made, prepend=~made[:1]) != 0]
            self._held += len(hashes)

    def joining(
        self, lines: list[str], group: np.ndarray, side: np.ndarray | None = None
    ) -> tuple[list[int], list[int]]:
        """Places of two lines each: links that join all groups which similar lines join.

        With so many bins a shingle, parities leave few pairs that are not similar; those of
        groups that are still apart are compared on all shingles.  Lines of one of two sides are
        not compared.
        """
        self._load(set(lines))
        sets = [self._sets[line] for line in lines]
        sizes = np.array([len(s) for s in sets])
        bits = np.clip(1 << np.ceil(np.log2(BINS * sizes)).astype(np.int64), LEAST_BITS, None)
        owner = np.repeat(np.arange(len(sets)), sizes)
        bins = (np.concatenate(sets) & (bits - 1).astype(_U64)[owner]).astype(np.int64)
        words = np.zeros(bits.sum() // 64, _U64)
        at = (np.cumsum(bits) - bits)[owner] + bins
        np.bitwise_xor.at(words, at >> 6, _U64(1) << (at & 63).astype(_U64))
        group, a, b = group.copy(), [], []
        for block in possible_pairs(sizes, Parities(words, bits // 64), group, side=side):
            for i, j in block[group[block[:, 0]] != group[block[:, 1]]].tolist():
                if group[i] != group[j] and self._enough(sets[i], sets[j]):
                    a.append(i)
                    b.append(j)
                    group[group == group[j]] = group[i]
        return a, b

    def alike(self, left: list[str], right: list[str]) -> list[bool]:
        """Whether each line on the left is similar enough to the one on the right."""
        self._load({*left, *right})
        return [self._enough(self._sets[x], self._sets[y]) for x, y in zip(left, right)]

    @staticmethod
    def _enough(one: np.ndarray, two: np.ndarray) -> bool:
        less, more = sorted((len(one), len(two)))
        if 100 * less < PERCENT * more:
            return False
        both = np.concatenate([one, two])
        both.sort()
        common = int(np.count_nonzero(both[1:] == both[:-1]))
        return 100 * common >= PERCENT * (less + more - common)


def _first_groups(pairs: DataFrame, parities: DataFrame, df: DataFrame, text: str) -> DataFrame:
    """The components of the pairs that are similar enough."""
    with scratch(df.sparkSession) as keep:
        left = written(plausible(pairs, parities), "plausible-pairs")
        keys = left.select(F.explode(F.array("k1", "other")).alias("k1"))
        links = keep(similar(left, wanted_texts(keys, df, text)), "line-links")
    return components(links)


def _joined_groups(first: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``first`` and of links between lines, which join those of their ends."""
    with scratch(links.sparkSession) as keep:
        group = F.coalesce("component", "node")
        ends = links.select(F.col("a").alias("node"), "b").join(first, "node", "left")
        ends = ends.select(group.alias("a"), F.col("b").alias("node")).join(first, "node", "left")
        joined = components(ends.select("a", group.alias("b")))
        into = joined.select(F.col("component").alias("_into"), F.col("node").alias("component"))
        moved = first.join(into, "component", "left").select(
            "node", F.coalesce("_into", "component").alias("component")
        )
        fresh = joined.join(first, "node", "left_anti")
        return keep(moved.unionByName(fresh), "components")


def repeated_lines(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``doc`` and ``dropped``: the numbers of the lines of each document that go.

    Of equal or similar lines, over chains of similarity, one stays: the first one of the
    smallest document.  Lines without a word are left alone.  Documents that lose no line, null
    and empty texts are not listed; rows with the same id are taken for one document, whose
    lines have the same numbers.
    """
    with scratch(df.sparkSession) as keep:
        with scratch(df.sparkSession) as hold:
            signed = written(places(df, id_col, text), "signed-lines")
            pairs, members = band_pairs(signed, hold)
            parities = line_parities(pairs, members, signed, hold)
            lines = hold(signed.select("doc", "at", "k1", "k2"), "lines")
        first = _first_groups(pairs, parities, df, text)
        more = crowd_links(members, parities, first, df, text)
        grouped = _joined_groups(first, more).select(
            F.col("node.k1").alias("k1"),
            F.col("node.k2").alias("k2"),
            F.col("component.k1").alias("c1"),
            F.col("component.k2").alias("c2"),
        )
        # Only lines that may be in a group, and then those that may be in one of several, are
        # shuffled to be joined.
        marked = possible(lines.select("doc", "at", "k1", "k2"), F.col("k1"), grouped.select("k1"))
        joined = marked.where("_possible").join(grouped, ["k1", "k2"], "left")
        alone = marked.where("not _possible").withColumns({"c1": F.lit(None), "c2": F.lit(None)})
        named = written(
            joined.unionByName(alone).select(
                "doc", "at", F.coalesce("c1", "k1").alias("c1"), F.coalesce("c2", "k2").alias("c2")
            ),
            "named-lines",
        )
        groups = written(
            named.groupBy("c1", "c2")
            .agg(F.min("doc").alias("keeper"), F.count("*").alias("n"))
            .where("n > 1")
            .drop("n"),
            "several",
        )
        named = possible(named, F.col("c1"), groups.select("c1")).where("_possible").drop("_possible")
        # Dealt by document after the join, so that a group of any size can be split in it.
        found = (
            named.join(groups, ["c1", "c2"])
            .repartition("doc")
            .groupBy("doc", "c1", "c2", "keeper")
            .agg(F.array_sort(F.collect_set("at")).alias("at"))
        )
        dropped = F.when(
            F.col("doc") == F.col("keeper"), F.slice("at", F.lit(2), F.size("at"))
        ).otherwise(F.col("at"))
        gone = (
            found.select("doc", dropped.alias("at"))
            .where(F.size("at") > 0)
            .groupBy("doc")
            .agg(F.flatten(F.collect_list("at")).alias("dropped"))
        )
        return keep(gone, "dropped-lines")


def _without_repeats(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Id, text without its repeated lines, all other columns as ``rest``, and both counts."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in (id_col, text)]
    rest = F.struct(*others) if others else F.lit(None)
    gone = repeated_lines(df, id_col, text)
    gone = gone.withColumnsRenamed({"doc": "_doc", "dropped": "_dropped"})
    # Documents that surely lose no line go on where they are read; only the others are shuffled.
    rows = df.select(id_col, text, rest.alias("rest"))
    marked = possible(rows, F.col(id_col), gone.select("_doc"))
    touched = marked.where("_possible").drop("_possible")
    joined = touched.join(gone, F.col(id_col) == F.col("_doc"), "left").unionByName(
        marked.where("not _possible").drop("_possible"), allowMissingColumns=True
    )
    lines = F.split(text, "\n", -1)
    # The dropped numbers are few; a map of them is looked up once per line.
    kept = F.filter(lines, lambda line, at: ~F.array_contains("_dropped", at))
    return joined.select(
        id_col,
        F.when(F.col("_dropped").isNull(), F.col(text))
        .otherwise(F.array_join(kept, "\n"))
        .alias(text),
        "rest",
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).alias("n_dropped"),
    )


def deduplicated(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``df`` with its repeated lines taken out of ``text``, and ``n_lines``, ``n_dropped``.

    Columns of ``df`` with these two names are replaced; all others are carried as they are.
    """
    made = _without_repeats(df, id_col, text)
    counts = ["n_lines", "n_dropped"]
    carried = [
        F.col(c) if c in (id_col, text) else F.col("rest").getField(c).alias(c)
        for c in df.columns
        if c not in counts
    ]
    return made.select(*carried, *counts)


def line_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their repeated lines taken out; ``n_chars`` follows the text."""
    made = _without_repeats(docs, "doc_id", "text")

    def carried(name: str):
        if name in ("doc_id", "text"):
            return F.col(name)
        value = F.col("rest").getField(name)
        if name == "n_chars":
            length = F.length("text").cast(docs.schema[name].dataType)
            value = F.when(F.col("n_dropped") > 0, length).otherwise(value)
        return value.alias(name)

    return made.select(*map(carried, docs.columns))


@query("op8_line_dedup")
def op8_line_dedup(spark, folder):
    """Every document's lines, how many go, and a digest of the text that stays."""
    made = deduplicated(documents(spark, folder), "doc_id", "text")
    return made.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    )
