"""Exact token counts of whole texts and of every prefix of a text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bpe
from tidemark.llm.shared import documents, query

#: Tokens up to which a document is within the limit.
LIMIT = 1024


class PrefixTable:
    """Token counts of all prefixes of one text, from one encoding of the whole text.

    Kept are the count and position at the end of each piece, between which the vocabulary's
    pattern always cuts; counts inside a piece come from its own prefix programme.  White space at
    the end of a prefix is one run, which the pattern cuts in another way than in mid-text.
    """

    def __init__(self, text: str, path: str):
        self.text = text
        self._encoder, self._inside = bpe.encoder(path), bpe.prefix_counts(path)
        chars, tokens = self._encoder.sizes(text)
        self.ends = np.cumsum([0, *chars])
        self.counts = np.cumsum([0, *tokens])

    @property
    def total(self) -> int:
        """Tokens of the whole text."""
        return int(self.counts[-1])

    def at(self, chars: int) -> int:
        """Tokens of the text's first ``chars`` code points."""
        k = int(np.searchsorted(self.ends, chars, side="right")) - 1
        run = chars
        while run and self.text[run - 1] in _SPACES:
            run -= 1
        if run < chars:  # a run of white space ends the prefix
            k = int(np.searchsorted(self.ends, run, side="right")) - 1
            if self.ends[k] == run:
                return int(self.counts[k]) + self._cut(self.text[run:chars])
        return int(self.counts[k]) + self._cut(self.text[self.ends[k] : chars])

    def _cut(self, start_of_piece: str) -> int:
        parts = self._encoder.split.findall(start_of_piece)
        return sum(self._inside.of_text(part)[-1] for part in parts)

    def fitting(self, budget: int) -> int:
        """Most code points that can be kept, in whole pieces and then inside the next one, so
        that the kept prefix has at most ``budget`` tokens."""
        if self.total <= budget:
            return len(self.text)
        k = int(np.searchsorted(self.counts, budget, side="right")) - 1
        chars, end, kept = int(self.ends[k]), int(self.ends[k + 1]), int(self.counts[k])
        piece = self.text[chars:end]
        if self._encoder.is_special(piece):
            for more in range(end - 1, chars, -1):
                if self.at(more) <= budget:
                    return more
        else:
            for part in self._encoder.split.findall(piece):
                inside = self._inside.of_text(part)
                if kept + inside[-1] <= budget:
                    kept += inside[-1]
                    chars += len(part)
                    continue
                # A prefix of a part is cut like the part, contractions and white space excepted.
                like = not part.isspace() and not (part[0] == "'" and len(part) <= 3)
                for more in range(len(part) - 1, 0, -1):
                    if like and part[more - 1] not in _SPACES:
                        tokens = kept + inside[more]
                    else:
                        tokens = self.at(chars + more)
                    if tokens <= budget:
                        return chars + more
                break
        while chars and self.at(chars) > budget:  # white space at the end can count otherwise
            chars -= 1
        return chars


#: The characters of ``bpe.SPACE``.
_SPACES = frozenset("\t\n\x0b\x0c\r\x20\x85\xa0     　") | {
    chr(c) for c in range(0x2000, 0x200B)
}


def prefix_counts(df: DataFrame, id_col: str, text: str, path: str) -> DataFrame:
    """``id`` and ``counts``: the tokens of each prefix of 0, 1, ... code points of the text."""

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, one in enumerate(batch.column(1).to_pylist()):
                table = PrefixTable(one or "", path)
                counts = [table.at(chars) for chars in range(len(table.text) + 1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([counts], pa.list_(pa.int32()))],
                    ["id", "counts"],
                )

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text)).mapInArrow(
        tables, f"id {kind}, counts array<int>"
    )


def token_counts(
    df: DataFrame, id_col: str, text: str, path: str, budgets: Sequence[int] = (LIMIT,)
) -> DataFrame:
    """Tokens of each whole text and where it must be cut for each budget.

    Columns: the id, ``n_bytes`` (UTF-8), ``n_tokens`` and, for each budget, ``fit_<budget>``: the
    code points that can be kept.  A null text counts as empty; rows with the same id are
    counted one by one.  Each text is encoded once, into its table of prefix counts: the number of
    tokens is the last of them, and cuts are read off it.
    """
    wanted = sorted(budgets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_tokens = [], []
            fits: list[list[int]] = [[] for _ in wanted]
            for text in batch.column(1).to_pylist():
                table = PrefixTable(text or "", path)
                n_bytes.append(len(table.text.encode()))
                n_tokens.append(table.total)
                for budget, fit in zip(wanted, fits):
                    fit.append(table.fitting(budget))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, n_tokens, *fits))],
                ["_id", "n_bytes", "n_tokens", *(f"fit_{b}" for b in wanted)],
            )

    kind = df.schema[id_col].dataType.simpleString()
    made = ", ".join(f"{n} long" for n in ("n_bytes", "n_tokens", *(f"fit_{b}" for b in wanted)))
    rows = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    return rows.mapInArrow(count, f"_id {kind}, {made}").withColumnRenamed("_id", id_col)


@query("op6_token_counts")
def op6_token_counts(spark, folder):
    """Bytes, tokens and cutting point of every document."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts(documents(spark, folder), "doc_id", "text", path)
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
