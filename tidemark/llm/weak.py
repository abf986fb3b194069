"""Quality classifier: a weak-label model over heuristic labellers trains a hashed linear scorer."""

from __future__ import annotations

import math
import operator
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import documents, query, scratch, without, written

#: Documents on which the scorer is trained (a bounded sample, chosen by a hash of the id).
TRAINING_ROWS = 4000
#: Share of good documents that a labeller's vote hits at most; borders are set far off for that.
FALSE_VOTES = 0.001
#: Hashed features of the scorer.
DIMENSIONS = 1 << 16
#: Rounds of expectation-maximisation and of training.
ROUNDS, EPOCHS = 50, 12
#: Words of a window in which repeated words are counted.
WINDOW = 400
#: Words whose features a worker keeps.
KEPT_WORDS = 300_000

SYMBOLS = "#*$%&|<>!~^{}"
LETTERS = re.compile(r"[^\W\d_]")

#: For each labeller the measure from which it votes that a document is bad; else it abstains.
BORDERS = {
    "symbols": 0.30,  # symbols per word
    "capitals": 0.60,  # words all in capitals
    "stutter": 0.30,  # words that equal the next one
    "again": 0.40,  # three-word runs that stood there before
    "lines": 0.40,  # lines that stood there before
    "wordless": 0.40,  # words without a letter
    "variety": 0.80,  # words that stood in their window before
}


def measured(words: list[str], text: str) -> list[float]:
    """The labellers' measures of a text with words."""
    n = len(words)
    runs = max(n - 2, 1)
    lines = [line for line in text.split("\n") if line]
    return [
        sum(map(text.count, SYMBOLS)) / n,
        sum(map(str.isupper, words)) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / runs if n > 2 else 0.0,
        1 - len(set(lines)) / max(len(lines), 1),
        sum(1 for w in words if not w[0].isalpha() and not LETTERS.search(w)) / n,
        repeated(words),
    ]


def repeated(words: list[str]) -> float:
    """The share of words that stood in their window of ``WINDOW`` words before; over all words."""
    n = len(words)
    return 1 - sum(len(set(words[at : at + WINDOW])) for at in range(0, n, WINDOW)) / n


def votes(measures: list[float]) -> str:
    """One letter per labeller: b(ad) or - (abstains)."""
    return "".join("b" if m >= border else "-" for m, border in zip(measures, BORDERS.values()))


def weak_labels(counts: dict[str, int], rounds: int = ROUNDS) -> dict[str, float]:
    """The probability that documents with each pattern of votes are bad.

    Expectation-maximisation for two classes and labellers that err independently: each labeller
    has its own chance of a vote in either class, in the good one at most ``FALSE_VOTES``.  Starts
    from the belief that a document with a vote is bad.  There are at most 2 ** labellers patterns, whatever the number of documents.
    """
    patterns = sorted(counts)
    if not patterns:
        return {}
    n = np.array([counts[p] for p in patterns], float)
    seen = np.array([[[v == k for k in "-b"] for v in p] for p in patterns], float)
    posterior = np.where(seen[:, :, 1].any(1), 0.9, 0.05)
    for _ in range(rounds):
        by_class = []
        for p, most in ((1 - posterior, FALSE_VOTES), (posterior, 1.0)):
            weight = (n * p)[:, None, None]
            table = (weight * seen).sum(0) + 0.1
            table /= table.sum(1, keepdims=True)
            table[:, 1] = np.minimum(table[:, 1], most)
            table[:, 0] = 1 - table[:, 1]
            table = np.maximum(table, 1e-12)
            by_class.append(math.log((n * p).sum() + 1) + (seen * np.log(table)).sum((1, 2)))
        gap = np.clip(by_class[0] - by_class[1], -40, 40)
        posterior = 1 / (1 + np.exp(gap))
    return dict(zip(patterns, posterior.tolist()))


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % DIMENSIONS


def shape(word: str) -> str:
    """A word's outline: runs of capitals, small letters and digits as one sign, others kept."""
    out = ""
    for c in word[:24]:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out.endswith(kind):
            out += kind
    return out


def _word_slots(word: str) -> tuple[int, int]:
    return _slot("s:" + shape(word)), _slot("w:" + word[:40].lower())


def _measure_slots(measures: list[float]) -> list[int]:
    """Each measure as the steps of a tenth that it reaches."""
    return [
        _slot(f"m:{name}:{step}")
        for name, m in zip(BORDERS, measures)
        for step in range(1, min(int(m * 10), 10) + 1)
    ]


def features(words: list[str], measures: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: words share one unit of weight, each reached step of a measure has one."""
    own = np.array([s for w in words for s in _word_slots(w)], np.int64)
    steps = np.array(_measure_slots(measures), np.int64)
    slots, counts = np.unique(own, return_counts=True)
    return (
        np.concatenate([slots, steps]),
        np.concatenate([counts / len(words), np.ones(len(steps))]),
    )


class Scorer:
    """A logistic scorer over hashed features."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self._kept: dict[str, float] = {}

    @classmethod
    def trained(cls, rows: list[tuple[np.ndarray, np.ndarray, float]], epochs: int) -> Scorer:
        """Adaptive gradient steps over the rows in their order; labels are probabilities."""
        weights, squares, bias = np.zeros(DIMENSIONS), np.full(DIMENSIONS, 1e-2), 0.0
        for epoch in range(epochs):
            for slots, values, label in rows:
                margin = float(weights[slots] @ values) + bias
                slope = 1 / (1 + math.exp(-max(min(margin, 30), -30))) - label
                step = slope * values
                squares[slots] += step * step
                weights[slots] -= 0.3 * step / np.sqrt(squares[slots])
                bias -= 0.02 * slope / (1 + epoch)
        return cls(weights, bias)

    def _of_word(self, word: str) -> float:
        value = self._kept.get(word)
        if value is None:
            if len(self._kept) >= KEPT_WORDS:
                self._kept.clear()
            a, b = _word_slots(word)
            value = self._kept[word] = float(self.weights[a] + self.weights[b])
        return value

    def probability(self, words: list[str], measures: list[float]) -> float:
        """That a document is bad."""
        margin = self.bias + sum(map(self._of_word, words)) / len(words)
        margin += float(self.weights[_measure_slots(measures)].sum())
        return 1 / (1 + math.exp(-max(min(margin, 30), -30)))


def vote_counts(df: DataFrame, text: str) -> dict[str, int]:
    """How many documents have each pattern of votes; over all documents."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for one in batch.column(0).to_pylist():
                words = (one or "").split()
                made.append(votes(measured(words, one)) if words else None)
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.string())], ["votes"])

    voted = df.select(text).mapInArrow(vote, "votes string")
    rows = voted.where("votes is not null").groupBy("votes").count().collect()
    return {r["votes"]: r["count"] for r in rows}


def train(df: DataFrame, id_col: str, text: str, rows: int = TRAINING_ROWS) -> Scorer:
    """A scorer from weak labels; patterns are counted over all rows, training rows are bounded."""
    labels = weak_labels(vote_counts(df, text))
    chosen = written(
        df.select(id_col).distinct().orderBy(F.xxhash64(id_col), id_col).limit(rows), "training-ids"
    )
    kind = df.schema[id_col].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, values, patterns = [], [], []
            for one in batch.column(1).to_pylist():
                words = (one or "").split()
                m = measured(words, one) if words else None
                found = features(words, m) if words else (None, None)
                slots.append(found[0])
                values.append(found[1])
                patterns.append(votes(m) if words else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(slots, pa.list_(pa.int64())),
                    pa.array(values, pa.list_(pa.float64())),
                    pa.array(patterns, pa.string()),
                ],
                ["id", "slots", "values", "votes"],
            )

    # Features of whole texts are made where the texts are; they are bounded by the dimensions.
    found = (
        df.select(F.col(id_col), F.col(text).alias("_text"))
        .join(F.broadcast(chosen), id_col)
        .limit(rows)
        .select(F.col(id_col).alias("id"), "_text")
        .mapInArrow(made, f"id {kind}, slots array<bigint>, values array<double>, votes string")
        .where("votes is not null")
        .collect()
    )
    made_of = [
        (np.array(r["slots"]), np.array(r["values"]), labels.get(r["votes"], 0.5))
        for r in sorted(found, key=lambda r: zlib.crc32(str(r["id"]).encode()))
    ]
    return Scorer.trained(made_of, EPOCHS)


def classify(df: DataFrame, id_col: str, text: str, rows: int = TRAINING_ROWS) -> DataFrame:
    """One row per input row: ``score`` (probability of low quality) and ``kept`` (below a half).

    Whole texts are scored.  A text without a word has score 1 and goes.  An empty table gives an
    empty result.  Rows with the same id are scored one by one.
    """
    scorer = train(df, id_col, text, rows)
    kind = df.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, patterns = [], []
            for one in batch.column(1).to_pylist():
                words = (one or "").split()
                measures = measured(words, one) if words else None
                made.append(scorer.probability(words, measures) if words else 1.0)
                patterns.append(votes(measures) if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.float64()), pa.array(patterns, pa.string())],
                ["_id", "score", "votes"],
            )

    rows_ = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    scored = rows_.mapInArrow(score, f"_id {kind}, score double, votes string")
    return scored.withColumn("kept", F.col("score") < 0.5).withColumnRenamed("_id", id_col)


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps."""
    with scratch(spark) as keep:
        kept = keep(classify(docs, "doc_id", "text").select("doc_id", "kept"), "kept")
    return without(docs, "doc_id", kept)


@query("op7_quality_classifier")
def op7_quality_classifier(spark, folder):
    """Score and verdict of every document."""
    return classify(documents(spark, folder), "doc_id", "text")
