"""Toxicity: lexicon and pattern voters, a label model of their correlations, a linear scorer."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import documents, query, written

#: Labelled documents of each class from which lexicons and scorer are learned (a bounded sample,
#: chosen by a hash of the id).  Votes are counted over all documents.
TRAINING_ROWS = 6000
#: Terms of all lexicons together, and of the first choice whose surroundings are looked at.
LEXICON, FIRST_CHOICE = 2000, 20_000
#: Log odds of toxic documents, and these in standard errors, from which a term is in the weak and
#: in the strong lexicon of its kind.
WEAK, STRONG = (1.5, 2.5), (3.0, 3.5)
#: Begins of words that are terms of their own, besides whole words.
PREFIXES = (3, 4, 5, 6)
#: Shares: distinct words that are terms; words in capitals; exclamation marks per word.
DENSE, SHOUTED, EXCLAIMED = 0.004, 0.6, 0.3
#: Class-conditional correlation from which voters are modelled jointly, and how many at most.
CORRELATED, CLIQUE = 0.3, 4
#: Share of wrong labels that the model assumes at most: labels say which class is which.
WRONG = 0.01
#: Weight of all rows without a label against those with one, where there are labels.
UNLABELLED = 0.25
#: Rounds of expectation-maximisation and steps of training; words that a worker keeps.
ROUNDS, STEPS, KEPT_WORDS = 40, 400, 300_000

KINDS = ("word", *(f"begin{n}" for n in PREFIXES))
#: The lexicon voters say toxic or abstain.  The label that a training row came with is one more
#: voter, with an accuracy of its own; it is absent from what is scored.
VOTERS = (
    *(f"{strength}-{kind}" for kind in KINDS for strength in ("strong", "weak")),
    "several",
    "dense",
    "nothing",
    "shouting",
    "exclaiming",
)
STEPS_OF = {"hits": (1, 2, 3, 5, 8, 13, 21, 34), "density": (0.001, 0.002, 0.004, 0.008, 0.016)}
OWN = len(VOTERS) + sum(map(len, STEPS_OF.values()))  # features before the terms'
LETTERS = re.compile(r"[^\W\d_]+")


def terms(word: str) -> list[str]:
    """The word itself, and its begins where they are shorter."""
    return [word[:40] + ".", *(word[:n] for n in PREFIXES if len(word) > n)]


def kind(term: str) -> int:
    return 0 if term.endswith(".") else PREFIXES.index(len(term)) + 1


class Lexicons:
    """The terms of toxic documents, each with its number and voter; looked up word by word."""

    def __init__(self, found: list[tuple[str, bool]]):
        self.number = {term: i for i, (term, _) in enumerate(found)}
        self.voter = [2 * kind(term) + (not strong) for term, strong in found]
        self._kept: dict[str, tuple[int, ...]] = {}

    def of(self, word: str) -> tuple[int, ...]:
        value = self._kept.get(word)
        if value is None:
            if len(self._kept) >= KEPT_WORDS:
                self._kept.clear()
            own = (self.number.get(t) for t in terms(word))
            value = self._kept[word] = tuple(i for i in own if i is not None)
        return value

    def read(self, text: str) -> tuple[str, list[int]]:
        """The votes on a text (t toxic, c clean, - none), and the slots of its features."""
        words = set(LETTERS.findall(text.lower()))
        found = [own for own in map(self.of, words) if own]
        numbers = {i for own in found for i in own}
        split = text.split()
        said = ["-"] * len(VOTERS)
        for i in numbers:
            said[self.voter[i]] = "t"
        density = len(found) / max(len(words), 1)
        shouted = sum(map(str.isupper, split)) / max(len(split), 1)
        patterns = (
            (len(found) > 1, "t"),
            (density >= DENSE and len(found) > 0, "t"),
            (not found, "c"),
            (shouted >= SHOUTED, "t"),
            (text.count("!") >= EXCLAIMED * max(len(split), 1), "t"),
        )
        said[-len(patterns) :] = [vote if true else "-" for true, vote in patterns]
        slots = [i for i, vote in enumerate(said) if vote != "-"]
        at = len(VOTERS)
        for value, borders in zip((len(found), density), STEPS_OF.values()):
            slots += [at + i for i, border in enumerate(borders) if value >= border]
            at += len(borders)
        return "".join(said), slots + sorted(OWN + i for i in numbers)


def fold(id_col: str) -> Column:
    """0 for documents that are held out; a null id counts as an empty text, which is."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def _term_rows(sample: DataFrame, schema: str, of: Callable) -> DataFrame:
    """Rows of ``schema``, two names and how often: ``of`` gives a document's pairs of names."""
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            made = [[k[0] for k in counts], [k[1] for k in counts], list(counts.values())]
            return pa.RecordBatch.from_arrays(
                [pa.array(made[0], pa.string()), pa.array(made[1], pa.int64()), pa.array(made[2], pa.int64())],
                names,
            )

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update(of((text or "").lower(), toxic))
                if len(counts) > KEPT_WORDS:
                    yield rows()
                    counts.clear()
        yield rows()

    return sample.select("_text", "toxic").mapInArrow(run, schema)


def find_lexicon(sample: DataFrame, totals: dict[int, int], most: int = LEXICON) -> list:
    """(term, strong) of the terms that surely stand more often in toxic documents.

    Copies of one document would make all its words look sure, so in toxic documents a term counts
    once for each word that follows it somewhere: what is inserted in many texts has many.
    """

    def all_terms(text: str, toxic: int) -> set:
        return {(t, toxic) for w in set(LETTERS.findall(text)) for t in terms(w)}

    shards = _term_rows(sample, "term string, toxic long, n long", all_terms)
    number = shards.groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"),
    )

    def rated(df: DataFrame, border: tuple[float, float]) -> DataFrame:
        def share(n: str, all_of: int) -> Column:
            return F.log((F.col(n) + 0.5) / F.lit(all_of + 1))

        odds = share("toxic", totals.get(1, 0)) - share("clean", totals.get(0, 0))
        error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
        sure = df.withColumns({"odds": odds, "sure": odds / error})
        return sure.where((F.col("odds") >= border[0]) & (F.col("sure") >= border[1]))

    first = rated(number.where("toxic > 1"), WEAK)
    first = first.orderBy(F.col("sure").desc(), "term").limit(FIRST_CHOICE).drop("odds", "sure")
    first = written(first, "first-terms")
    candidates = {r.term for r in first.select("term").collect()}

    def surroundings(text: str, toxic: int) -> set:
        words = LETTERS.findall(text)
        return {
            (t, zlib.crc32(after.encode()))
            for w, after in zip(words, words[1:] + [""])
            for t in terms(w)
            if t in candidates
        }

    around = _term_rows(sample.where("toxic = 1"), "term string, after long, n long", surroundings)
    around = around.groupBy("term").agg(F.count_distinct("after").alias("around"))
    counted = first.join(around, "term").withColumn("toxic", F.least("toxic", "around"))
    best = rated(counted, WEAK).orderBy(F.col("sure").desc(), "term").limit(most)
    strong = (F.col("odds") >= STRONG[0]) & (F.col("sure") >= STRONG[1])
    return [(r.term, r.strong) for r in best.select("term", strong.alias("strong")).collect()]


class LabelModel:
    """A generative model of votes: class, then each clique of voters given the class.

    Starts with every voter alone, estimates by expectation-maximisation, measures how voters
    still correlate within the classes, joins those that do into cliques with one joint table
    each, and estimates again.  So voters that say the same thing count once, not many times.
    """

    def __init__(self, counts: dict[str, float], rounds: int = ROUNDS):
        self.patterns = sorted(counts)
        self.n = np.array([counts[p] for p in self.patterns], float)
        toxic, clean, none = (
            self.n[[p[-1] == v for p in self.patterns]].sum() for v in ("t", "c", "-")
        )
        # Labels, where there are any, say how many documents are toxic and outweigh the rest.
        self.share = (toxic + 1) / (toxic + clean + 2) if toxic + clean else None
        if toxic + clean and none:
            few = min(1.0, UNLABELLED * (toxic + clean) / none)
            self.n *= [few if p[-1] == "-" else 1.0 for p in self.patterns]
        self.posterior = np.array([self._start(p) for p in self.patterns])
        voters = range(len(self.patterns[0]))
        self.cliques = [(v,) for v in voters]
        self._estimate(rounds)
        self.correlation = self._correlations()
        self.cliques = self._joined(self.correlation)
        self._estimate(rounds)

    @staticmethod
    def _start(pattern: str) -> float:
        given = {"t": 0.95, "c": 0.02}.get(pattern[-1])
        said = pattern[:-1].count("t")
        return given if given is not None else 0.02 if said < 2 else 0.6

    def _estimate(self, rounds: int) -> None:
        codes = []
        given = np.array(["-ct".index(p[-1]) for p in self.patterns])
        for clique in self.cliques[:-1]:
            own = ["".join(p[v] for v in clique) for p in self.patterns]
            codes.append(np.unique(own, return_inverse=True)[1])
        for _ in range(rounds):
            logs = []
            for wrong, share in (("t", 1 - self.posterior), ("c", self.posterior)):
                weight = self.n * share
                prior = (weight.sum() + 1) / (self.n.sum() + 2)
                if self.share is not None:
                    prior = self.share if wrong == "c" else 1 - self.share
                log = np.full(len(self.n), math.log(prior))
                # A missing label says nothing; those there are may be wrong, but seldom are.
                right, off = (weight[given == "-ct".index(v)].sum() for v in ("ct".strip(wrong), wrong))
                rate = min((off + 0.5) / (right + off + 10), WRONG)
                log += np.log(np.where(given == 0, 1, np.where(given == "-ct".index(wrong), rate, 1 - rate)))
                for code in codes:
                    table = np.bincount(code, weights=weight) + 0.5
                    log += np.log(table / table.sum())[code]
                logs.append(log)
            self.posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -40, 40)))

    def _correlations(self) -> np.ndarray:
        """The larger of two voters' correlations (speaks or not) within either class."""
        spoke = np.array([[v != "-" for v in p] for p in self.patterns], float)
        found = np.zeros((spoke.shape[1],) * 2)
        for share in (1 - self.posterior, self.posterior):
            weight = self.n * share
            off = spoke - (weight @ spoke) / max(weight.sum(), 1e-9)
            both = (off * weight[:, None]).T @ off
            spread = np.sqrt(np.outer(np.diag(both), np.diag(both)))
            found = np.maximum(found, np.where(spread > 1e-6, np.abs(both) / np.maximum(spread, 1e-6), 0))
        return found

    def _joined(self, correlation: np.ndarray) -> list[tuple[int, ...]]:
        group = {v: (v,) for v in range(len(correlation))}
        pairs = [(correlation[a, b], a, b) for a in group for b in group if a < b]
        for much, a, b in sorted(pairs, reverse=True):
            if much >= CORRELATED and group[a] != group[b]:
                both = tuple(sorted(group[a] + group[b]))
                # The given label stays a voter of its own, the last.
                if len(both) <= CLIQUE and len(correlation) - 1 not in both:
                    group.update(dict.fromkeys(both, both))
        return sorted(set(group.values()), key=max)

    def of(self) -> dict[str, float]:
        """The probability that documents with each pattern are toxic."""
        return dict(zip(self.patterns, self.posterior.tolist()))


def train_scorer(rows: list[tuple[list[int], float, float]], size: int) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer from (slots, probability, weight of the row)."""
    weights, bias = np.zeros(size), 0.0
    if not rows:
        return weights, -10.0
    sizes = np.array([len(r[0]) for r in rows])
    slots = np.array([s for r in rows for s in r[0]], np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    label, much = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    much = much / much.sum()
    squares, bias_square = np.full(size, 1e-12), 1e-12
    for _ in range(STEPS):
        margin = bias + np.bincount(row, weights=weights[slots], minlength=len(rows))
        slope = much * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label)
        step = np.bincount(slots, weights=slope[row], minlength=size) + 1e-6 * weights
        squares += step * step
        weights -= 0.3 * step / np.sqrt(squares)
        bias_square += slope.sum() ** 2
        bias -= 0.3 * slope.sum() / math.sqrt(bias_square)
    return weights, float(bias)


def classify(
    df: DataFrame,
    id_col: str,
    text: str,
    labels: DataFrame,
    label_id: str,
    label: str,
    rows: int = TRAINING_ROWS,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` (probability of toxic), ``predicted``.

    Learns only from labels of documents that are not held out; a document's label, id and other
    columns are no input of its score.  Whole texts are read.  Null and empty texts get the score
    of texts without a word; rows with the same id are scored one by one; a null id has no label
    and is held out.  Of several labels of an id the largest counts, null labels none.  Without a
    labelled toxic document nothing is toxic; an empty table gives an empty result.

    Two passes over texts: the sampled ones for the lexicons, then all of them for votes and
    features, which are written and from then on stand for the texts.
    """
    kind_ = df.schema[id_col].dataType.simpleString()
    texts = df.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
    known = (
        labels.select(F.col(label_id).alias("_id"), F.col(label).alias("_label"))
        .where("_id is not null and _label is not null")
        .where(fold("_id") != 0)
        .groupBy("_id")
        .agg((F.max("_label") > 0).cast("int").alias("toxic"))
    )
    known = written(known, "labels")
    order = [F.xxhash64(F.col("_id").cast("string")), "_id"]
    picked = [known.where(f"toxic = {y}").orderBy(*order).limit(rows) for y in (0, 1)]
    chosen = written(picked[0].unionByName(picked[1]), "training-ids")
    # At most two times TRAINING_ROWS ids are sent.
    sample = written(texts.join(F.broadcast(chosen), "_id").select("_text", "toxic"), "sample")
    sampled = {r.toxic: r["count"] for r in chosen.groupBy("toxic").count().collect()}
    lexicons = Lexicons(find_lexicon(sample, sampled))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [lexicons.read(one or "") for one in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([m[0] for m in made], pa.string()),
                    pa.array([m[1] for m in made], pa.list_(pa.int32())),
                ],
                ["_id", "votes", "slots"],
            )

    featured = written(
        texts.mapInArrow(read, f"_id {kind_}, votes string, slots array<int>"), "votes"
    )
    given = F.when(F.col("toxic") == 1, "t").when(F.col("toxic") == 0, "c").otherwise("-")
    said = featured.select("_id", "votes").join(known, "_id", "left")
    patterns = said.groupBy(F.concat("votes", given).alias("votes")).count().collect()
    counts = {r.votes: r["count"] for r in patterns}
    posterior = LabelModel(counts).of() if counts else {}
    # Classes are sampled apart, so each row stands for as many as its class has rows.
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    learned = (
        featured.join(F.broadcast(chosen), "_id")
        .groupBy("_id", "toxic")
        .agg(F.min(F.struct("votes", "slots")).alias("_row"))
        .select("_id", "toxic", "_row.*")
        .collect()
    )
    weights, bias = train_scorer(
        [
            (r.slots, posterior[r.votes + "ct"[r.toxic]], totals[r.toxic] / sampled[r.toxic])
            for r in sorted(learned, key=lambda r: str(r._id))
        ],
        OWN + len(lexicons.number),
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = batch.column(1)
            sizes = slots.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            own = weights[slots.flatten().to_numpy(zero_copy_only=False)]
            row = np.repeat(np.arange(len(sizes)), sizes)
            margin = bias + np.bincount(row, weights=own, minlength=len(sizes))
            found = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["_id", "score"])

    scored = featured.select("_id", "slots").mapInArrow(score, f"_id {kind_}, score double")
    return scored.select(
        F.col("_id").alias(id_col),
        (fold("_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op12_toxicity")
def op12_toxicity(spark, folder):
    """Score of every document, learned from the labels that are not held out."""
    labels = spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")
    return classify(documents(spark, folder), "doc_id", "text", labels, "doc_id", "toxic")
