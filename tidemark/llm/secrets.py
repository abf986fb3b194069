"""Secrets by fixed patterns, and by automata inferred from the credentials these find."""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import documents, query, written

#: The patterns of the base kinds and the least length of what they find.
ASSIGN = re.compile(
    r"""(?a:(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGNED_LEAST = 8
KINDS = ("assign", "access", "hex")

#: Strings that are scored by format: all runs of credential characters but the full stop.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{8,}")

#: Classes of characters (see ``symbols``), and the marks of a string's beginning and end.
CLASSES, START, END = "fzA0-", "^", "$"

#: The most credentials of a kind that an automaton is inferred from.
EXAMPLES = 400
#: Thresholds are rounded down to so many steps of one.
STEPS = 1000
#: Confidence of the merge test, and the share of examples that may score below the threshold.
ALPHA, MISSED = 0.05, 0.05


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what the fixed patterns find, by start, then kind as listed."""
    found = [
        (m.start(), m.end(), "assign")
        for m in ASSIGN.finditer(text)
        if len(m[1]) >= ASSIGNED_LEAST
    ]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def symbols(value: str) -> str:
    """The classes of a string's characters: hex letters, other small ones, capitals, digits, rest."""
    return "".join(
        "0" if c.isdigit() else "f" if c in "abcdef" else "z" if c.islower() else
        "A" if c.isupper() else "-"
        for c in value
    )


class Automaton:
    """A probabilistic automaton: counts of endings and of transitions by symbol in each state."""

    def __init__(self) -> None:
        self.ends: list[int] = [0]
        self.moves: list[dict[str, list[int]]] = [{}]  # symbol -> [count, next state]

    @classmethod
    def prefix_tree(cls, words: Sequence[str]) -> Automaton:
        tree = cls()
        for word in words:
            state = 0
            for symbol in word:
                move = tree.moves[state].get(symbol)
                if move is None:
                    move = tree.moves[state][symbol] = [0, len(tree.ends)]
                    tree.ends.append(0)
                    tree.moves.append({})
                move[0] += 1
                state = move[1]
            tree.ends[state] += 1
        return tree

    def total(self, state: int) -> int:
        return self.ends[state] + sum(count for count, _ in self.moves[state].values())

    def similar(self, a: int, b: int, alpha: float) -> bool:
        """Whether frequencies after two states differ by chance only (Hoeffding's bound)."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.total(a), self.total(b)
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / alpha)) * (n**-0.5 + m**-0.5)
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for symbol in {*self.moves[a], *self.moves[b]}:
                x, y = self.moves[a].get(symbol), self.moves[b].get(symbol)
                if abs((x[0] / n if x else 0) - (y[0] / m if y else 0)) > bound:
                    return False
                if x and y:
                    todo.append((x[1], y[1]))
        return True

    def fold(self, into: int, root: int) -> None:
        """Adds the tree below ``root`` to ``into``; the caller has led its parent there."""
        todo = [(into, root)]
        while todo:
            into, root = todo.pop()
            self.ends[into] += self.ends[root]
            for symbol, (count, target) in self.moves[root].items():
                move = self.moves[into].get(symbol)
                if move is None:
                    self.moves[into][symbol] = [count, target]
                else:
                    move[0] += count
                    todo.append((move[1], target))

    @classmethod
    def inferred(cls, words: Sequence[str], alpha: float) -> Automaton:
        """Merges each state at the border of the settled ones into the first similar one."""
        made = cls.prefix_tree(words)
        settled = [0]
        while True:
            border = next(
                (
                    (state, symbol, move[1])
                    for state in settled
                    for symbol, move in sorted(made.moves[state].items())
                    if move[1] not in settled
                ),
                None,
            )
            if border is None:
                return made
            parent, symbol, state = border
            for other in settled:
                if made.similar(other, state, alpha):
                    made.moves[parent][symbol][1] = other
                    made.fold(other, state)
                    break
            else:
                settled.append(state)

    def score(self, word: str) -> float:
        """Log-likelihood of a word; an unseen step counts as half an observation and stays."""
        state, sum_log = 0, 0.0
        for symbol in word:
            move, n = self.moves[state].get(symbol), self.total(state)
            if move is None:
                sum_log += math.log(0.5 / (n + 1))
                continue
            sum_log += math.log(move[0] / n)
            state = move[1]
        return sum_log + math.log(max(self.ends[state], 0.5) / max(self.total(state), 1))


@dataclass
class Grammar:
    """Automata of credential formats against the chain of classes in ordinary strings."""

    automata: dict[str, Automaton]
    thresholds: dict[str, float]
    background: dict[str, float]

    def odds(self, kind: str, shape: str) -> float:
        """Log-likelihood ratio per character."""
        plain = sum(map(self.background.__getitem__, steps_of(shape)))
        return (self.automata[kind].score(shape) - plain) / len(shape)

    def accepts(self, shape: str) -> bool:
        return any(self.odds(kind, shape) >= self.thresholds[kind] for kind in self.automata)


def labelled(
    text: str, base: Sequence[tuple[int, int, str]]
) -> Iterator[tuple[str, str]]:
    """Kind and value of the credentials that the fixed patterns find."""
    for start, end, kind in base:
        yield kind, ASSIGN.match(text, start)[1] if kind == "assign" else text[start:end]


def outside(text: str, base: Sequence[tuple[int, int, str]]) -> Iterator[re.Match[str]]:
    """Candidate strings that no base span touches; both are walked once, in order."""
    spans, at, reached = sorted((s, e) for s, e, _ in base), 0, 0
    for m in CANDIDATE.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            reached = max(reached, spans[at][1])
            at += 1
        if reached <= m.start():
            yield m


def steps_of(shape: str) -> Iterator[str]:
    """Neighbouring classes of a shape, its beginning and end included."""
    return map("".join, zip(START + shape, shape + END))


def plain_steps(words: Counter[str]) -> Counter[str]:
    """How often each step occurs in the shapes of some strings."""
    made: Counter[str] = Counter()
    for word, n in words.items():
        for step in steps_of(symbols(word)):
            made[step] += n
    return made


def inferred(shapes: dict[str, Sequence[str]], plain: dict[str, int], alpha: float) -> Grammar:
    """A grammar whose thresholds are still open."""
    background = {}
    for a in START + CLASSES:
        after = {b: plain.get(a + b, 0) + 1 for b in CLASSES + END}
        background |= {a + b: math.log(n / sum(after.values())) for b, n in after.items()}
    automata = {k: Automaton.inferred(sorted(shapes[k]), alpha) for k in KINDS if shapes.get(k)}
    return Grammar(automata, {}, background)


def threshold(steps: dict[int, int]) -> float:
    """The step that all but a share of the labelled credentials reach, from counts of steps."""
    left = int(sum(steps.values()) * MISSED)
    for step in sorted(steps):
        left -= steps[step]
        if left < 0:
            return max(step / STEPS, 0.0)
    return math.inf


def learn(texts: Sequence[str], examples: int = EXAMPLES, alpha: float = ALPHA) -> Grammar:
    """A grammar from the credentials and the other candidate strings of some texts."""
    shapes: dict[str, list[str]] = defaultdict(list)
    plain: Counter[str] = Counter()
    for text in texts:
        for kind, value in labelled(text, base_spans(text)):
            shapes[kind].append(symbols(value))
        plain.update(plain_steps(Counter(m[0] for m in outside(text, base_spans(text)))))
    made = inferred({k: v[:examples] for k, v in shapes.items()}, plain, alpha)
    for kind in made.automata:
        steps = Counter(math.floor(made.odds(kind, shape) * STEPS) for shape in shapes[kind])
        made.thresholds[kind] = threshold(steps)
    return made


def learned(df: DataFrame, text: str, examples: int = EXAMPLES, alpha: float = ALPHA) -> Grammar:
    """A grammar from all rows: every credential counts for thresholds, every other candidate
    string for the background; automata are inferred from at most ``examples`` values a kind, by a hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: Counter[tuple[str, int, str]] = Counter()
            others: Counter[str] = Counter()
            for one in batch.column(0).to_pylist():
                base = base_spans(one or "")
                others.update([m[0] for m in outside(one or "", base)])
                for kind, value in labelled(one or "", base):
                    digest = hashlib.blake2b(value.encode(), digest_size=8).digest()
                    made[kind, int.from_bytes(digest, "big", signed=True), symbols(value)] += 1
            for step, n in plain_steps(others).items():
                made["plain", 0, step] += n
            kinds, keys, shapes = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kinds, pa.string()),
                    pa.array(keys, pa.int64()),
                    pa.array(shapes, pa.string()),
                    pa.array(made.values(), pa.int64()),
                ],
                ["kind", "key", "shape", "n"],
            )

    counted = df.select(text).mapInArrow(count, "kind string, key long, shape string, n long")
    counted = written(counted.groupBy("kind", "key", "shape").agg(F.sum("n").alias("n")), "labelled")
    plain = {r["shape"]: r["n"] for r in counted.where("kind = 'plain'").collect()}
    shapes = {
        kind: [
            r["shape"]
            for r in counted.where(F.col("kind") == kind).orderBy("key", "shape").limit(examples).collect()
        ]
        for kind in KINDS
    }
    made = inferred(shapes, plain, alpha)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = functools.lru_cache(50_000)(made.odds)
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            steps = pa.array([math.floor(odds(*pair) * STEPS) for pair in pairs], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), steps, batch.column(2)], ["kind", "step", "n"]
            )

    rated = (
        counted.where("kind != 'plain'")
        .select("kind", "shape", "n")
        .mapInArrow(rate, "kind string, step long, n long")
        .groupBy("kind", "step")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    for kind in made.automata:
        made.thresholds[kind] = threshold({r["step"]: r["n"] for r in rated if r["kind"] == kind})
    return made


def spans(text: str, grammar: Grammar, accepts) -> list[tuple[int, int, str]]:
    """Base spans and, where no base span is, strings that score as credentials."""
    base = base_spans(text)
    found = list(base)
    for m in outside(text, base):
        if accepts(symbols(m[0])):
            found.append((m.start(), m.end(), "format"))
    order = (*KINDS, "format")
    return sorted(found, key=lambda s: (s[0], order.index(s[2])))


def find_secrets(
    df: DataFrame, id_col: str, text: str, examples: int = EXAMPLES
) -> DataFrame:
    """One row per input row with its spans.

    Credentials that the fixed patterns find in any document label the formats; one automaton for
    each kind is inferred from a bounded number of them, thresholds and background (a chain of
    character classes, from candidate strings outside all base spans) come from all, and every
    candidate string of every whole text is scored by all automata.  Strings at or above a kind's
    threshold, and likelier as a credential than as an ordinary string, are added as kind
    ``format``.  Null texts are empty.  Without any labelled credential only base spans are given.
    Columns: id, ``found`` (array of kind, start, end; code points, end exclusive).
    """
    grammar = learned(df, text, examples)
    kind = df.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accepts = functools.lru_cache(50_000)(grammar.accepts)
        parts = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e} for s, e, k in spans(t or "", grammar, accepts)]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(parts))], ["_id", "found"]
            )

    rows = df.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    made = f"_id {kind}, found array<struct<kind:string,start:long,end:long>>"
    return rows.mapInArrow(scan, made).withColumnRenamed("_id", id_col)


@query("op4_secret_scan")
def op4_secret_scan(spark, folder):
    """Counts and spans of the secrets in every document."""
    found = find_secrets(documents(spark, folder), "doc_id", "text")
    base = F.filter("found", lambda s: s["kind"].isin(*KINDS))

    def joined(spans):
        named = F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        )
        return F.array_join(named, ",")

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
