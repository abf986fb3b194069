"""Phrase collocation mining: double-array tries count the phrases that can be frequent."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import documents, query, written

LONGEST, LEAST, TOP = 5, 100, 2000
#: Phrases of one broadcast trie; more phrases make more tries, each with a pass over the texts.
TRIE_PHRASES = 1_000_000
#: Bytes of text that a task cuts into words at a time; names, and states of eight bytes, that it
#: gathers before it hands them on.
CHUNK_BYTES, NAMES, STATES = 2_000_000, 500_000, 4_000_000

#: Bytes that end a piece; in UTF-8 they are never part of another character, and 0xFF never occurs.
ENDS, BREAK = b".,;:!?\n\x0b\x0c\r", b"\xff"
_TABLE = bytes(
    0xFF if b in ENDS else b + 32 if 65 <= b <= 90 else 32 if b == 9 else b for b in range(256)
)


def word_chunks(batch: pa.RecordBatch, size: int = CHUNK_BYTES) -> Iterator[tuple[str, list]]:
    """(lang, words with a ``BREAK`` between pieces) of about ``size`` bytes of the same lang.

    A text longer than that is cut at the end of a piece; a longer piece stays whole.
    """
    texts: dict[str, list[bytes]] = {}
    held: Counter = Counter()

    def words(lang: str) -> tuple[str, list]:
        held[lang] = 0
        return lang, BREAK.join(texts.pop(lang)).replace(BREAK, b" \xff ").split(b" ")

    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        text = (text or b"").translate(_TABLE)
        while text:
            cut = len(text)
            if cut > size:
                cut = text.rfind(BREAK, 0, size)
                cut = text.find(BREAK, size) if cut < 0 else cut
                cut = len(text) if cut < 0 else cut
            texts.setdefault(lang, []).append(text[:cut])
            held[lang] += cut
            text = text[cut + 1 :]
            if held[lang] >= size:
                yield words(lang)
    for lang in list(texts):
        yield words(lang)


def _scan(texts: DataFrame, schema: str, shard: Callable) -> DataFrame:
    """Rows of ``schema`` from a pass over all texts, with what ``shard()`` gathers in each task.

    It has ``add(lang, words)``, which tells whether it is full, and ``columns()``, which gives
    all that was added and forgets it.
    """
    names, kinds = zip(*(c.split(" ") for c in schema.split(", ")))
    types = [{"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}[k] for k in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shard()

        def rows() -> pa.RecordBatch:
            made = [pa.array(c, t) for c, t in zip(own.columns(), types)]
            return pa.RecordBatch.from_arrays(made, list(names))

        for batch in batches:
            for lang, words in word_chunks(batch):
                if own.add(lang, words):
                    yield rows()
        yield rows()

    return texts.mapInArrow(run, schema)


class NameShard:
    """Counts by name: (lang, word), or what is made of a text."""

    def __init__(self, names: Callable):
        self.names, self.counts = names, {}

    def add(self, lang: str, words: list) -> bool:
        self.counts.setdefault(lang, Counter()).update(self.names(lang, words))
        return sum(map(len, self.counts.values())) > NAMES

    def columns(self) -> list[list]:
        for counts in self.counts.values():
            counts.pop(BREAK, None), counts.pop(b"", None)
        made = [
            [lang for lang, counts in self.counts.items() for _ in counts],
            [name for counts in self.counts.values() for name in counts],
            [n for counts in self.counts.values() for n in counts.values()],
        ]
        self.counts = {}
        return made


class StateShard:
    """Counts of accepting states: sorted numbers, each with how often it was reached."""

    def __init__(self, reached: Callable, columns: Callable):
        self.reached, self.named = reached, columns
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def _sum(self) -> int:
        states = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in self.parts)])
        counts = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in self.parts)])
        states, place = np.unique(states, return_inverse=True)
        self.parts = [(states, np.bincount(place, counts, len(states)).astype(np.int64))]
        return len(states)

    def add(self, lang: str, words: list) -> bool:
        self.parts.append(np.unique(self.reached(lang, words), return_counts=True))
        return sum(len(p[0]) for p in self.parts) > 2 * STATES and self._sum() > STATES

    def columns(self) -> list[np.ndarray]:
        self._sum()
        (states, counts), self.parts = self.parts[0], []
        return [*self.named(states), counts]


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, phrase, a) of every word, counted in the tasks before Spark sums."""
    shards = _scan(
        texts, "lang string, phrase binary, a long", lambda: NameShard(lambda lang, words: words)
    )
    return shards.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def _numbered(df: DataFrame, label: str) -> DataFrame:
    """The rows with a ``number`` that stays, as it is written."""
    return written(df.withColumn("number", F.monotonically_increasing_id()), label)


@dataclass
class Trie:
    """A double array: from state s, word number w leads to t = base[s] + w if check[t] is s."""

    starts: dict[str, int]
    words: dict[bytes, int]
    base: np.ndarray
    check: np.ndarray
    phrases: np.ndarray  # of each accepting state, the number of its phrase

    def step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and where there is one."""
        to = self.base[states] + words
        return to, (words > 0) & (np.take(self.check, to, mode="clip") == states)

    def walk(self, lang: str, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions where a phrase of ``length`` words begins, and its accepting states.

        All positions go on together, one word at a time; the rest fall out.
        """
        if lang not in self.starts or len(at) < length:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        where = np.flatnonzero(at[: len(at) - length + 1])
        states = np.full(len(where), self.starts[lang], np.int64)
        for level in range(length):
            to, found = self.step(states, at[where + level])
            where, states = where[found], to[found]
        return where, states


def build_trie(langs: pa.Array, phrases: pa.Array) -> Trie:
    """The trie of distinct phrases with equally many words; state numbers from 1.

    Children with brothers are placed first, the largest families before the others, where all of
    them find free states; single children fill the holes.
    """
    coded = pc.split_pattern(phrases, b" ").flatten().dictionary_encode()
    words = {w: i for i, w in enumerate(coded.dictionary.to_pylist(), 1)}
    at = coded.indices.to_numpy().astype(np.int64).reshape(len(phrases), -1) + 1
    coded = langs.dictionary_encode()
    starts = {lang: i for i, lang in enumerate(coded.dictionary.to_pylist(), 1)}
    states = coded.indices.to_numpy().astype(np.int64) + 1
    used = np.zeros(at.size + len(words) + len(starts) + 64, bool)
    used[: len(starts) + 1] = True
    base, check = np.zeros(len(used), np.int32), np.full(len(used), -1, np.int32)

    def room(to: int) -> None:
        nonlocal used, base, check
        if to > len(used):
            more = max(to, 2 * len(used)) - len(used)
            used = np.r_[used, np.zeros(more, bool)]
            base = np.r_[base, np.zeros(more, np.int32)]
            check = np.r_[check, np.full(more, -1, np.int32)]

    for level in range(at.shape[1]):
        # The children of this level: every state with the next words of its phrases.
        edges, own = np.unique(states * (len(words) + 1) + at[:, level], return_inverse=True)
        parent, word = np.divmod(edges, len(words) + 1)
        first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        number = np.diff(np.r_[first, len(parent)])
        place = np.zeros(len(edges), np.int64)
        cursor = len(starts) + 1
        families = np.flatnonzero(number > 1)
        for i in families[np.argsort(-number[families], kind="stable")]:
            children = slice(first[i], first[i] + number[i])
            apart = word[children] - word[first[i]]
            while True:  # the first place at which the states of all children are free
                room(cursor + 64 + int(apart[-1]) + 1)
                tried = np.arange(cursor, cursor + 64)
                tried = tried[~used[tried]]
                fits = tried[~used[tried[:, None] + apart].any(1)]
                if len(fits):
                    break
                cursor += 64
            place[children] = fits[0] + apart
            used[place[children]] = True
        single = first[number == 1]
        room(int(used.sum()) + len(single) + 1)
        place[single] = np.flatnonzero(~used)[: len(single)]
        used[place[single]] = True
        base[parent], check[place] = place - word, parent
        states = place[own]
    size = int(used.nonzero()[0][-1]) + 2  # the last one leads nowhere, for steps beyond the end
    phrase_of = np.zeros(size, np.int64)
    phrase_of[states] = np.arange(len(states))
    return Trie(starts, words, base[:size], check[:size], phrase_of)


def longer_counts(
    texts: DataFrame, frequent: DataFrame, length: int, least: int, most: int = TRIE_PHRASES
) -> DataFrame:
    """(lang, phrase, a) of the phrases one word longer that occur ``least`` times.

    ``frequent`` are all frequent phrases of ``length`` words.  By Apriori a longer phrase can be
    frequent only if it begins and, one word on, ends with one of them.  So candidates are pairs of
    accepting states one word apart; the trie's last level is these pairs, numbered and not
    stored, for all that could be joined grow with the square of a word's neighbours.  Only states
    that are reached are counted.

    If the phrases take several tries, the end of a phrase may lie in another one; then the next
    word itself is counted, whatever it is, which is as exact.
    """
    context = texts.sparkSession.sparkContext
    tries = -(-frequent.count() // most)
    made = []
    for i in range(tries):
        own = frequent.where(F.pmod(F.xxhash64("lang", "phrase"), F.lit(tries)) == i)
        names = _numbered(own.select("lang", "phrase"), "trie-phrases")
        table = names.toArrow()  # at most about `most` phrases
        if not len(table):
            continue
        trie = build_trie(*(table.column(c).combine_chunks() for c in ("lang", "phrase")))
        sent = context.broadcast((trie, table.column("number").to_numpy()))
        del table, trie
        walk = _pairs if tries == 1 else _followers
        counted = walk(texts, sent, names, length, least)
        made.append(written(counted, "longer-phrases"))
        sent.unpersist()
    whole = made[0]
    for one in made[1:]:
        whole = whole.unionByName(one)
    return whole


def _at(trie: Trie, words: list) -> np.ndarray:
    return np.fromiter((trie.words.get(w, 0) for w in words), np.int64, len(words))


def _pairs(texts: DataFrame, sent, names: DataFrame, length: int, least: int) -> DataFrame:
    """Counts of pairs of phrases of one trie that stand one word apart."""

    def reached(lang: str, words: list) -> np.ndarray:
        trie, numbers = sent.value
        where, states = trie.walk(lang, _at(trie, [w for w in words if w]), length)
        apart = np.flatnonzero(where[1:] == where[:-1] + 1)
        phrases = trie.phrases[states]
        return phrases[apart] * len(numbers) + phrases[apart + 1]

    def columns(states: np.ndarray) -> tuple:
        numbers = sent.value[1]
        return tuple(numbers[i] for i in np.divmod(states, len(numbers)))

    shards = _scan(
        texts, "first long, second long, a long", lambda: StateShard(reached, columns)
    )
    pairs = shards.groupBy("first", "second").agg(F.sum("a").alias("a"))
    pairs = written(pairs.where(F.col("a") >= least), "pairs")
    first = names.withColumnsRenamed({"number": "first", "phrase": "_first"})
    second = names.select(
        F.col("number").alias("second"), _cut(F.col("phrase"), length, 1).alias("_last")
    )
    phrase = F.concat("_first", F.lit(b" "), "_last").alias("phrase")
    return pairs.join(first, "first").join(second, "second").select("lang", phrase, "a")


def _followers(texts: DataFrame, sent, names: DataFrame, length: int, least: int) -> DataFrame:
    """Counts of the words that stand after phrases of the trie."""

    def followed(lang: str, words: list) -> Iterator[bytes]:
        trie, numbers = sent.value
        words = [w for w in words if w]
        where, states = trie.walk(lang, _at(trie, words), length)
        for number, at in zip(numbers[trie.phrases[states]].tolist(), (where + length).tolist()):
            if at < len(words) and words[at] != BREAK:
                yield b"%d %b" % (number, words[at])

    shards = _scan(
        texts, "lang string, phrase binary, a long", lambda: NameShard(followed)
    )
    found = shards.groupBy("phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    parts = F.split(F.col("phrase").cast("string"), " ")
    found = found.select(parts[0].cast("long").alias("number"), parts[1].alias("_last"), "a")
    phrase = F.concat("phrase", F.lit(b" "), F.col("_last").cast("binary")).alias("phrase")
    return found.join(names, "number").select("lang", phrase, "a")


def _cut(phrase: Column, first: Column | int, count: Column | int) -> Column:
    """``count`` words of a phrase from number ``first`` on."""
    words = F.split(phrase.cast("string"), " ")
    return F.array_join(F.slice(words, first, count), " ").cast("binary")


def frequent_phrases(
    texts: DataFrame, least: int = LEAST, most: int = TRIE_PHRASES
) -> tuple[DataFrame, DataFrame]:
    """(lang, n), and (lang, length, phrase, a) of all phrases of 1 to 5 words with a >= least."""
    words = written(word_counts(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    level = written(words.where(F.col("a") >= least), "frequent-words")
    whole = level.withColumn("length", F.lit(1))
    for length in range(1, LONGEST):
        if level.isEmpty():
            break
        level = longer_counts(texts, level, length, least, most)
        whole = whole.unionByName(level.withColumn("length", F.lit(length + 1)))
    return totals, whole


def collocations(
    df: DataFrame,
    text: str,
    lang: str,
    least: int = LEAST,
    top: int = TOP,
    most: int = TRIE_PHRASES,
) -> DataFrame:
    """The ``top`` phrases of 2 to 5 words of each lang: lang, rank, phrase, a, l, r, n, score.

    A null text is empty; a null lang is ``und``, as is a lang of that name.  Repeated rows count
    each; an empty table, or one without a frequent phrase, gives an empty result.  Other columns
    are not looked at.  Equal scores and counts stand in the byte order of their phrases.

    Words are counted first.  Then, for 1 to 4 words, a trie of the frequent phrases is broadcast
    (of at most ``most`` phrases, else several, one after the other), all positions of the texts
    walk it at once, and each task counts which phrases stand one word apart; Spark sums.  Passes
    and broadcasts are bounded by the frequent phrases, not by the candidates.
    """
    texts = df.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.col(text).cast("binary").alias("text"),
    )
    totals, whole = frequent_phrases(texts, least, most)
    counts = whole.select("lang", F.col("phrase").alias("_part"), F.col("a").alias("_count"))
    phrases = whole.where("length > 1")
    # A longer candidate that is as frequent takes the place of both its parts; what lies deeper
    # inside is then as frequent as one of these, and falls with it.
    inside = F.explode(
        F.array(_cut(F.col("phrase"), 1, F.col("length") - 1), _cut(F.col("phrase"), 2, F.col("length") - 1))
    )
    covered = (
        phrases.where("length > 2")
        .select("lang", inside.alias("_part"), "a")
        .groupBy("lang", "_part")
        .agg(F.max("a").alias("_within"))
        .withColumnRenamed("_part", "phrase")
    )
    left = phrases.join(covered, ["lang", "phrase"], "left").where(
        F.col("_within").isNull() | (100 * F.col("_within") < 100 * F.col("a"))
    )
    cuts = left.select("lang", "phrase", "length", "a", F.expr("explode(sequence(1, length - 1))").alias("k"))
    cuts = cuts.select(
        "*",
        _cut(F.col("phrase"), 1, F.col("k")).alias("_left"),
        _cut(F.col("phrase"), F.col("k") + 1, F.col("length") - F.col("k")).alias("_right"),
    )
    for side, name in (("_left", "l"), ("_right", "r")):
        part = counts.withColumnsRenamed({"_part": side, "_count": name})
        cuts = cuts.join(part, ["lang", side])
    wide = "decimal(38,0)"
    scored = cuts.join(written(totals, "totals"), "lang").withColumn(
        "score",
        F.expr(f"(cast(1000 * a as {wide}) * cast(n as {wide})) div (cast(l as {wide}) * cast(r as {wide}))"),
    )
    best = scored.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("_cut")
    )
    best = best.select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First within parts of a lang, so that no task sorts all phrases of a lang.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = best.withColumn("_part", part).withColumn(
        "_place", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = some.where(F.col("_place") <= top).withColumn("rank", place.cast("long"))
    return ranked.where(F.col("rank") <= top).select(
        "lang", "rank", F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score"
    )


SQL = rf"""
    WITH words AS (
      SELECT lang, piece, i, w FROM (
        SELECT lang, piece, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
          SELECT lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^ \t]+') AS ws FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
              coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\n\x0B\f\r]')) AS p FROM documents)))),
    grown AS (
      SELECT lang, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4,
        lead(w, 4) OVER o AS w5 FROM words WINDOW o AS (PARTITION BY piece ORDER BY i)),
    f AS MATERIALIZED (
      SELECT lang, ws, count(*) AS a FROM (
        SELECT lang, unnest([[w], [w, w2], [w, w2, w3], [w, w2, w3, w4], [w, w2, w3, w4, w5]]) AS ws
        FROM grown) WHERE ws[-1] IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
    totals AS (SELECT lang, count(*) AS n FROM words GROUP BY 1),
    c AS (SELECT * FROM f WHERE len(ws) > 1),
    parts AS (
      SELECT lang, ws[i:j] AS ws, max(a) AS within FROM (
        SELECT lang, ws, a, unnest(range(1, len(ws) + 1)) AS i FROM c),
        (SELECT unnest(range(2, {LONGEST} + 1)) AS j)
      WHERE j > i AND j <= len(ws) AND j - i + 1 < len(ws) GROUP BY ALL),
    kept AS (
      SELECT c.* FROM c LEFT JOIN parts p ON c.lang = p.lang AND c.ws = p.ws
      WHERE p.within IS NULL OR 100 * p.within < 100 * c.a),
    cuts AS (SELECT lang, ws, a, unnest(range(1, len(ws))) AS k FROM kept),
    scored AS (
      SELECT cuts.lang, array_to_string(cuts.ws, ' ') AS phrase, cuts.a, k, x.a AS l, y.a AS r, n,
        CAST((1000 * CAST(cuts.a AS HUGEINT) * n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
      FROM cuts JOIN totals USING (lang) JOIN f x ON x.lang = cuts.lang AND x.ws = cuts.ws[1:k]
      JOIN f y ON y.lang = cuts.lang AND y.ws = cuts.ws[k + 1:]),
    best AS (
      SELECT * FROM scored
      QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
      phrase, a, l, r, n, score FROM best QUALIFY rank <= {TOP}
    """


@query("op11_phrase_collocations", SQL)
def op11_phrase_collocations(spark, folder):
    """The strongest phrases of every lang of ``documents``."""
    return collocations(documents(spark, folder), "text", "lang")
