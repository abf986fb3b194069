"""Phrases, toxicity and vector codes against brute force and on odd input."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import codes, phrases, toxic
from tidemark.llm.shared import documents

FOLDER = "/root/testdata/sf0.01"


def brute_phrases(rows, least, top):
    """The contract, word for word, in plain Python."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for end in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(end, "\n")
        for piece in text.split("\n"):
            words = piece.replace("\t", " ").split(" ")
            words = [w for w in words if w]
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {}
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    for (lang, p), a in candidates.items():
        inside = any(
            other == lang and len(q) > len(p) and b >= a
            and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (other, q), b in candidates.items()
        )
        if not inside:
            cuts = []
            for k in range(1, len(p)):
                left, right = f[lang, p[:k]], f[lang, p[k:]]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return {
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, own in found.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(own)[:top], 1)
    }


TEXTS = [
    ("en", "A b c d e f. a b c d e f\ta b, A  b c"),
    ("en", "x x x x x x x; a b c d e f! é É é É\x1cz é É"),
    (None, "a b a b a b\x0ba b"),
    ("und", "a b a b"),
    ("", "p q p q p q"),
    ("en", None),
    ("de", ""),
    ("de", " \t.,"),
]


@pytest.mark.parametrize("least, most", [(2, 1000), (3, 1000), (2, 3)])
def test_phrases_in_any_number_of_tries(spark, least, most):
    frame = spark.createDataFrame(TEXTS * 2, "lang string, text string").withColumn("a", F.lit(1))
    made = phrases.collocations(frame, "text", "lang", least, 4, most)
    assert {tuple(r) for r in made.collect()} == brute_phrases(TEXTS * 2, least, 4)
    assert made.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_chunks_are_whole_words():
    text = ("ab cd.ef gh\n" * 9).encode()
    batch = pa.RecordBatch.from_pydict({"lang": ["x"], "text": pa.array([text], pa.binary())})
    for size in (1, 5, 7, 1000):
        cut = [w for _, words in phrases.word_chunks(batch, size) for w in words if w]
        assert [w for w in cut if w != phrases.BREAK] == text.replace(b".", b" ").split()
        pairs = {p for _, ws in phrases.word_chunks(batch, size) for p in zip(ws, ws[1:])}
        assert (b"cd", b"ef") not in pairs and (b"ab", b"cd") in pairs


def test_trie_accepts_its_phrases_only():
    pick = random.Random(1)
    made = {(pick.choice("xy"), b" ".join(pick.choice([b"a", b"b", b"c", b"dd", b"e"]) for _ in range(3))) for _ in range(90)}
    made = sorted(made)
    trie = phrases.build_trie(pa.array([m[0] for m in made]), pa.array([m[1] for m in made], pa.binary()))
    words = [pick.choice([b"a", b"b", b"c", b"dd", b"e", b"other"]) for _ in range(3000)]
    at = np.array([trie.words.get(w, 0) for w in words])
    for lang in "xyz":
        where, states = trie.walk(lang, at, 3)
        got = [(i, made[n]) for i, n in zip(where.tolist(), trie.phrases[states].tolist())]
        runs = [(lang, b" ".join(words[i : i + 3])) for i in range(len(words) - 2)]
        assert got == [(i, run) for i, run in enumerate(runs) if run in set(made)]


def test_shards_count_alike_however_often_they_are_emptied(monkeypatch):
    states = np.random.default_rng(2).integers(0, 50, (20, 30))
    monkeypatch.setattr(phrases, "STATES", 40)
    shard = phrases.StateShard(lambda lang, words: words, lambda found: (found,))
    counts = Counter()
    for own in states:
        if shard.add("x", own):
            counts.update(dict(zip(*(c.tolist() for c in shard.columns()))))
    counts.update(dict(zip(*(c.tolist() for c in shard.columns()))))
    assert counts == Counter(states.ravel().tolist())


def test_toxic_documents_are_found_on_held_out_labels(spark):
    got = {r.doc_id: r for r in toxic.op12_toxicity(spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels if got[r.doc_id].held_out]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    assert len(got) == documents(spark, FOLDER).count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_held_out_labels_are_not_read(spark):
    docs = documents(spark, FOLDER)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = toxic.fold("doc_id") == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (
        {r.doc_id: r.score for r in toxic.classify(docs, "doc_id", "text", x, "doc_id", "toxic").collect()}
        for x in (labels, turned)
    )
    assert a == b


def test_label_model_joins_voters_that_agree():
    pick, counts = random.Random(3), Counter()
    for _ in range(20000):
        bad = pick.random() < 0.2
        a = "t" if pick.random() < (0.9 if bad else 0.05) else "-"
        b = a if pick.random() < 0.95 else "-"  # says what the first one says
        c = "t" if pick.random() < (0.8 if bad else 0.02) else "-"
        given = pick.choice(["tc"[not bad], "-", "-"])
        counts[a + b + c + given] += 1
    model = toxic.LabelModel(dict(counts))
    assert (0, 1) in model.cliques and (2,) in model.cliques and model.cliques[-1] == (3,)
    said = model.of()
    assert said["ttt-"] > 0.95 and said["----"] < 0.1 and said["tt-c"] < 0.2


def brute_codes(vectors, width):
    """Plain Python integers, every entry compared."""
    parts, size = codes.PARTS, width // codes.PARTS
    rows = [[int(np.floor(float(x) * 4096)) for x in v] for _, v in vectors]
    cut = [[r[p * size : (p + 1) * size] for p in range(parts)] for r in rows]
    books = [[cut[i][p] for i in range(min(16, len(cut)))] for p in range(parts)]

    def nearest(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(books[p]))

    for _ in range(codes.ROUNDS):
        new = []
        for p in range(parts):
            own = [nearest(c[p], p)[1] for c in cut]
            entries = []
            for i, entry in enumerate(books[p]):
                members = [c[p] for c, o in zip(cut, own) if o == i]
                entries.append([sum(x) // len(members) for x in zip(*members)] if members else entry)
            new.append(entries)
        books = new
    out = {}
    for (vec_id, _), c in zip(vectors, cut):
        best = [nearest(c[p], p) for p in range(parts)]
        out[vec_id] = ("".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best))
    return out


@pytest.mark.parametrize("scale", [1.0, 1e9])
def test_codes_of_any_size(spark, scale):
    pick = random.Random(5)
    vectors = [(i, [scale * pick.choice([-1, 0, 0.3, 2, pick.random()]) for _ in range(16)]) for i in range(60)]
    frame = spark.createDataFrame([(*v, v[0] % 3) for v in vectors], "v long, e array<double>, l int")
    got = codes.compress(frame, "v", "e", "l").collect()
    expected = brute_codes(vectors, 16)
    assert {r.v: r.code for r in got} == {i: c for i, (c, _) in expected.items()}
    assert {r.v: r.error for r in got} == {i: min(e, codes.LONG) for i, (_, e) in expected.items()}


def test_codes_of_odd_vectors(spark):
    rows = [(1, [1.0] * 9, 1), (2, [], 1), (None, [3e38], None), (2, [0.25, -0.25], 1)]
    frame = spark.createDataFrame(rows, "v long, e array<float>, l int")
    got = sorted(codes.compress(frame, "v", "e", "l").collect(), key=str)
    assert sorted(r.v or 0 for r in got) == [0, 1, 2, 2]
    assert all(r.error == 0 and r.label_error == 0 and len(r.code) == 16 for r in got)


def test_search_ends_early_and_keeps_ties():
    books = codes.Codebook(np.array([[5, 5], [0, 10], [10, 0], [5, 5], [100, 100]]))
    code, error = books.nearest(np.array([[5, 5], [0, 9], [60, 60], [0, 0]]))
    assert code.tolist() == [0, 1, 4, 0] and error.tolist() == [0, 1, 3200, 50]
