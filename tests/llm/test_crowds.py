"""Near duplicates in crowds: documents that share long passages, against brute force."""

import random

import numpy as np
import pytest

from tidemark.llm import crowds, minhash


def shingle_set(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(texts):
    """Each document's component, from all pairs of shingle sets."""
    sets = {d: shingle_set(t) for d, t in texts.items()}
    ids = sorted(sets)
    at = {s: i for i, s in enumerate(set().union(*sets.values()))}
    matrix = np.zeros((len(ids), len(at)), np.float32)
    for row, d in enumerate(ids):
        matrix[row, [at[s] for s in sets[d]]] = 1
    common = matrix @ matrix.T
    sizes = matrix.sum(axis=1)
    linked = 100 * common >= 75 * (sizes[:, None] + sizes[None, :] - common)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        x, y = sorted((find(i), find(j)))
        root[y] = x
    return {d: ids[find(i)] for i, d in enumerate(ids)}


def words(pick, n):
    return [f"w{pick.randrange(10**9)}" for _ in range(n)]


def one_passage(n, planted):
    """Documents at 0.73 by a shared passage, some pairs of them at 0.76 to 0.77."""
    pick = random.Random(1)
    passage = words(pick, 304)
    texts = {}
    for d in range(0, n, 2):
        shared = words(pick, 13) if d < 2 * planted else []
        for k in (0, 1):
            texts[d + k] = " ".join(words(pick, 56 - len(shared)) + passage + shared)
    return texts


def varied_lengths(n):
    """A passage and own words of many lengths: similar by the passage alone, or not at all."""
    pick = random.Random(2)
    passage = words(pick, 204)
    return {d: " ".join(words(pick, pick.randrange(20, 110)) + passage) for d in range(n)}


def edited(n):
    """Copies of two texts with words exchanged, so that every set of frequent shingles differs."""
    pick = random.Random(3)
    bases = [words(pick, 300), words(pick, 300)]
    bases[1][:180] = bases[0][:180]
    texts = {}
    for d in range(n):
        made = list(bases[d % 2])
        for _ in range(pick.randrange(2, 16)):
            made[pick.randrange(300)] = f"x{pick.randrange(10**9)}"
        texts[d] = " ".join(made)
    return texts


def mixed_passages(n):
    """Three of five passages each, and own words."""
    pick = random.Random(4)
    passages = [words(pick, 84) for _ in range(5)]
    texts = {}
    for d in range(n):
        some = sum(pick.sample(passages, 3), [])
        texts[d] = " ".join(some + words(pick, pick.randrange(5, 90)))
    return texts


@pytest.mark.parametrize(
    "texts",
    [one_passage(1200, 120), varied_lengths(500), edited(500), mixed_passages(500)],
    ids=["passage", "lengths", "edited", "mixed"],
)
def test_crowds_lose_no_link(spark, texts):
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    made = minhash.near_groups(frame, "doc_id", "text").collect()
    assert {r.doc_id: r.component_id for r in made} == brute(texts)


def test_crowds_alone(spark, monkeypatch):
    """What the crowds' joins find without neighbours and anchors, in several blocks."""
    monkeypatch.setattr(crowds, "BLOCK_ROWS", 100)
    for texts in (one_passage(300, 40), varied_lengths(300), edited(300), mixed_passages(300)):
        frame = spark.createDataFrame(list(texts.items()), "id long, text string")
        rows = minhash.signed(frame, "id", "text", 5)
        left = rows.selectExpr("id", "n_shingles", "id as comp")
        sets = crowds.ordered_sets(left, frame, lambda: minhash.Shingles(5).of, 75)
        found = minhash.confirmed(crowds.rare_pairs(sets, 75), frame, "id", "text", 5)
        links = found.unionByName(crowds.frequent_links(sets, 75))
        grouped = {r.node: r.component for r in minhash.components(links).collect()}
        assert {d: grouped.get(d, d) for d in texts} == brute(texts)
