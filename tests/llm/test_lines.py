"""Line deduplication's parts that decide how its time grows."""

import random

import numpy as np
import pyarrow as pa

from tidemark.llm import lines

LETTERS = "abcdefghijklmnopqrstuvwxyz "


def drawn(pick, n):
    return "".join(pick.choices(LETTERS, k=n))


def edited(pick, text, n):
    made = list(text)
    for _ in range(n):
        made[pick.randrange(len(made))] = pick.choice(LETTERS)
    return "".join(made)


def signed(texts):
    _, sizes, lengths, odd = lines.LineSigner().signed(texts)
    column = pa.array(
        [odd[end - n : end].tobytes() for n, end in zip(lengths, np.cumsum(lengths))], pa.binary()
    )
    return sizes, lines.Parities.column(column)


def alike(texts):
    sets = lines.ShingleSets()
    return {
        (i, j)
        for j in range(len(texts))
        for i in range(j)
        if sets.alike([texts[i]], [texts[j]])[0]
    }


def pairs(blocks):
    return {tuple(pair) for block in blocks for pair in block.tolist()}


def test_parities_of_any_length_rule_out_unlike_lines_only():
    """Lines of many lengths have bins after their length; those of long lines are not full."""
    pick, texts = random.Random(1), []
    for n in (3, 20, 60, 64, 70, 250, 900, 2500, 9000):
        base = drawn(pick, n)
        texts += [edited(pick, base, n * k // 60) for k in range(4)]
    own = [drawn(pick, 2000 + 40 * i) for i in range(25)]
    sizes, odd = signed(texts + own)
    found = pairs(lines.possible_pairs(sizes, odd, np.arange(len(sizes))))
    assert alike(texts) and alike(texts) <= found
    assert not {pair for pair in found if pair[1] >= len(texts)}


def test_parts_are_looked_at_together():
    """Many parts in one call give what each gives alone: pairs of two groups and two sides."""
    pick, texts, part, group, side = random.Random(2), [], [], [], []
    for number in range(300):
        base = drawn(pick, pick.choice([30, 120]))
        for _ in range(pick.randrange(1, 9)):
            texts.append(edited(pick, base, pick.randrange(5)))
            part.append(number)
            group.append(pick.randrange(4))
            side.append(pick.choice([1, 2]) if number % 2 else 0)
    part, group, side = map(np.array, (part, group, side))
    sizes, odd = signed(texts)
    found = pairs(lines.possible_pairs(sizes, odd, group, part, None, side))
    apart = set()
    for number in range(300):
        at = np.flatnonzero(part == number)
        for i, j in alike([texts[k] for k in at]):
            a, b = at[i], at[j]
            if group[a] != group[b] and (not side[a] or side[a] != side[b]):
                apart.add((a, b))
    assert apart and apart <= found
    assert all(part[a] == part[b] and group[a] != group[b] for a, b in found)
    assert all(not side[a] or side[a] != side[b] for a, b in found)


def test_rows_come_in_whole_parts_and_bands():
    """Rows of many small parts come together, and none is cut, whatever the batches."""
    pick = random.Random(3)
    key = np.repeat(np.arange(900), [pick.randrange(1, 30) for _ in range(900)])
    names = ["run", "x", "y", "at"]
    rows = pa.table([key, key % 7, key % 3, np.arange(len(key))], names=names).combine_chunks()
    made = list(lines._parts(iter(rows.to_batches(max_chunksize=50)), 1000))
    assert 2 < len(made) < 20
    assert pa.concat_tables([pa.Table.from_batches([one]) for one, _ in made]).equals(rows)
    cuts = [one.column(0)[int(start)].as_py() for one, starts in made for start in starts]
    assert cuts == list(range(900))

    band = (key.astype(np.int64) << lines._TAIL) + np.arange(len(key))
    batches = pa.table([band, key], names=["band", "k1"]).to_batches(max_chunksize=50)
    before, lines.AT_ONCE = lines.AT_ONCE, 1000
    try:
        blocks = list(lines._whole_runs(iter(batches)))
    finally:
        lines.AT_ONCE = before
    assert (np.concatenate([one for one, _, _ in blocks]) == band).all()
    assert [ended for *_, ended in blocks] == [False] * (len(blocks) - 1) + [True]
    seen = [set((one >> lines._TAIL).tolist()) for one, _, _ in blocks]
    assert sum(map(len, seen)) == 900 and len(blocks) > 2


def test_links_join_groups_with_their_smallest_line(spark):
    """Links between lines in groups and lines in none, without the first links again."""
    node = "struct<k1: bigint, k2: bigint>"
    names = lambda rows: [tuple((k, 0) for k in row) for row in rows]
    first = spark.createDataFrame(
        names([(1, 1), (5, 1), (2, 2), (7, 2), (3, 3), (9, 3)]), f"node {node}, component {node}"
    )
    links = spark.createDataFrame(names([(7, 9), (8, 4), (5, 6), (3, 2)]), f"a {node}, b {node}")
    made = {r.node.k1: r.component.k1 for r in lines._joined_groups(first, links).collect()}
    assert made == {1: 1, 5: 1, 6: 1, 2: 2, 7: 2, 3: 2, 9: 2, 4: 4, 8: 4}
