import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fieldmart.llm.suffixes import Cover, difference_cover, names_of, remove_repeats, sums_of

from .helpers import thue_morse


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[k : k + length] for _, d in data for k in range(len(d) - length + 1))
    out = []
    for doc_id, d in data:
        gone = np.zeros(len(d) + 1, dtype=bool)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = True
        starts = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((doc_id, len(d), len(d) - len(kept), starts, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.collect())


def corpus(seed, length):
    chance = random.Random(seed)
    letters = "abcdeéü "
    make = lambda n: "".join(chance.choices(letters, k=n))
    shared = [make(chance.randint(length // 2, 3 * length)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [make(chance.randint(0, 2 * length))]
        for _ in range(chance.choice([0, 0, 1, 2, 3])):
            passage = chance.choice(shared)
            cut = chance.randrange(len(passage))
            parts += [chance.choice([passage, passage[cut:], passage[:cut]]), make(chance.randint(0, length))]
        rows.append((i, "".join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(4)]
    rows += [(200 + i, rows[9][1][: 5 * length] + str(i) + rows[8][1]) for i in range(12)]
    return rows


@pytest.mark.parametrize("length, seed", [(400, 1), (60, 2), (13, 3)])
def test_against_brute_force(documents, scratch, length, seed):
    rows = corpus(seed, length)
    df = remove_repeats(documents(rows, 5), scratch, length, part_bytes=3000, bucket_names=500)
    assert found(df) == brute(rows, length)


def test_edges(documents, clash, scratch):
    rows = [(1, None), (2, ""), (3, "a" * 399), (4, "b" * 400), (5, "c" * 401), (6, "ab" * 300), (7, "c" * 400)]
    rows += [(8, "x" * 200 + "é" * 150), (9, "é" * 150 + "x" * 200), (None, "b" * 400), (10, "pq" * 20_000)]
    rows += [(11, "z" * 250), (11, "z" * 250), (12, "same id, long: " + "0123456789" * 60), (12, "0123456789" * 60)]
    assert found(remove_repeats(documents(rows), scratch)) == brute(rows, 400)
    few = [(1, "k" * 500), (2, "k" * 450)]
    assert found(remove_repeats(clash(few, "part", "digest", "copies", "least", "own"), scratch)) == brute(few, 400)
    assert remove_repeats(documents([]), scratch).collect() == []


@pytest.mark.parametrize("period", [1, 2, 7, 13, 57, 200, 400])
def test_every_difference_is_covered(period):
    v, marks = difference_cover(period)
    assert v <= max(period, 1) and {(a - b) % v for a in marks for b in marks} == set(range(v))


def test_equal_strings_share_a_sampled_place():
    cover = Cover(400)
    chance = random.Random(2)
    for _ in range(200):
        i, j = chance.randrange(5000), chance.randrange(5000)
        places = [set((cover.sampled(8000) - k).tolist()) for k in (i, j)]
        assert any(0 <= d < cover.period for d in places[0] & places[1])
        assert cover.window + cover.period - 1 == 400


def test_names_of_patterns_that_cancel_in_polynomials_differ():
    start, names = np.zeros(1, dtype=int), set()
    for length in (256, 2048):
        for text in thue_morse(length):
            data = np.frombuffer(text.encode(), np.uint8)
            names |= {int(names_of(sums_of(data, key), start, length)[0]) for key in (1, 2**63 + 5)}
    assert len(names) == 8
    text = np.frombuffer(b"the same string twice: the same string twice", np.uint8)
    first, again = names_of(sums_of(text, 9), np.array([0, 23]), 21)
    assert first == again
