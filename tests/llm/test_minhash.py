import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fieldmart.llm import minhash
from fieldmart.llm.components import connected
from fieldmart.llm.minhash import estimate, keep_one_of_each, near_duplicates, shingles

from .helpers import thue_morse


def shingle_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None), doc_id == min(ids, default=None)))
    return Counter(out)


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def corpus(seed, groups=12, copies=9, words=90):
    """Groups of near copies at all distances, with a passage that all groups share."""
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = chance.choices(vocabulary, k=20)
    rows = []
    for _ in range(groups):
        base = chance.choices(vocabulary, k=chance.randint(6, words)) + passage
        for _ in range(copies):
            text = list(base)
            for _ in range(chance.choice([0, 0, 1, 1, 2, 3, 5])):
                text[chance.randrange(len(text))] = chance.choice(vocabulary)
            if chance.random() < 0.3:
                text = text[chance.randrange(4) :]
            separator = chance.choice([" ", "\n", "  "])
            rows.append((len(rows) * 3 % 1009, separator.join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(documents, scratch, seed):
    rows = corpus(seed)
    assert found(near_duplicates(documents(rows, 5), scratch)) == brute(rows)


def test_long_lists_and_chains(documents, scratch, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL_LIST", 2)
    monkeypatch.setattr(minhash, "PIVOTS", (1,))
    monkeypatch.setattr(minhash, "BLOCK", 7)
    base = [f"b{i}" for i in range(60)]
    # Each text is similar to the next one only: the ends of the chain are far apart.
    rows = [(900 - i, " ".join(base[i * 3 :] + [f"c{j}" for j in range(i * 3)])) for i in range(20)]
    rows += [(i, " ".join(base[:50] + [f"x{i}", f"y{i}"])) for i in range(30)]
    assert found(near_duplicates(documents(rows, 4), scratch)) == brute(rows)


def test_long_lists_of_whole_sets_lose_no_link(documents, scratch, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL_LIST", 1)
    monkeypatch.setattr(minhash, "PIVOTS", ())
    rows = []
    # 220 of 292 shingles in common, of which the 256 smallest hold less than 73 in 100.
    for seed in (43, 177, 604, 726, 1378, 1399):
        words = [f"a{seed}x{i}" for i in range(260)]
        rows += [(seed, " ".join(words)), (seed + 1, " ".join([*words[:224], *(f"b{seed}x{i}" for i in range(36))]))]
    # Sets of 240 shingles at 75 in 100 exactly: 180 in common, 60 on one side only.
    words = [f"c{i}" for i in range(244)]
    rows += [(5000, " ".join(words)), (5001, " ".join(words[:184]))]
    assert found(near_duplicates(documents(rows), scratch)) == brute(rows)


@pytest.mark.parametrize("similar, size", [(50, 64), (75, 16)])
def test_share_follows_similarity_and_sketch(documents, scratch, similar, size):
    assert minhash.least_share(64, 75) == 0.47
    rows, common = [], {50: 70, 75: 88}[similar]
    for i in range(120):  # pairs of 100 shingles each, just similar
        words = [f"a{i}x{j}" for j in range(104)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[: common + 4], *(f"b{i}x{j}" for j in range(100 - common))]))]
    sets = [shingle_set(text) for _, text in rows[:2]]
    assert similar <= 100 * len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < similar + 6
    got = near_duplicates(documents(rows), scratch, similar=similar, sketch_size=size)
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: i - i % 2 for i, _ in rows}


def test_edges(documents, clash, scratch):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (None, "a b"), (None, "alone here")]
    rows += [(7, "É x y z q r"), (8, "é x y z q r"), (9, "same text " * 50_000), (10, "same text " * 50_000), (11, "x")]
    rows += [(12, "x"), (12, "x"), (12, "another text entirely under one id")]
    expected = brute(rows)
    del expected[(12, 1, 11, False)]
    assert found(near_duplicates(documents(rows), scratch)) - expected == Counter({(12, 1, 11, False): 2})
    few = [(5, "a b c d e f"), (4, "a b c d e f")]
    assert found(near_duplicates(clash(few, "part", "set", "n", "root", "value"), scratch)) == brute(few)
    assert near_duplicates(documents([]), scratch).collect() == []


def test_one_row_of_each_stays(documents, scratch):
    base = [f"b{i}" for i in range(60)]
    copy, other = " ".join(base), " ".join([*base[:58], "x", "y"])
    apart = [f"text {i} of its own with words {i * 7}" for i in range(3)]
    rows = [(1, copy), (None, other), (None, apart[0]), (None, apart[1])]  # a null id goes with its text only
    alone = [f"c{i}" for i in range(60)]
    rows += [(5, " ".join(alone)), (9, " ".join(alone[:59])), (9, apart[2])]  # so does a repeated id
    nulls = [f"d{i}" for i in range(60)]
    rows += [(None, " ".join(nulls)), (None, " ".join(nulls[:59])), (None, " ".join(nulls[:59]))]  # one of them stays
    several = [f"e{i}" for i in range(60)]
    rows += [(20, " ".join(several)), (20, " ".join(several[:59])), (20, " \n".join(several)), (21, " ".join(several[:58]))]
    rows += [(30, "the same row"), (30, "the same row"), (31, " "), (31, " "), (None, None), (None, "")]
    whole = documents(rows)
    kept = keep_one_of_each(whole, scratch)
    assert kept.columns == whole.columns
    kept = Counter((r.doc_id, r.text) for r in kept.collect())
    groups = [[r for r in rows if r[1] and r[1].split()[:1] == [first]] for first in ("d0", "e0")]
    fixed = [(1, copy), (None, apart[0]), (None, apart[1]), (5, " ".join(alone)), (9, apart[2]), (30, "the same row")]
    assert all(kept[row] == 1 for row in fixed) and kept[(31, " ")] == 2 and kept[(None, None)] == kept[(None, "")] == 1
    for group in groups:
        assert sum(kept[row] for row in set(group)) == 1
    assert sum(kept.values()) == len(fixed) + 4 + len(groups) and kept[(21, " ".join(several[:58]))] == 0


def test_texts_whose_polynomial_hashes_meet(documents, scratch):
    one, other = thue_morse(4096)
    rows = [(1, one), (2, other), (3, f"{one} b c d e f"), (4, f"{other} b c d e f"), (5, f"{one} b c d e f")]
    found = near_duplicates(documents(rows), scratch)
    assert sorted((r.doc_id, r.component_id) for r in found.collect()) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 3)]


def test_shingles_and_estimate():
    for text in ("", "a", "a b c d e f g a b c d e", "ü " * 9, "x\ty\nz\rp\x0bq\x0cr", "a\x1cb   c"):
        assert len(shingles(text)) == len(shingle_set(text))
    chance = np.random.default_rng(1)
    a = np.unique(chance.integers(0, 2**62, 3000))
    b = np.unique(np.concatenate([a[chance.random(len(a)) < 0.85], chance.integers(0, 2**62, 300)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(estimate(a[:512], b[:512], 512) - true) < 0.08
    assert estimate(a[:5], a[:5], 64) == 1 and estimate(a[:5], a[5:9], 64) == 0


def test_components(spark, scratch):
    chance = random.Random(4)
    edges = [(chance.randrange(300), chance.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)]
    roots = {r.vertex: r.root for r in connected(spark.createDataFrame(edges, "a long, b long"), scratch, "c").collect()}
    label = {v: v for e in edges for v in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert roots == {v: r for v, r in label.items() if v in roots}
    assert {v for a, b in edges if a != b for v in (a, b)} == set(roots)


def test_texts_are_taken_from_a_batch_in_slices():
    key, size = b"k" * 16, 3 * minhash.ROWS_AT_ONCE
    texts = ["words of one text"] * size
    name = minhash._name(minhash.shingles(texts[0], 5, minhash.WordHashes(key)), key)
    names = [name if i % 2 else b"x" * 16 for i in range(size)]
    rows = pa.RecordBatch.from_pydict({"set": list(range(size)), "name": names, "text": texts})
    found = list(minhash._of_sets(5, key)(iter([rows])))
    assert [x.num_rows for x in found] == [minhash.ROWS_AT_ONCE // 2] * 3
    assert [s for x in found for s in x.column("set").to_pylist()] == list(range(1, size, 2))
    wide = list(minhash._wide_sketches(5, key)(iter([rows])))
    assert len(wide) == 3 and sum(x.num_rows for x in wide) == size
