"""The similarity join by adaptive prefixes against a plain version."""

import random
import tracemalloc
from pathlib import Path

import numpy as np
import pytest

from fieldmart.llm import prefixes
from fieldmart.llm.prefixes import WordHashes, choose, least_common, prefix_length, shingle_set, similar_documents, tokens_of

from .helpers import shuffle_files


def plain(rows, words=4, similar=85):
    import re

    sets = []
    for doc_id, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", low)
        size = min(words, len(found))
        sets.append((doc_id, {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()))
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= similar * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(top(i))) for i, (d, s) in enumerate(sets)), key=repr)


def joined(df, scratch, **how):
    found = similar_documents(df, scratch, **how)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, found.collect()), key=repr)


def edited(rng, words, share):
    return [rng.choice("abcdefgh") if rng.random() < share else w for w in words]


def family(seed, groups, copies, share, common=()):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(3, 160))]
        rows += [" ".join([*edited(rng, base, rng.random() * share), *common]) for _ in range(copies)]
    return list(enumerate(rows))


def test_equals_the_plain_version(documents, scratch):
    rows = family(1, 40, 6, 0.06)
    found = joined(documents(rows), scratch)
    assert found == plain(rows) and len({r[2] for r in found}) < len(rows) - 60


@pytest.mark.parametrize("words, similar", [(2, 60), (1, 100)])
def test_other_lengths_and_similarities(documents, scratch, words, similar):
    rows = family(words, 12, 6, 0.1)
    assert joined(documents(rows), scratch, words=words, similar=similar) == plain(rows, words, similar)


def test_exactly_at_the_threshold(documents, scratch):
    words = [f"x{i}" for i in range(120)]
    rows = [(i, " ".join(words[: 23 + i])) for i in range(60)]  # 20 shingles and more: 17 of 20 is exactly 85 per cent
    assert joined(documents(rows), scratch) == plain(rows)
    assert joined(documents(rows[::4]), scratch) == plain(rows[::4])


def test_long_lists_in_blocks(documents, scratch, monkeypatch):
    monkeypatch.setattr(prefixes, "PIVOTS", (1,))
    monkeypatch.setattr(prefixes, "SMALL_LIST", 2)
    monkeypatch.setattr(prefixes, "BLOCK", 7)
    line = tuple(f"line{i}" for i in range(60))  # short documents that share most of their words
    rows = family(5, 30, 4, 0.05, line)
    assert joined(documents(rows), scratch) == plain(rows)


def test_nulls_short_repeated_and_very_long_texts(documents, scratch):
    long = " ".join(f"v{i % 700}-{i % 31}" for i in range(40_000))
    rows = [(9, None), (8, ""), (7, " \t\n"), (6, "One two"), (5, "one\x0btwo"), (4, "one  TWO three"), (None, "one two three")]
    rows += [(3, long), (2, long + " end"), (2, long + " end"), (None, None), (11, "a b c d"), (10, "A b c d"), (12, "é É"), (13, "É é")]
    assert joined(documents(rows), scratch) == plain(rows)
    assert joined(documents([(None, "p q r s"), (None, "p q r s")]), scratch) == [(None, 1, None)] * 2


def test_empty_table_and_clashing_names(documents, clash, scratch):
    assert joined(documents([]), scratch) == []
    rows = family(3, 6, 3, 0.05)
    names = "row part digest n tokens set token place sets matches prefix root a b vertex".split()
    assert joined(clash(rows, *names), scratch) == plain(rows)


def test_texts_whose_polynomial_hashes_meet(documents, scratch):
    """Thue-Morse words are equal in every polynomial hash modulo 2 ** 64."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    one, other = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    rows = [(1, one), (2, other), (3, f"{one} x y z"), (4, f"{other} x y z")]
    assert joined(documents(rows), scratch) == [(i, 1, i) for i in (1, 2, 3, 4)]


def test_any_pair_of_similar_sets_shares_what_its_prefixes_ask_for():
    rng = np.random.default_rng(2)
    for _ in range(400):
        n = int(rng.integers(1, 90))
        common = rng.choice(1 << 62, n, replace=False)
        a, b = (np.unique(np.concatenate([common, rng.choice(1 << 62, int(rng.integers(0, 1 + n // 6)))])) for _ in range(2))
        if 100 * n < 85 * len(set(a) | set(b)):
            continue
        sizes = {int(t): int(rng.integers(2, 50)) for t in {*a, *b}}
        taken = []
        for x in (a, b):
            ranked = int(np.searchsorted(x, prefixes.RANKED))
            matches, prefix, first = choose(len(x), ranked, x, np.array([sizes[int(t)] for t in x]), np.arange(len(x)), 85)
            assert len(prefix) == prefix_length(len(x), 85, matches) and first == prefix_length(len(x), 85, 1)
            taken.append((matches, set(prefix), set(prefix[:first])))
        rests = [len(x) - prefix_length(len(x), 85, t[0]) for x, t in zip((a, b), taken, strict=True)]
        asked = least_common(len(a), len(b), 85) - max(rests)
        assert len(taken[0][1] & taken[1][1]) >= asked >= min(taken[0][0], taken[1][0])
        assert taken[0][2] & taken[1][2]


def test_longer_prefixes_where_lists_are_long():
    tokens, places = np.arange(100) * 1000, np.arange(100)
    rare = choose(100, 100, tokens, np.full(100, 2), places, 85)
    common = choose(100, 100, tokens, np.concatenate([np.full(15, 2), np.full(85, 900)]), places, 85)
    late = choose(100, 100, tokens, np.concatenate([np.full(16, 900), np.full(84, 901)]), places, 85)
    assert late[0] > 1 and common[0] == 1 and rare[0] >= 1
    assert shingle_set("A b\tc") == {(b"a", b"b", b"c")}


def test_word_hashes_are_keyed_and_remember_nothing():
    hashes = WordHashes(b"one key")
    words = [b"a", b"a\x00", b"\x00", b"\xc3\xa9", b"a"]
    found = hashes.of(words)
    assert len(set(found.tolist())) == 4 and found[0] == found[4]
    assert not set(found.tolist()) & set(WordHashes(b"other key").of(words).tolist())
    tracemalloc.start()
    for start in range(0, 60_000, 1000):
        tokens_of(" ".join(f"{i:x}q" for i in range(start, start + 1000)), 4, hashes)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 2e6


def test_tokens_and_texts_go_when_the_pairs_are_compared(documents, scratch):
    rows = [(i, f"a b c d e f g h i j k l m n o p q r s {i % 3}") for i in range(9)]
    found = similar_documents(documents(rows), scratch)
    assert not Path(scratch.path.removeprefix("file://"), "signed").exists()
    assert len(found.collect()) == 9


def test_no_shuffle_of_tokens_outlives_its_table(documents, scratch, spark, monkeypatch):
    """All tokens are shuffled to be counted and again for the join; the first is gone when the second is made."""
    rows, pin, left, there = family(7, 30, 4, 0.05), scratch.pin, {}, shuffle_files(spark)

    def watched(df, name):
        found = pin(df, name)
        left[name] = sum(shuffle_files(spark, there, 5000).values())
        return found

    monkeypatch.setattr(scratch, "pin", watched)
    assert joined(documents(rows), scratch) == plain(rows)
    assert list(left).index("held") < list(left).index("prefixes")
    assert max(left.values()) < 5000  # of counts
    assert not Path(scratch.path.removeprefix("file://"), "held").exists()
