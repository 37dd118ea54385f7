import hashlib
import random
from collections import Counter

import pytest

from fieldmart.llm import decontamination
from fieldmart.llm.decontamination import decontaminate, drop_contaminated

from .helpers import grams, hit_words


def brute(rows, items):
    windows = {}
    for item_id, text in items:
        if item_id is not None:
            windows.setdefault(str(item_id), set()).update(grams(text)[1])
    out = []
    for doc_id, text in rows:
        words = grams(text)[0]
        own = sorted(i for i, w in windows.items() if hit_words(words, w))
        hit = set().union(*(hit_words(words, windows[i]) for i in own)) if own else set()
        digest = hashlib.sha256(",".join(own).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(own), digest, bool(hit)))
    return Counter(out)


def corpus(seed):
    chance = random.Random(seed)
    vocabulary = [*"abcdefgh", "été", "x1", "ü", "long"]
    make = lambda n: [chance.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(make(chance.choice([1, 3, 5, 7, 9, 10, 11, 25])))) for i in range(3, 15)]
    items = [(i, t) for i, t in items if len(t.split()) > 4] + [(40, None), (41, "--"), (None, "a b"), (42, items[0][1])]
    rows = []
    for i in range(60):
        parts = make(chance.randint(0, 40))
        if i % 3 == 0:
            words = (chance.choice(items)[1] or "").split()
            at = chance.randint(0, 3)
            parts += words[at : at + chance.randint(5, 30)] + make(chance.randint(0, 9))
        rows.append((i, chance.choice([" ", ", ", "-", "\n"]).join(parts).upper() if i % 2 else " ".join(parts)))
    return rows + [(70, None), (71, ""), (72, "?!"), (None, rows[0][1]), (3, rows[3][1]), (3, rows[6][1])], items


@pytest.mark.parametrize("seed, small", [(1, True), (2, False)])
def test_against_brute_force(spark, documents, scratch, monkeypatch, seed, small):
    if not small:
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    rows, items = corpus(seed)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert Counter(tuple(r) for r in decontaminate(documents(rows), bench, scratch).collect()) == brute(rows, items)
    kept = Counter((r.doc_id, r.text) for r in drop_contaminated(documents(rows), bench, scratch).collect())
    clean = [(i, t) for i, t in rows if not any(hit_words(grams(t)[0], set(grams(x)[1])) for k, x in items if k is not None)]
    assert kept == Counter(clean)


def test_empty_tables_and_clashing_columns(spark, documents, clash, scratch):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    none = bench.where("item_id > 5")
    rows = [(1, "x one two three four five six seven eight nine ten"), (2, "very " * 60_000)]
    assert decontaminate(documents([]), bench, scratch).collect() == []
    assert Counter(tuple(r) for r in decontaminate(documents(rows), none, scratch).collect()) == brute(rows, [])
    df = clash(rows, "words", "print", "mark", "gram", "start", "prints")
    assert Counter(tuple(r) for r in decontaminate(df, bench, scratch).collect()) == brute(rows, [(1, bench.first().text)])
