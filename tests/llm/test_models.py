"""Held-out accuracy of the two classifiers, and their odd inputs."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldmart.llm import langid, toxicity

VOWELS, OTHERS = "aeiou", "bdfgklmnprst"
INSULTS = ["blockhead", "nitwit", "scoundrel", "dimwit"]


def word(chance, letters=OTHERS):
    return "".join(chance.choice(letters) + chance.choice(VOWELS) for _ in range(chance.randint(1, 3)))


@pytest.fixture(scope="module")
def prose(spark):
    chance = random.Random(8)
    rows, marks = [], []
    for i in range(900):
        toxic = int(i % 4 == 0)
        words = [word(chance) for _ in range(chance.randint(20, 90))]
        for _ in range(max(1, len(words) // 15) if toxic else 0):
            words.insert(chance.randrange(len(words)), chance.choice(INSULTS))
        rows.append((i, " ".join(words)))
        marks.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(marks, "doc_id long, toxic int"), dict(marks)


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_toxicity_on_held_out_rows(prose):
    docs, labels, truth = prose
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert all(r.held_out == is_held_out(r.doc_id) and r.predicted == int(r.score >= 0.7) for r in rows)
    rest = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in rest]) > 0.95
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}


def test_held_out_labels_are_not_learned(prose):
    docs, labels, _ = prose
    hidden = F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    one, other = toxicity.train(docs, labels), toxicity.train(docs, labels.withColumn("toxic", hidden))
    assert (one.weights == other.weights).all() and one.dictionaries == other.dictionaries


def test_toxicity_of_odd_rows(spark, prose, clash):
    docs, labels, _ = prose
    model = toxicity.train(docs, labels.union(labels))
    odd = clash([(1, None), (2, ""), (None, "nitwit"), (None, None), (3, "nitwit " * 60_000)], "held_out", "score")
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert toxicity.score(docs.limit(0), model).collect() == []
    nothing = toxicity.train(docs, labels.withColumn("toxic", F.lit(None).cast("int")))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}


def test_long_documents_leave_room_in_the_sample(spark, prose):
    docs, labels, truth = prose
    settings = toxicity.Settings(sample_bytes=1 << 20)
    # The labelled toxic row that comes first is longer than the room of all toxic rows.
    marks = labels.where("toxic = 1").where(~toxicity.held_out(F.col("doc_id")))
    first = marks.orderBy(F.xxhash64("doc_id")).first()["doc_id"]
    longer = docs.withColumn("text", F.when(F.col("doc_id") == first, F.expr("repeat(text || ' ', 3000)")).otherwise(F.col("text")))
    model = toxicity.train(longer, labels, settings)
    assert model.constant is None
    rest = [r for r in toxicity.score(docs, model).collect() if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in rest]) > 0.95


def test_thinned_texts_come_from_the_whole():
    text = " ".join(f"w{i}" for i in range(100_000))
    some = toxicity.thinned(text, 20_000, 512)
    words = [int(w[1:]) for w in some.split()]
    assert 15_000 < len(some.encode()) <= 20_000 and words == sorted(words)
    assert words[0] == 0 and words[-1] == 99_999 and max(b - a for a, b in zip(words, words[1:], strict=False)) < 4_000
    assert all(f" w{i} " in f" {text} " for i in words)
    assert toxicity.thinned("short é", 20, 512) == "short é"
    dense = toxicity.thinned("é語" * 9_000, 2_000, 100)
    assert 1_500 < len(dense.encode()) <= 2_000 and set(dense) <= set("é語 ")
    assert toxicity._share_of_each([5, 5, 100, 100], 60, 1000) == 25
    assert toxicity._share_of_each([5, 5, 10], 60, 1000) == 1000 and toxicity._share_of_each([], 60, 9) == 9


def test_texts_without_spaces_are_scored_by_content(spark):
    chance = random.Random(5)
    signs = [chr(0x4E00 + i) for i in range(1500)]
    kinds = {"cjk": ["".join(chance.choices(signs, k=chance.randint(1, 3))) for _ in range(2000)]}
    kinds["glued"] = [word(chance) for _ in range(2000)]
    bad = {"cjk": ["毒蟲毒", "混蛋東西"], "glued": INSULTS}
    rows = []
    for i in range(1600):
        kind, toxic = ("cjk", "glued")[i % 2], int(i % 8 < 2)
        words = chance.choices(kinds[kind], k=chance.randint(40, 100))
        for _ in range(len(words) // 20 if toxic else 0):
            words.insert(chance.randrange(len(words)), chance.choice(bad[kind]))
        rows.append((i, "".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    rest = [r for r in toxicity.score(docs, model).collect() if r.held_out]
    assert np.mean([r.predicted == rows[r.doc_id][2] for r in rest]) > 0.95


def test_windows_stay_below_the_last_cell():
    assert toxicity.windows("You, U\u00a0a\u3000b", 1) == [b" you, ", b" u ", b" a ", b" b "]
    run = "語" * 4 + "、" + "abc" * 9 + "…" + "กิน" * 9
    pieces = [w.decode() for w in toxicity.windows(run, 1)]
    assert pieces[0] == " 語語語語 " and "abcabcabc" in pieces and pieces[-1] == "กิน"
    noise = np.random.default_rng(1).integers(0x4E00, 0x9FFF, 4000)
    found = toxicity.windows("".join(map(chr, noise)), 1) + [b" %b " % (b"%023d" % i) for i in range(9)]
    one = toxicity.compressor(b"plain words", *toxicity.SEARCHES[0])
    assert max(len(one.compress(w + toxicity.PAD)) for w in found) < toxicity.CELLS - 1


LETTERS = {"xa": "bdfgk", "xb": "lmnpr", "xc": "stvwz"}


def languages(spark, count=600):
    chance = random.Random(2)
    rows = []
    for i in range(count):
        lang = chance.choice([*LETTERS, "xa"])
        text = " ".join(word(chance, LETTERS[lang]) for _ in range(chance.randint(3, 60)))
        rows.append((i, text, None if i % 50 == 0 else lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows


def test_language_on_held_out_rows(spark):
    docs, rows = languages(spark)
    truth = {i: lang for i, _, lang in rows}
    model = langid.train(docs)
    found = langid.identify(docs, model).collect()
    rest = [r for r in found if r.held_out and truth[r.doc_id]]
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 for r in found)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rest]) > 0.97
    assert abs(np.mean([r.score for r in rest]) - 1) < 0.1  # calibrated: as sure as it is right
    assert (model.weights == 0).mean() > 0.5


def test_language_of_odd_rows(spark, documents):
    model = langid.train(languages(spark, 200)[0])
    odd = documents([(1, None), (2, ""), (3, "12 .. ½ ²"), (4, "é"), (None, "la mi no"), (5, "ba " * 50_000)])
    odd = odd.withColumns({"score": F.lit("x"), "lang_pred": F.lit("x"), "held_out": F.lit("x")})
    found = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and found[4].lang_pred != "und"
    assert langid.identify(odd.limit(0), model).collect() == []
    empty = langid.train(odd.where("doc_id < 0"))
    assert {r.lang_pred for r in langid.identify(odd, empty).collect()} == {"und"}


def test_document_frequencies_cover_all_rows(spark):
    docs, rows = languages(spark, 200)
    settings = langid.Settings(rows_per_language=5)
    learned = [t for i, t, lang in rows if lang and not is_held_out(i)]
    counts = np.zeros(1 << settings.feature_bits)
    for text in learned:
        counts[langid.counts_of(text, settings)[0]] += 1
    assert np.allclose(langid.train(docs, settings).idf, np.log((1 + len(learned)) / (1 + counts)) + 1)
