"""What tasks leave behind in a worker, which stages of the pipeline share."""

import subprocess
import sys
import weakref

import pytest
from pyspark.sql import functions as F

from fieldmart.llm import common, minhash
from fieldmart.llm.tokenizing import default_tokenizer, encoder
from fieldmart.llm.toxicity import Lengths, _lengths_of

from .helpers import shuffle_files

RETAINED = """
import random, re, sys
import pyarrow as pa
from fieldmart.llm import common, packing
from fieldmart.llm.tokenizing import default_tokenizer

def held():
    return sum(map(int, re.findall(r"Pss_Anon: +(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024

def batches():
    chance = random.Random(3)
    for _ in range(12):
        texts = [" ".join(f"{chance.randrange(40_000):x}q" for _ in range(300)) for _ in range(1500)]
        yield common.batch("part int, doc_id long, text string", [[0] * 1500, range(1500), texts])

cut = common.tidy(packing._pieces_of(default_tokenizer(), 1024, 2), keeps=True)
before = held()
print(sum(rows.num_rows for rows in cut(batches())), held() - before)
"""


def lengths(name):
    return _lengths_of(name, (b"some ordinary words", b"words of another kind"), 100)


def test_a_worker_keeps_one_thing():
    one = weakref.ref(encoder(default_tokenizer()))
    assert encoder(default_tokenizer()) is one() is not None
    other = weakref.ref(lengths("a"))
    assert one() is None and isinstance(other(), Lengths) and lengths("a") is other()
    lengths("b")
    assert other() is None


def test_tasks_that_keep_nothing_drop_what_others_kept():
    one = weakref.ref(lengths("c"))
    assert list(common.tidy(iter, keeps=True)([1, 2])) == [1, 2] and one() is not None
    assert list(common.tidy(iter)([1, 2])) == [1, 2] and one() is None


def test_near_dedup_starts_without_what_toxicity_kept(spark, documents, scratch):
    """Workers are few and shared: those that have kept something are those that sketch."""

    def keep(batches):
        common.kept(("lengths", "test"), lambda: "a memory of words")
        yield from batches

    def look(batches):
        for rows in batches:
            yield common.batch("n long", [[len(common._kept)] * rows.num_rows])

    rows = documents([(i, f"some words of text number {i}") for i in range(40)], 8)
    assert rows.mapInArrow(keep, rows.schema).count() == 40
    assert rows.mapInArrow(look, "n long").agg(F.max("n")).first()[0] == 1
    key = b"0" * 16
    parted = documents([(i, "a b c d e f") for i in range(400)], 64).withColumns({"part": F.lit(0), "digest": F.lit(b"")})
    assert parted.mapInArrow(common.tidy(minhash._sketches(64, 5, key)), minhash.SKETCHED).count() == 400
    minhash.near_duplicates(rows, scratch).count()
    assert rows.mapInArrow(look, "n long").agg(F.min("n")).first()[0] == 0


def test_an_encoder_s_task_returns_free_memory():
    """About 60 MB stay for the encoder itself, and some 100 where nothing is given back."""
    out = subprocess.run([sys.executable, "-c", RETAINED], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) >= 12 * 1500 and float(out[1]) < 80


def test_shuffle_files_behind_a_written_table_go(spark, scratch):
    """The test session's driver has memory enough not to collect its garbage meanwhile."""
    there = shuffle_files(spark)
    rows = spark.range(5000).groupBy((F.col("id") % 977).alias("x")).agg(F.count("*").alias("n"))
    pinned = scratch.pin(rows, "rows")
    assert not shuffle_files(spark, there)
    assert {r.n for r in pinned.where("x < 114").collect()} == {6} and pinned.count() == 977
    rows.join(pinned.select("x"), "x").count()
    assert scratch.pin(rows, "rows").count() == rows.count() == 977


def test_the_session_keeps_its_own_setting_for_shuffle_files(spark, scratch):
    name = common.SHUFFLES_GO
    before = spark.conf.get(name, None)
    scratch.pin(spark.range(3), "rows")
    assert spark.conf.get(name, None) == before
    with pytest.raises(Exception, match="divide"):
        scratch.pin(spark.range(3).select(F.expr("raise_error('cannot divide')").alias("x").cast("string")), "wrong")
    assert spark.conf.get(name, None) == before
    spark.conf.set(name, "false")
    try:
        scratch.pin(spark.range(3), "rows")
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.unset(name)
