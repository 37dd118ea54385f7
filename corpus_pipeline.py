"""The corpus pipeline: each stage works on all that the stage before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldmart.llm.common import Scratch
from fieldmart.llm.decontamination import drop_contaminated
from fieldmart.llm.exact_dedup import keep_first
from fieldmart.llm.minhash import keep_one_of_each
from fieldmart.llm.packing import pack
from fieldmart.llm.toxicity import reject_toxic, train

#: Fixed value: the columns of documents, which all stages but the last return.
COLUMNS = "doc_id text lang source n_chars".split()


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below the cut; the model learns from labelled rows of `documents`."""
    model = train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return reject_toxic(docs.select(COLUMNS), model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id; of repeated rows one."""
    return keep_first(docs.select(COLUMNS), Scratch(spark, "exact"), keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest doc_id."""
    return keep_one_of_each(docs.select(COLUMNS), Scratch(spark, "near"))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no window of words with an item of `benchmark`."""
    return drop_contaminated(docs.select(COLUMNS), _table(spark, sf_dir, "benchmark"), Scratch(spark, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows that are left, and the sequences they are packed into."""
    return pack(docs, Scratch(spark, "packing"))


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact),
    ("near dedup", near),
    ("decontamination", benchmark),
    ("packing", packing),
]

#: Compression lengths and token ids have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = scratch.pin(stage(spark, docs, sf_dir), str(number))
    return STAGES[-1][1](spark, docs, sf_dir)
