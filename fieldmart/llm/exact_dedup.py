"""Exact de-duplication by a tree merge of sorted digest runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldmart.llm.common import Scratch, text_of, tidy

FAN_IN_BITS = 2  # four runs meet in one merge
BUCKET_ROWS = 200_000  # distinct digests a final run should hold
# One entry of a run: the digest, and two more facts about the text that verify it.
ENTRY = np.dtype([("digest", ">u8", 4), ("check", "<i8"), ("length", "<i8"), ("keep", "<i8"), ("size", "<i8")])
IDENTITY = ENTRY.names[:3]
RUN_SCHEMA = "bucket int, node int, entries binary"


def merge_runs(runs: list[np.ndarray]) -> np.ndarray:
    """One run out of sorted runs: equal texts become one entry, with the smallest id and all sizes.

    A stable sort merges runs that are sorted already. Entries are one text only where digest,
    second hash and length agree.
    """
    entries = np.concatenate(runs).astype(ENTRY, copy=False)  # concatenate() drops the byte order
    digest = entries["digest"].T[::-1]
    order = np.lexsort([entries["keep"], entries["length"], entries["check"], *digest])
    entries = entries[order]
    if not len(entries):
        return entries
    same = (entries["digest"][1:] == entries["digest"][:-1]).all(axis=1)
    for name in IDENTITY[1:]:
        same &= entries[name][1:] == entries[name][:-1]
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    merged = entries[starts]
    merged["size"] = np.add.reduceat(entries["size"], starts)
    return merged


def _to_entries(rows: pd.DataFrame) -> np.ndarray:
    entries = np.zeros(len(rows), dtype=ENTRY)
    entries["digest"] = np.frombuffer(b"".join(rows["digest"]), dtype=">u8").reshape(-1, 4)
    for name in ENTRY.names[1:]:
        entries[name] = rows[name].to_numpy(dtype="int64")
    return entries


def _leaf_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted runs of the rows of a partition, one for each bucket and batch."""
    for rows in batches:
        for (bucket, node), own in rows.groupby(["bucket", "node"]):
            run = merge_runs([_to_entries(own.assign(size=1))])
            yield pd.DataFrame({"bucket": [bucket], "node": [node], "entries": [run.tobytes()]})


def _merge_children(key: tuple, runs: pd.DataFrame) -> pd.DataFrame:
    run = merge_runs([np.frombuffer(x, dtype=ENTRY) for x in runs["entries"]])
    return pd.DataFrame({"bucket": [key[0]], "node": [key[1]], "entries": [run.tobytes()]})


def _unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        for bucket, data in zip(rows["bucket"], rows["entries"], strict=True):
            run = np.frombuffer(data, dtype=ENTRY)
            raw = run["digest"].tobytes()
            yield pd.DataFrame(
                {
                    "bucket": bucket,
                    "digest": [raw[i : i + 32] for i in range(0, len(raw), 32)],
                    **{name: run[name] for name in ENTRY.names[1:]},
                }
            )


def exact_dedup(
    docs: DataFrame,
    scratch: Scratch,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] = lambda text: text,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per document: its id, keep_id, group_size, kept, text_sha256.

    Every partition makes sorted runs of (digest, smallest id, count), one per digest range. The
    runs of a range meet in rounds, four in one: run n of a round belongs to run n // 4 of the
    next, until one is left. Equal texts become one entry at each level, so a text that holds a
    third of all rows is one entry per run from the first round on. Ranges are so many that a
    last run stays near `bucket_rows` entries. Then every first-level entry fetches its winner,
    and each document the entry of its own partition.

    keep="largest" keeps the largest id instead. A null text counts as the empty one. A null id
    never stays while its group has another; a group of null ids alone has a null keep_id and
    keeps all its rows. Repeated rows with equal ids share one fate. Other columns of any name are ignored.
    """
    text = normalise(text_of(docs, text_column))
    # In reverse order ids are kept as their complements, which no id is too large for.
    ordered, last = (F.bitwise_not, -(2**63)) if keep == "largest" else (F.col, 2**63 - 1)
    null = F.lit(2**63 - 1)  # sorts behind all ids but `last`, which looks the same
    rows = scratch.pin(
        docs.select(
            F.spark_partition_id().alias("node"),
            docs[id_column].cast(LongType()).alias("doc_id"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
            F.xxhash64(text).alias("check"),
            F.octet_length(text).cast("long").alias("length"),
        ),
        "digests",
    )
    buckets = max(1, -(-rows.count() // bucket_rows))
    leading = F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("bucket", F.floor(leading * F.lit(buckets) / F.lit(2**32)).cast("int"))
    keyed = rows.withColumn("keep", F.coalesce(ordered("doc_id"), null))

    runs = keyed.select("bucket", "node", *ENTRY.names[:4]).mapInPandas(tidy(_leaf_runs), RUN_SCHEMA)
    nodes = rows.agg(F.max("node")).first()[0] or 0
    while True:
        nodes >>= FAN_IN_BITS
        parents = runs.withColumn("node", F.shiftright("node", FAN_IN_BITS))
        runs = parents.groupBy("bucket", "node").applyInPandas(_merge_children, RUN_SCHEMA)
        if nodes == 0:
            break
    schema = "bucket int, digest binary, check long, length long, keep long, size long"
    winners = runs.mapInPandas(_unpacked, schema)
    identity = list(IDENTITY)
    ends = rows.where(F.col("doc_id") == F.lit(last)).select(*identity).distinct()
    if ends.isEmpty():
        winners = winners.withColumn("last", F.lit(None).cast("long"))
    else:
        winners = winners.join(ends.withColumn("last", F.lit(last)), identity, "left")
    leaves = keyed.select("node", "bucket", *identity).distinct()
    found = leaves.join(winners, ["bucket", *identity])
    joined = keyed.drop("keep").join(found, ["node", "bucket", *identity])
    keep_id = F.when(F.col("keep") != null, ordered("keep")).otherwise(F.col("last"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, scratch: Scratch, id_column: str = "doc_id", **how) -> DataFrame:
    """The rows of docs, all their columns, that stay: one of each text.

    Rows with equal text and equal ids, the winning one included, are told apart by nothing; one of them
    stays. Of a group without any id one row stays too.
    """
    decided = scratch.pin(exact_dedup(docs, scratch, id_column, **how), "decided")
    lost = decided.where("NOT kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest")).distinct()
    digest = F.sha2(text_of(docs, how.get("text_column", "text")).cast("binary"), 256)
    meets = docs[id_column].cast(LongType()).eqNullSafe(F.col("__id")) & (digest == F.col("__digest"))
    stay = docs.join(lost, meets, "left_anti")
    if decided.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1").isEmpty():
        return stay
    return stay.withColumn("__digest", digest).dropDuplicates([id_column, "__digest"]).drop("__digest")
