"""Best-fit packing of documents into sequences of bounded length, in bulk-synchronous steps."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldmart.llm.common import Scratch, batch, batch_of_rows, lists, text_of, tidy
from fieldmart.llm.tokenizing import ROWS_AT_ONCE, default_tokenizer, encoder

PIECES = "part int, doc_id long, piece int, start long, length long, ids_crc32 long, place long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
RANK_BITS = 44  # ranks within one length


def piece_lengths(tokens: int, capacity: int) -> list[int]:
    """The first piece is the shorter one, so at most one piece of a document leaves a gap."""
    first = tokens % capacity
    return [first] * bool(first) + [capacity] * (tokens // capacity)


def _pieces_of(tokenizer: str, capacity: int, end_id: int):
    end = np.uint32(end_id).astype("<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(tokenizer).encode, defaultdict(int)
        for rows in batches:
            for first in range(0, rows.num_rows, ROWS_AT_ONCE):
                some, out = rows.slice(first, ROWS_AT_ONCE), []
                for (part, doc_id), ids in zip(lists(some, "part", "doc_id"), encode(some.column("text")), strict=True):
                    ids, start = ids + end, 0
                    for number, length in enumerate(piece_lengths(len(ids) // 4, capacity)):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        out.append((part, doc_id, number, start, length, crc, seen[length]))
                        seen[length] += 1
                        start += length
                yield batch_of_rows(PIECES, out)

    return cut


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Which ranks of each length go where: (length, first rank, first sequence, offset).

    Gaps are held as runs of sequences with equal gaps. In each step the largest pieces left
    look up the successor of their length among the gaps, as many as there are of either move
    at once (rank i to the i-th sequence of the run), and the run goes to its new gap. Where no
    gap is wide enough, as few new sequences open as can hold the length. Every step uses up a
    length or a run, and runs only narrow, so the steps are bounded by the capacity, whatever
    the number of documents.
    """
    runs: dict[int, deque] = defaultdict(deque)
    gaps: list[int] = []
    moves, opened = [], 0

    def put(gap: int, first: int, count: int) -> None:
        if gap and count:
            if not runs[gap]:
                insort(gaps, gap)
            runs[gap].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                fresh = -(-left // (capacity // length))
                put(capacity, opened, fresh)
                opened += fresh
                at = len(gaps) - 1
            gap = gaps[at]
            first, count = runs[gap].popleft()
            if not runs[gap]:
                gaps.pop(at)
            taken = min(left, count)
            moves.append((length, rank, first, capacity - gap))
            put(gap, first + taken, count - taken)
            put(gap - length, first, taken)
            rank, left = rank + taken, left - taken
    return moves


def _placed_by(moves):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(sorted(moves.value), dtype=np.int64).reshape(-1, 4)
        keys = (table[:, 0] << RANK_BITS) | table[:, 1]
        for rows in batches:
            length, place, before = (rows.column(n).to_numpy() for n in ("length", "place", "before"))
            rank = before + place
            row = np.searchsorted(keys, (length << RANK_BITS) | rank, side="right") - 1
            own = [rows.column(c.split()[0]) for c in PLACED.split(", ")[:-2]]
            yield batch(PLACED, [*own, table[row, 2] + rank - table[row, 1], table[row, 3]])

    return place


def pack(
    docs: DataFrame,
    scratch: Scratch,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    capacity: int = 1024,
    end_id: int = 2,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Documents are encoded where they lie and only lengths leave the tasks. A piece's rank among
    all pieces of its length is its place within its partition plus the counts of the partitions
    before, so no length is gathered in one task however frequent it is. The steps of `best_fit`
    work on the number of pieces of each length, at most `capacity` numbers; then each task
    finds the moves of its own pieces.

    A null text counts as empty and is one piece with the end id alone. Null ids stay null.
    Repeated rows are packed each. An empty table gives an empty result. Other columns are ignored.
    """
    source = docs.select(
        F.spark_partition_id().alias("part"),
        docs[id_column].cast(LongType()).alias("doc_id"),
        text_of(docs, text_column).alias("text"),
    )
    cut = tidy(_pieces_of(tokenizer or default_tokenizer(), capacity, end_id), keeps=True)
    pieces = scratch.pin(source.mapInArrow(cut, PIECES), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count("*").alias("count"))
    counts = {r["length"]: r["count"] for r in by_part.groupBy("length").agg(F.sum("count").alias("count")).collect()}
    moves = docs.sparkSession.sparkContext.broadcast(best_fit(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    return pieces.join(before, ["part", "length"]).mapInArrow(tidy(_placed_by(moves)), PLACED)


def sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence: its spans in order. A sequence has at most `capacity` of them."""
    span = F.struct("offset", "length", "doc_id", "piece", "start")
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("tokens"), F.array_sort(F.collect_list(span)).alias("spans")
    )
