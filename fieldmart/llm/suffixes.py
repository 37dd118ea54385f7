"""Removes long repeated byte strings: names of strings at difference-cover positions, compared by sorting."""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldmart.llm.common import Scratch, batch, batch_of_rows, lists, read_file, text_of, write_file
from fieldmart.llm.minhash import _BACK, _BASE, _mix, _power

LENGTH = 400  # bytes of a repeated string
GRAM = 8  # bytes that are hashed together
PART_BYTES = 8 << 20  # text that one task holds at a time
BUCKET_NAMES = 2_000_000  # names that one task sorts
BROADCAST_ROWS = 500_000
NAME_BITS = 40  # of a sampled name that travel, besides its bucket

PARTS = "part long, ids array<long>, own array<long>, ends array<long>, bytes binary"
NAMES = "bucket int, part long, names binary, twice binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


@cache
def difference_cover(period: int) -> tuple[int, tuple[int, ...]]:
    """The largest v = p*p + p + 1 up to the period, p prime, and p + 1 numbers that differ by every number modulo v.

    These are the powers of x, in the field of p**3 elements, that lie in the plane of 1 and x.
    """
    primes = [p for p in range(2, 100) if all(p % d for d in range(2, p)) and p * p + p + 1 <= period]
    if not primes:
        return 1, (0,)
    p = primes[-1]
    v = p * p + p + 1
    for a, b, c in product(range(p), range(p), range(1, p)):
        power, found = (1, 0, 0), []
        for i in range(v):
            if power[2] == 0:
                found.append(i)
            power = (c * power[2] % p, (power[0] + b * power[2]) % p, (power[1] + a * power[2]) % p)
        if len(found) == p + 1 and len({(s - t) % v for s in found for t in found}) == v:
            return v, tuple(found)
    raise AssertionError("there is a primitive polynomial for every prime")


class Cover:
    """Sampled positions: of any two equal strings of `length` bytes, two sampled windows of
    `window` bytes lie at the same place within both."""

    def __init__(self, length: int):
        self.length = length
        self.period, self.marks = difference_cover(length // 2)
        self.window = length - self.period + 1

    def sampled(self, size: int) -> np.ndarray:
        marks = np.array(self.marks)
        at = (np.arange(0, max(size, 0), self.period)[:, None] + marks[None, :]).ravel()
        return at[at <= size - self.window]

    def before(self, at: np.ndarray, size: int) -> np.ndarray:
        """Positions whose string of `length` bytes holds one of these windows within its first period."""
        last = size - self.length
        if last < 0 or not len(at):
            return np.zeros(0, dtype=np.int64)
        edges = np.zeros(size + 2, dtype=np.int32)
        np.add.at(edges, np.maximum(at - self.period + 1, 0), 1)
        np.add.at(edges, at + 1, -1)
        return np.flatnonzero(np.cumsum(edges[: last + 1]) > 0)


def sums_of(data: np.ndarray, key: int, gram: int = GRAM) -> np.ndarray:
    """Running sums of a polynomial whose coefficients are keyed hashes of the GRAM bytes from each position on.

    With bytes themselves as coefficients, patterns that cancel modulo 2**64 can be written down.
    """
    if len(data) < gram:
        return np.zeros(1, np.uint64)
    grams = np.ascontiguousarray(sliding_window_view(data, GRAM)).view(np.uint64).ravel() if gram == GRAM else data.astype(np.uint64)
    values = _mix(grams ^ np.uint64(key))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _power(_BASE, len(values)))])


def names_of(sums: np.ndarray, at: np.ndarray, length: int, gram: int = GRAM) -> np.ndarray:
    """Names of the strings of this length at these positions: equal strings have equal names."""
    return _mix((sums[at + length - gram + 1] - sums[at]) * _power(_BACK, len(sums))[at])


def _documents(row: dict) -> Iterator[tuple[int, int, np.ndarray]]:
    """Id, whether a result is wanted, and the bytes of each document of a part."""
    data, start = np.frombuffer(row["bytes"], dtype=np.uint8), 0
    for doc_id, own, end in zip(row["ids"], row["own"], row["ends"], strict=True):
        yield doc_id, own, data[start:end]
        start = end


def _pack_parts(part_bytes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, own, ends, texts, size = TaskContext.get().partitionId() << 24, [], [], [], [], 0
        for rows in batches:
            for doc_id, wanted, text in lists(rows, "doc_id", "wanted", "text"):
                data = text.encode()
                size += len(data)
                ids.append(doc_id)
                own.append(int(wanted))
                ends.append(size)
                texts.append(data)
                if size >= part_bytes:
                    yield batch_of_rows(PARTS, [(part, ids, own, ends, b"".join(texts))])
                    part, ids, own, ends, texts, size = part + 1, [], [], [], [], 0
        if ids:
            yield batch_of_rows(PARTS, [(part, ids, own, ends, b"".join(texts))])

    return pack


def _answers(folder: str, part: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(read_file(f"{folder}/{part:012d}"), dtype=np.uint8)).view(bool)


class Level:
    """One of two passes: which strings of a part are named, and what the pass before says of them.

    `sampled` names the windows at sampled positions. `whole` names the strings of full length
    at the positions that a sampled window with a repeated name leaves open.
    """

    def __init__(self, cover: Cover, kind: str, key: int, folder: str = ""):
        self.cover, self.kind, self.key, self.folder = cover, kind, key, folder
        self.gram = GRAM if cover.window >= GRAM else 1

    def positions(self, row: dict) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """Of each document: id, wanted, bytes, positions to name, names."""
        cover = self.cover
        if self.kind == "sampled":
            for doc_id, own, data in _documents(row):
                at = cover.sampled(len(data))
                yield doc_id, own, data, at, names_of(sums_of(data, self.key, self.gram), at, cover.window, self.gram)
            return
        docs = list(Level(cover, "sampled", self.key).positions(row))
        repeated = self.repeated([names for *_, names in docs], row["part"])
        for (doc_id, own, data, at, _), again in zip(docs, repeated, strict=True):
            at = cover.before(at[again], len(data))
            yield doc_id, own, data, at, names_of(sums_of(data, self.key, self.gram), at, cover.length, self.gram) if len(at) else np.zeros(0, np.uint64)

    def repeated(self, names: list[np.ndarray], part: int) -> list[np.ndarray]:
        """For the names of each document of a part, whether they occur elsewhere, as the exchange found."""
        whole = np.concatenate([np.zeros(0, np.uint64), *names])
        if not len(whole):
            return [np.zeros(0, dtype=bool) for _ in names]
        distinct, where = np.unique(whole, return_inverse=True)
        flags = _answers(self.folder, part)[: len(distinct)][where]
        return np.split(flags, np.cumsum([len(x) for x in names])[:-1])


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    return ((names >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _send(level: Level, buckets: int):
    """The distinct names of each part, in order, cut into buckets; with a mark for those it has twice."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(rows.num_rows):
                row = {k: v[0] for k, v in rows.slice(i, 1).to_pydict().items()}
                names = np.concatenate([np.zeros(0, np.uint64), *(n for *_, n in level.positions(row))])
                if not len(names):
                    continue
                names, count = np.unique(names, return_counts=True)
                cuts = np.searchsorted(bucket_of(names, buckets), np.arange(buckets + 1))
                out = [
                    (b, row["part"], _shorten(names[s:e], level.kind), np.packbits(count[s:e] > 1).tobytes())
                    for b, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False))
                    if e > s
                ]
                yield batch_of_rows(NAMES, out)

    return send


def _shorten(names: np.ndarray, kind: str) -> bytes:
    """Sampled names only choose candidates, so the bits below the highest are dropped: they differ by bucket too."""
    if kind == "whole":
        return names.tobytes()
    low = names & np.uint64((1 << NAME_BITS) - 1)
    return low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : NAME_BITS // 8].tobytes()


def _lengthen(data: bytes, kind: str) -> np.ndarray:
    if kind == "whole":
        return np.frombuffer(data, dtype=np.uint64)
    wide = np.zeros((len(data) // (NAME_BITS // 8), 8), dtype=np.uint8)
    wide[:, : NAME_BITS // 8] = np.frombuffer(data, dtype=np.uint8).reshape(-1, NAME_BITS // 8)
    return wide.view("<u8").ravel()


def _compare(kind: str):
    """Sorts the names of a bucket and answers each part which of its names are equal to a neighbour."""

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        parts = list(lists(table.combine_chunks().to_batches()[0], "part", "names", "twice"))
        names = [_lengthen(data, kind) for _, data, _ in parts]
        twice = [np.unpackbits(np.frombuffer(t, np.uint8), count=len(n)) for (*_, t), n in zip(parts, names, strict=True)]
        whole, marked = np.concatenate(names), np.concatenate(twice).view(bool)
        order = np.argsort(whole, kind="stable")
        ranked = whole[order]
        next_to = ranked[1:] == ranked[:-1]
        equal = np.zeros(len(whole), dtype=bool)
        equal[order[1:][next_to]] = True
        equal[order[:-1][next_to]] = True
        answers = np.split(equal | marked, np.cumsum([len(n) for n in names])[:-1])
        out = [(key[0].as_py(), p, np.packbits(a).tobytes(), len(a)) for (p, *_), a in zip(parts, answers, strict=True)]
        return pa.Table.from_batches([batch_of_rows("bucket int, part long, bits binary, size long", out)])

    return compare


def _deliver(folder: str):
    """All answers for a part, in the order of its names, as one file."""

    def deliver(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(lists(table.combine_chunks().to_batches()[0], "bucket", "bits", "size"))
        flags = [np.unpackbits(np.frombuffer(bits, np.uint8), count=size) for _, bits, size in rows]
        part = key[0].as_py()
        write_file(f"{folder}/{part:012d}", np.packbits(np.concatenate(flags)).tobytes())
        return pa.Table.from_batches([batch("part long", [[part]])])

    return deliver


def _exchange(parts: DataFrame, level: Level, names: int, folder: str, bucket_names: int, scratch: Scratch) -> None:
    """Every name meets its equals: parts send distinct names by bucket, buckets are sorted, answers return as bits."""
    buckets = max(1, -(-names // bucket_names))
    sent = parts.mapInArrow(_send(level, buckets), NAMES)
    answers = sent.groupBy("bucket").applyInArrow(_compare(level.kind), "bucket int, part long, bits binary, size long")
    done = answers.groupBy("part").applyInArrow(_deliver(folder), "part long")
    scratch.pin(done, f"delivered-{level.kind}")


def _count(level: Level):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for rows in batches:
            for i in range(rows.num_rows):
                row = {k: v[0] for k, v in rows.slice(i, 1).to_pydict().items()}
                total += sum(len(at) for *_, at, _ in level.positions(row))
        yield batch("names long", [[total]])

    return count


def covered(at: np.ndarray, length: int, size: int) -> np.ndarray:
    """Edges of the maximal runs of bytes under strings that start at these positions: start, end, start ..."""
    edges = np.zeros(size + 1, dtype=np.int32)
    edges[at] += 1
    edges[at + length] -= 1
    return np.flatnonzero(np.diff(np.cumsum(edges[:size]) > 0, prepend=False, append=False))


def _cut(level: Level, folder: str):
    """The repeated strings of full length, and the documents without their bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answered = Level(level.cover, "whole", level.key, folder)
        for rows in batches:
            for i in range(rows.num_rows):
                row = {k: v[0] for k, v in rows.slice(i, 1).to_pydict().items()}
                docs = list(level.positions(row))
                names = [n for *_, n in docs]
                again = answered.repeated(names, row["part"])
                out = []
                for (doc_id, own, data, at, _), flags in zip(docs, again, strict=True):
                    if not own:
                        continue
                    edges = covered(at[flags], level.cover.length, len(data))
                    removed = int((edges[1::2] - edges[::2]).sum())
                    kept = np.split(data, edges)[::2]
                    digest = hashlib.sha256(b"".join(x.tobytes() for x in kept)).hexdigest()
                    out.append((doc_id, len(data), removed, len(edges) // 2, digest))
                yield batch_of_rows(RESULT, out)

    return cut


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def remove_repeats(
    docs: DataFrame,
    scratch: Scratch,
    length: int = LENGTH,
    part_bytes: int = PART_BYTES,
    bucket_names: int = BUCKET_NAMES,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of `length` bytes that covers it starts anywhere else too.

    Positions whose number within the document is in a difference cover modulo v are sampled: in any
    two equal strings, two sampled windows of length - v + 1 bytes have the same place among the first v.
    The first pass names the sampled windows and sorts the names; a unique name ends there, which is most of
    the text. The second does the same with whole strings, at all positions up to v - 1 bytes before a
    repeated window. Neighbours with equal names are repeats.

    Documents lie in parts of about `part_bytes`. A part sends each distinct name once, so a
    string that a third of all documents share is one row per part; buckets are as many as keep
    each near `bucket_names`; answers return as one bit per name, in a file per part. Equal texts
    are found by digest before: one of them stays as a partner of others. Names are
    64-bit hashes of the strings, under a key that each run draws (of sampled windows only 40 bits and the bucket
    travel, as they just choose candidates). Bytes are not compared: of n strings that the second pass names, n * n / 2**65
    pairs meet by chance, one in 10,000 runs over 60 million of them.

    A null text is empty. Null ids stay null, repeated rows are copies of each other, other columns
    are ignored, an empty table gives an empty result.
    """
    text = text_of(docs)
    own = docs.select(
        docs["doc_id"].cast(LongType()).alias("doc_id"),
        text.alias("text"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    long_ones = own.where(F.col("n_bytes") >= length)
    copies = long_ones.groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"))
    copies = scratch.pin(copies.where("copies > 1"), "copies")
    marked = own.join(_small(copies), "digest", "left")
    is_copy = F.col("copies").isNotNull()

    alone = F.when(is_copy, F.col("n_bytes")).otherwise(F.lit(0).cast("long"))
    plain = marked.where(is_copy | (F.col("n_bytes") < length)).select(
        "doc_id",
        "n_bytes",
        alone.alias("n_removed"),
        F.when(is_copy, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("n_spans"),
        F.when(is_copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("digest")).alias("kept_sha256"),
    )
    partner = ~is_copy | F.col("doc_id").eqNullSafe(F.col("least"))
    partners = marked.where((F.col("n_bytes") >= length) & partner).select("doc_id", (~is_copy).alias("wanted"), "text")
    parts = scratch.pin(partners.mapInArrow(_pack_parts(part_bytes), PARTS), "parts")

    cover = Cover(length)
    bytes_held = parts.agg(F.sum(F.octet_length("bytes").cast("long"))).first()[0] or 0
    folders = f"{scratch.path}/sampled", f"{scratch.path}/whole"
    key = secrets.randbits(64)  # new in each run
    sampled = Level(cover, "sampled", key)
    _exchange(parts, sampled, bytes_held * len(cover.marks) // cover.period, folders[0], bucket_names, scratch)
    whole = Level(cover, "whole", key, folders[0])
    names = parts.mapInArrow(_count(whole), "names long").agg(F.sum("names")).first()[0] or 0
    _exchange(parts, whole, names, folders[1], bucket_names, scratch)
    return plain.union(parts.mapInArrow(_cut(whole, folders[1]), RESULT))
