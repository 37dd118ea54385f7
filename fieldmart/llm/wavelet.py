"""Token ids in wavelet-matrix files: access, rank, select, counting and search on bit planes, which a read decompresses."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldmart.llm.common import Scratch, batch, batch_of_rows, lists, read_file, text_of, write_file
from fieldmart.llm.tokenizing import ROWS_AT_ONCE, default_tokenizer, encoder

MAGIC = b"WMX1"
BLOCK = 512  # bits between two entries of a rank directory
CHUNK = 1 << 16  # ids whose places are held at a time
SHARD_BYTES = 32 << 20  # text of one shard, near enough
NULL_ID = -(2**63)

MANIFEST = "shard int, path string, docs long, tokens long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _chunks(values: np.ndarray, ones: np.ndarray, zeros: int) -> Iterator[tuple]:
    """Chunks of both, and the places of their ones and their zeros when all zeros come first."""
    low, high = 0, zeros
    for start in range(0, len(ones), CHUNK):
        own = ones[start : start + CHUNK]
        more = int(np.count_nonzero(own))
        less = len(own) - more
        yield values[start : start + CHUNK], own, slice(low, low + less), slice(high, high + more)
        low, high = low + less, high + more


def _parted(values: np.ndarray, ones: np.ndarray, zeros: int) -> np.ndarray:
    """Values without a one first, then those with it, each in their order."""
    out = np.empty_like(values)
    for some, own, low, high in _chunks(values, ones, zeros):
        np.compress(~own, some, out=out[low])
        np.compress(own, some, out=out[high])
    return out


def _merged(values: np.ndarray, ones: np.ndarray, zeros: int) -> np.ndarray:
    """The order before `_parted`."""
    out = np.empty_like(values)
    for some, own, low, high in _chunks(out, ones, zeros):
        some[np.flatnonzero(~own)] = values[low]
        some[np.flatnonzero(own)] = values[high]
    return out


class Plane:
    """Bits with rank and select."""

    def __init__(self, packed: np.ndarray, length: int):
        self.packed, self.length = packed, length
        padded = np.zeros(-(-max(length, 1) // BLOCK) * BLOCK // 8, dtype=np.uint8)
        padded[: len(packed)] = packed
        ones = np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])
        self.padded = padded

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed, count=self.length).view(bool)

    def bit(self, i: int) -> int:
        return int(self.padded[i >> 3] >> (7 - (i & 7))) & 1

    def ones(self, i: int) -> int:
        """Ones among the first i bits."""
        block = i // BLOCK
        tail = np.unpackbits(self.padded[block * BLOCK // 8 : -(-i // 8)], count=i - block * BLOCK)
        return int(self.before[block]) + int(tail.sum())

    def place(self, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of this value."""
        before = self.before if bit else np.arange(len(self.before)) * BLOCK - self.before
        block = int(np.searchsorted(before, k, side="right")) - 1
        own = np.unpackbits(self.padded[block * BLOCK // 8 : (block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(own == bit)[k - int(before[block])])


class WaveletMatrix:
    """A sequence of ids as one bit plane for each bit of an id, the highest bit first.

    Each plane holds its bit of the ids in the order that the planes above have left: after a
    plane, ids with a 0 come first and ids with a 1 behind, each in their order.
    """

    def __init__(self, planes: list[Plane], zeros: list[int], length: int):
        self.planes, self.zeros, self.length = planes, zeros, length

    @classmethod
    def of(cls, ids: np.ndarray, bits: int = 0) -> WaveletMatrix:
        bits = bits or max(1, int(ids.max(initial=0)).bit_length())
        planes, zeros, now = [], [], ids
        for level in range(bits):
            ones = (now & ids.dtype.type(1 << (bits - 1 - level))) != 0
            planes.append(Plane(np.packbits(ones), len(ids)))
            zeros.append(len(ids) - int(np.count_nonzero(ones)))
            if level < bits - 1:
                now = _parted(now, ones, zeros[-1])
        return cls(planes, zeros, len(ids))

    def decode(self) -> np.ndarray:
        values = np.zeros(self.length, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            values[zeros:] |= values.dtype.type(1 << level)
            values = _merged(values, plane.bits(), zeros)
        return values

    def access(self, i: int) -> int:
        value = 0
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit, ones = plane.bit(i), plane.ones(i)
            value = value << 1 | bit
            i = zeros + ones if bit else i - ones
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the copies of the value among the first `end` ids lie below the last plane."""
        first = 0
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            if value >> (len(self.planes) - 1 - level) & 1:
                first, end = zeros + plane.ones(first), zeros + plane.ones(end)
            else:
                first, end = first - plane.ones(first), end - plane.ones(end)
        return first, end

    def rank(self, value: int, i: int) -> int:
        """Copies of the value among the first i ids."""
        if value >> len(self.planes):
            return 0
        first, end = self._range(value, i)
        return end - first

    def count(self, value: int) -> int:
        return self.rank(value, self.length)

    def select(self, value: int, k: int) -> int:
        """Position of the k-th copy (from 0) of the value."""
        if not 0 <= k < self.count(value):
            raise IndexError(k)
        i = self._range(value, self.length)[0] + k
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            bit = value >> level & 1
            i = plane.place(bit, i - zeros if bit else i)
        return i

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]


def to_file(doc_ids: np.ndarray, ends: np.ndarray, matrix: WaveletMatrix) -> bytes:
    """One file: a header, document ids and ends, then every plane; each part compressed by itself.

    Rank directories are not stored, as reading a plane counts them anew.
    """
    packer = zstandard.ZstdCompressor(level=3)
    parts = [doc_ids.astype("<i8").tobytes(), ends.astype("<i8").tobytes(), np.array(matrix.zeros, "<i8").tobytes()]
    parts = [packer.compress(x) for x in [*parts, *(p.packed.tobytes() for p in matrix.planes)]]
    head = MAGIC + struct.pack("<qqq", matrix.length, len(doc_ids), len(matrix.planes))
    return head + struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(parts)


def from_file(data: bytes) -> tuple[np.ndarray, np.ndarray, WaveletMatrix]:
    """Document ids, ends of the documents, and the ids of a file."""
    if data[:4] != MAGIC:
        raise ValueError("not a token file")
    length, docs, planes = struct.unpack_from("<qqq", data, 4)
    sizes = struct.unpack_from(f"<{3 + planes}q", data, 28)
    at, parts, unpacker = 28 + 8 * len(sizes), [], zstandard.ZstdDecompressor()
    for size in sizes:
        parts.append(unpacker.decompress(data[at : at + size]))
        at += size
    doc_ids, ends, zeros = (np.frombuffer(x, dtype="<i8") for x in parts[:3])
    made = [Plane(np.frombuffer(x, dtype=np.uint8), length) for x in parts[3:]]
    if at != len(data) or len(doc_ids) != docs:
        raise ValueError("a damaged token file")
    return doc_ids, ends, WaveletMatrix(made, zeros.tolist(), length)


def _written(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.uint32(end_id).astype("<u4").tobytes()
        doc_ids, lengths, ids = [], [], []
        for rows in batches:
            doc_ids.append(rows.column("doc_id").to_numpy())
            for first in range(0, rows.num_rows, ROWS_AT_ONCE):
                found = [x + end for x in encode(rows.column("text").slice(first, ROWS_AT_ONCE))]
                lengths.append(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4)
                whole = np.frombuffer(b"".join(found), dtype="<u4")
                ids.append(whole.astype(np.uint16) if whole.max(initial=0) < 2**16 else whole)
        if doc_ids:
            shard = TaskContext.get().partitionId()
            path = f"{folder}/shard-{shard:07d}.wmx"
            doc_ids, lengths, ids = np.concatenate(doc_ids), np.concatenate(lengths), np.concatenate(ids)
            matrix = WaveletMatrix.of(ids)
            write_file(path, to_file(doc_ids, np.cumsum(lengths), matrix))
            yield batch_of_rows(MANIFEST, [(shard, path, len(doc_ids), matrix.length)])

    return write


def write_tokens(
    docs: DataFrame,
    scratch: Scratch,
    folder: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    end_id: int = 0,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write all texts as ids, in ascending id order, one file per range of ids; return the files.

    The texts are sorted by range over as many shards as their bytes ask for; texts with equal ids
    may fall into two shards, so a repeated id does not gather in one. Null texts are empty, null ids come last.
    Other columns are ignored. An empty table writes no file.
    """
    source = docs.select(docs[id_column].cast(LongType()).alias("doc_id"), text_of(docs, text_column).alias("text"))
    total = source.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ranged = source.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)))
    write = _written(folder or f"{scratch.path}/tokens", tokenizer or default_tokenizer(), end_id)
    return scratch.pin(ranged.mapInArrow(write, MANIFEST), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for path, base in lists(rows, "path", "base"):
            doc_ids, ends, matrix = from_file(read_file(path))
            ids, starts = matrix.decode(), np.concatenate([[0], ends[:-1]])
            crcs = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(starts, ends, strict=True)]
            own = pa.array(doc_ids, mask=doc_ids == NULL_ID)
            yield batch(ROWS, [own, starts + base, ends - starts, crcs])


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document out of the files: doc_id, start, n_tokens, ids_crc32."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    return shards.repartition(max(1, manifest.count()), "shard").mapInArrow(_read, ROWS)
