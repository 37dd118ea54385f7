import random
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fieldmart.llm import wavelet
from fieldmart.llm.common import read_file
from fieldmart.llm.tokenizing import default_tokenizer
from fieldmart.llm.wavelet import WaveletMatrix, from_file, read_tokens, to_file, write_tokens


@pytest.mark.parametrize("length, most", [(0, 1), (1, 1), (7, 2), (513, 5), (3000, 50_000), (1024, 300)])
def test_matrix(length, most):
    ids = np.random.default_rng(length).integers(0, most, length).astype(np.uint32)
    data = to_file(np.arange(3), np.array([0, length, length]), WaveletMatrix.of(ids))
    doc_ids, ends, matrix = from_file(data)
    assert doc_ids.tolist() == [0, 1, 2] and ends.tolist() == [0, length, length]
    assert (matrix.decode() == ids).all()
    for i in random.Random(1).sample(range(length), min(length, 60)):
        value = int(ids[i])
        assert matrix.access(i) == value
        assert matrix.rank(value, i) == int((ids[:i] == value).sum())
        assert matrix.count(value) == int((ids == value).sum())
        assert matrix.select(value, matrix.rank(value, i)) == i
    if length:
        assert matrix.occurrences(int(ids[0])) == np.flatnonzero(ids == ids[0]).tolist()
    assert matrix.count(1 << 20) == 0
    with pytest.raises(IndexError):
        matrix.select(most, length)
    if length:
        with pytest.raises(ValueError):
            from_file(data + b"x")


def expected(rows):
    tokenizer = Tokenizer.from_file(default_tokenizer())
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out, start = [], 0
    for doc_id, text in ordered:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_files(documents, clash, scratch):
    rows = [(i * 3, f"text {i} " * (i % 50)) for i in range(200)] + [(1, None), (2, ""), (4, "é　\n \n x" * 5000)]
    made = read_tokens(write_tokens(documents(rows, 5), scratch, f"{scratch.path}/a", shard_bytes=9_000))
    found = sorted((tuple(r) for r in made.collect()), key=lambda r: r[0])
    assert found == expected(rows)
    few = [(-5, "b"), (7, "a"), (None, "z")]
    manifest = write_tokens(clash(few, "shard", "path", "start"), scratch, f"{scratch.path}/b")
    assert sorted((tuple(r) for r in read_tokens(manifest).collect()), key=lambda r: r[1]) == expected(few)
    assert read_file(manifest.first().path)[:4] == b"WMX1"
    assert read_tokens(write_tokens(documents([]), scratch, f"{scratch.path}/c")).collect() == []


def test_repeated_ids_keep_all_rows(documents, scratch):
    rows = [(3, f"t{i}") for i in range(40)] + [(3, "same")] * 5
    made = read_tokens(write_tokens(documents(rows), scratch, f"{scratch.path}/d", shard_bytes=50)).collect()
    assert sorted(r.ids_crc32 for r in made) == sorted(r[3] for r in expected(rows))
    assert sorted(r.start for r in made)[0] == 0


def test_added_tokens_are_one_id(documents, scratch):
    rows = [(1, "one text <|endoftext|> next"), (2, "<|endoftext|>"), (3, "after it")]
    got = {r.doc_id: r for r in read_tokens(write_tokens(documents(rows), scratch)).collect()}
    assert sorted(tuple(r) for r in got.values()) == sorted(expected(rows))


def test_order_of_a_plane_in_chunks(monkeypatch):
    monkeypatch.setattr(wavelet, "CHUNK", 7)
    for dtype, top in ((np.uint16, 2**16), (np.uint32, 2**18)):
        ids = np.random.default_rng(2).integers(0, top, 1000).astype(dtype)
        for own in (ids, ids[:7], ids[:0], np.zeros(20, dtype)):
            matrix = WaveletMatrix.of(own)
            assert (matrix.decode() == own).all() and matrix.decode().dtype == (np.uint16 if len(matrix.planes) <= 16 else np.uint32)
            assert [matrix.access(i) for i in range(min(50, len(own)))] == own[:50].tolist()


def test_writing_holds_no_objects_for_each_word(monkeypatch, scratch):
    monkeypatch.setattr(wavelet, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    texts = [" ".join(f"{i:x}q" for i in range(start, start + 1000)) for start in range(0, 60_000, 1000)]
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": texts})
    write = wavelet._written(f"{scratch.path}/own", default_tokenizer(), 0)
    tracemalloc.start()
    found = list(write(iter([rows])))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert found[0].column("docs").to_pylist() == [60] and held < 12e6
