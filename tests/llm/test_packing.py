import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from fieldmart.llm.packing import best_fit, pack, piece_lengths, sequences
from fieldmart.llm.tokenizing import Encoder, default_tokenizer


def one_by_one(lengths, capacity):
    """Plain best-fit decreasing; the number of sequences."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - length)
        else:
            gaps.append(capacity - length)
    return len(gaps)


def test_steps_equal_plain_best_fit():
    chance = random.Random(3)
    for capacity in (1, 7, 64, 100):
        for _ in range(60):
            lengths = [chance.randint(1, capacity) for _ in range(chance.randint(0, 120))]
            counts = Counter(lengths)
            moves = best_fit(counts, capacity)
            used = defaultdict(list)
            for length, rank, first, offset in moves:
                later = [r for n, r, _, _ in moves if n == length and r > rank]
                for i in range(min(later, default=counts[length]) - rank):
                    used[first + i].append((offset, length))
            assert sum(map(len, used.values())) == len(lengths)
            for spans in used.values():
                at = 0
                for offset, length in sorted(spans):
                    assert offset == at
                    at += length
                assert at <= capacity
            assert len(used) == one_by_one(lengths, capacity)


def test_pieces():
    assert piece_lengths(1, 4) == [1] and piece_lengths(4, 4) == [4] and piece_lengths(9, 4) == [1, 4, 4]


def checked(rows, placed, capacity):
    """Whole documents, gapless sequences, right checksums; returns the number of sequences."""
    tokenizer = Tokenizer.from_file(default_tokenizer())
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for _, t in rows]
    expected = Counter()
    for (doc_id, _), own in zip(rows, ids, strict=True):
        start = 0
        for piece, length in enumerate(piece_lengths(len(own), capacity)):
            crc = zlib.crc32(np.array(own[start : start + length], dtype="<u4").tobytes())
            expected[(doc_id, piece, start, length, crc)] += 1
            start += length
    got = placed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    spans = defaultdict(list)
    for r in got:
        spans[r.sequence_id].append((r.offset, r.length))
    for own in spans.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(spans) == one_by_one([n for own in ids for n in piece_lengths(len(own), capacity)], capacity)


def test_pack(documents, clash, scratch):
    chance = random.Random(5)
    words = ["the", "idiot", "éé", "x1", "\n", " ", "..."]
    rows = [(i, " ".join(chance.choices(words, k=chance.randint(0, 60)))) for i in range(150)]
    rows += [(900, None), (901, ""), (None, "a b"), (902, "same"), (902, "same"), (903, "word " * 3000)]
    rows += [(1000 + i, "a hot length") for i in range(100)]
    checked(rows, pack(documents(rows, 7), scratch, capacity=32), 32)
    checked(rows[:5], pack(clash(rows[:5], "part", "place", "length", "before"), scratch, capacity=32), 32)
    assert pack(documents([]), scratch).collect() == []
    whole = sequences(pack(documents(rows[:50]), scratch, capacity=64)).collect()
    assert all(sum(s.length for s in r.spans) == r.tokens <= 64 for r in whole)


@pytest.mark.parametrize("limit", [3, 1000])
def test_encoder_equals_the_library(limit):
    chance = random.Random(1)
    encoder = Encoder(default_tokenizer(), limit)
    parts = [*"ab1.\n\t' é　-_", " ", " ", "'s", " the", "<|endoftext|>", "\r\n", "  "]
    for _ in range(300):
        texts = ["".join(chance.choices(parts, k=chance.randint(0, 30))) for _ in range(5)]
        plain = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert encoder.encode(texts) == [np.array(x.ids, dtype="<u4").tobytes() for x in plain]


def test_added_tokens_are_the_library_s(documents, scratch):
    plain = Tokenizer.from_file(default_tokenizer())
    texts = ["one text <|endoftext|> next", "<|endoftext|>", "a<|endoftext|>b c", "d <|endoftext|>\n e", "<|endoftext| > f", "g h"]
    ids = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert 50256 in ids[0] and 50256 not in ids[4]
    for _ in range(2):
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in Encoder(default_tokenizer()).encode(texts)] == ids
    crc = {r.doc_id: (r.length, r.ids_crc32) for r in pack(documents(list(enumerate(texts))), scratch).collect()}
    ends = [np.array([*own, 2], dtype="<u4") for own in ids]
    assert crc == {i: (len(own), zlib.crc32(own.tobytes())) for i, own in enumerate(ends)}


def test_breaks_at_a_space_are_encoded_apart(monkeypatch):
    plain = Tokenizer.from_file(default_tokenizer())
    texts = ["a\n b\n\nc d", " x  y", "one two\n three", "", " "]
    encoder, asked = Encoder(default_tokenizer()), []
    ids = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda some: asked.extend(some) or ids(some))
    own = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode(texts)] == own
    assert not set(asked) & set(texts[:3])
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in encoder.encode(["", "a  b", "a b"])] == [
        plain.encode(text, add_special_tokens=False).ids for text in ["", "a  b", "a b"]
    ]


def test_remembered_pieces_take_few_bytes():
    encoder = Encoder(default_tokenizer(), 200_000)
    encoder.encode(["x"])
    tracemalloc.start()
    encoder.encode([" ".join(f"{i:x}q" for i in range(start, start + 1000)) for start in range(0, 60_000, 1000)])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(encoder.pieces) > 50_000 and held + encoder.pieces.nbytes < 8e6


def test_most_used_pieces_stay():
    encoder = Encoder(default_tokenizer(), 20)
    encoder.encode(["the often often often"])
    encoder.encode(["the often " + " ".join(f"w{i}" for i in range(30))])
    assert "often" in encoder.pieces.to_pylist() and len(encoder.pieces) == 10


def test_empty_columns():
    assert Encoder(default_tokenizer()).encode([]) == []
