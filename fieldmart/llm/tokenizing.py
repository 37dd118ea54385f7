"""Token ids of texts by the tokenizers library, with frequent words encoded once per worker."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fieldmart.llm.common import kept

SLICE_BYTES = 4 << 20  # text that is encoded at a time
ROWS_AT_ONCE = 2048  # texts whose ids a task holds, but for what it returns


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _gather(ids: np.ndarray, ends: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the chosen entries one after another, and where each ends. Entry i has ids[ends[i]:ends[i + 1]]."""
    lengths = (ends[1:] - ends[:-1])[chosen]
    own = np.cumsum(lengths)
    if not len(own):
        return ids[:0], own
    return ids[np.repeat(ends[:-1][chosen] - own + lengths, lengths) + np.arange(own[-1])], own


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    The pre-tokenizer always starts a new token at a space before a character that is no white space,
    so the pieces between such spaces are encoded apart, and remembered. Texts with other spaces, and
    texts that contain an added token of the vocabulary (its single id, as the library's own encode
    gives it), go to the library whole. About `limit` pieces are kept at most, as columns; of too many
    the half that was used most stays.
    """

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(token) for token in vocabulary]  # a character stands for a byte
        self.limit = limit
        self.pieces = pa.array([], pa.string())
        self.ids, self.ends = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)
        self.apart = np.zeros(0, dtype=bool)  # can be encoded apart
        self.used = np.zeros(0, dtype=np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4") for x in found]

    def _learn(self, fresh: pa.Array) -> None:
        """Encodes new pieces as one text, whose ids are dealt out by the bytes that they stand for."""
        first = pc.utf8_slice_codeunits(fresh, 0, 1)
        apart = ~pc.or_(pc.utf8_is_space(first), pc.equal(first, "")).to_numpy(zero_copy_only=False)
        able = fresh.filter(pa.array(apart))
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(able)], able), " ")[0].as_py()
        ids = self._ids([" " + text if len(able) else ""])[0]
        cuts = np.cumsum(np.where(apart, pc.binary_length(fresh).to_numpy() + 1, 0))
        bytes_before = np.concatenate([[0], np.cumsum(self.bytes_of[ids])])
        ends = np.searchsorted(bytes_before, cuts)
        if any(token in text for token in self.added) or (bytes_before.take(ends, mode="clip") != cuts).any():
            each = self._ids([" " + piece if own else "" for piece, own in zip(fresh.to_pylist(), apart, strict=True)])
            ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
        self.pieces = pa.concat_arrays([self.pieces, fresh])
        self.ends = np.concatenate([self.ends, ends + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        self.apart = np.concatenate([self.apart, apart])
        self.used = np.concatenate([self.used, np.zeros(len(fresh), dtype=np.int64)])

    def _forget(self) -> None:
        kept = np.sort(np.argsort(-self.used, kind="stable")[: self.limit // 2])
        self.pieces, self.apart, self.used = self.pieces.take(pa.array(kept)), self.apart[kept], self.used[kept] // 2
        self.ids, ends = _gather(self.ids, self.ends, kept)
        self.ends = np.concatenate([[0], ends])

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        texts = pa.array(texts, pa.string())
        ends, out, start = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), [], 0
        while start < len(texts):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            out += self._encode_some(texts.slice(start, stop - start))
            start = stop
        return out

    def _encode_some(self, texts: pa.Array) -> list[bytes]:
        marked = np.zeros(len(texts), dtype=bool)
        for token in self.added:
            marked |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        plain = np.flatnonzero(~marked)
        whole = np.flatnonzero(marked)
        if len(plain):
            found, apart = self._encode_plain(texts.take(pa.array(plain)) if len(whole) else texts)
            for i, own, ok in zip(plain, found, apart, strict=True):
                out[i] = own if ok else None
            whole = np.concatenate([whole, plain[~apart]])
        for i, own in zip(whole, self._ids(texts.take(pa.array(whole)).to_pylist()), strict=True):
            out[i] = own.tobytes()
        return out

    def _encode_plain(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of each text by its pieces, and whether all of these can be encoded apart."""
        split = pc.split_pattern(texts, " ")
        pieces, firsts = split.flatten(), np.asarray(split.offsets) - split.offsets[0].as_py()
        heads = self._ids(pieces.take(pa.array(firsts[:-1])).to_pylist())
        own = np.ones(len(pieces), dtype=bool)
        own[firsts[:-1]] = False  # a text's first piece has no space before it
        rest = pieces.filter(pa.array(own))
        found = pc.index_in(rest, value_set=self.pieces)
        chosen = np.empty(len(pieces), dtype=np.int64)
        known = found.is_valid().to_numpy(zero_copy_only=False)
        chosen[np.flatnonzero(own)[known]] = found.drop_null().to_numpy()
        if found.null_count:
            fresh = rest.filter(found.is_null()).dictionary_encode()
            chosen[np.flatnonzero(own)[~known]] = len(self.pieces) + fresh.indices.to_numpy()
            self._learn(fresh.dictionary)
        chosen[~own] = len(self.pieces) + np.arange(len(texts))
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(x) for x in heads])])
        ids, piece_ends = _gather(np.concatenate([self.ids, *heads]), ends, chosen)
        ok = np.concatenate([self.apart, np.ones(len(texts), dtype=bool)])[chosen]
        apart = np.logical_and.reduceat(ok, firsts[:-1])
        self.used += np.bincount(chosen[own], minlength=len(self.pieces))
        if len(self.pieces) > self.limit:
            self._forget()
        data, ends = ids.tobytes(), 4 * piece_ends[firsts[1:] - 1]
        return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], apart


def encoder(path: str) -> Encoder:
    """The encoder that a worker keeps."""
    return kept(("encoder", path), lambda: Encoder(path))
