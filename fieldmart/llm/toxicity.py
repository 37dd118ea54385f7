"""Toxicity by compression distance: two zstandard dictionaries, and what each saves on short windows."""

from __future__ import annotations

import hashlib
import random
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldmart.llm.common import batch, kept, lists, text_of, tidy

PAD = b"\n" * 12  # the compressor does not look for matches in the last bytes of its input
CELLS = 48  # lengths above are counted as this one
LONGEST = 23  # bytes of a run that is one window: with its spaces, 46 at most where nothing can be saved
GRAM = 9  # bytes of the windows of longer runs, as many whole characters as they hold
SCORED = "doc_id long, held_out boolean, score double, predicted int"
ORDER = ("hash", "size", "tie")  # of the sample, the same at each reading
SAMPLED = "hash long, size long, tie long, text string"
# One search that takes a window's best single match, and one that puts small matches together.
SEARCHES = ((zstandard.STRATEGY_LAZY2, 4), (zstandard.STRATEGY_BTOPT, 3))


@dataclass(frozen=True)
class Settings:
    toxic_rows: int = 3_000  # bounds of the sample that the model is fitted on
    ordinary_rows: int = 6_000
    sample_bytes: int = 64 << 20
    document_bytes: int = 256 << 10  # of one document in the sample, at most; in slices from all over it
    slice_bytes: int = 512
    dictionary_bytes: tuple[int, int] = (112_640, 32_768)  # ordinary, toxic
    ordinary_windows: int = 80_000  # in the training of the ordinary dictionary, at most
    document_windows: int = 40  # of one ordinary document among them
    window_words: int = 1
    cut: float = 0.7  # of the score
    over: float = 5.0  # a window speaks for toxic text if it is in so many times more of the toxic documents
    remembered: int = 400_000  # windows whose lengths a worker keeps


@cache
def _between() -> re.Pattern:
    """Runs of Unicode punctuation, symbols and separators; marks of vowels belong to their word."""
    marks = [chr(c) for c in range(1 << 16) if unicodedata.category(chr(c))[0] in "PSZ"]
    return re.compile(f"[{re.escape(''.join(marks))}\u200b]+")


def _cut(run: bytes) -> list[bytes]:
    """Windows of a long run: its parts between punctuation, of longer parts all GRAM bytes, one character further each."""
    out = []
    for part in filter(None, _between().split(run.decode())):
        data = part.encode()
        if len(data) <= LONGEST:
            out.append(b" %b " % data)
            continue
        starts = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) & 0xC0 != 0x80)
        ends = np.append(starts, len(data))
        ends = ends[np.searchsorted(ends, starts + GRAM, side="right") - 1]
        out += [data[i:j] for i, j in zip(starts.tolist(), ends.tolist(), strict=True)][: int(np.argmax(ends == len(data))) + 1]
    return out


def windows(text: str, words: int) -> list[bytes]:
    """Runs of words, in lower case, with a space before and behind; longer ones in overlapping pieces.

    Words end at any Unicode white space. No window is so long that its compressed length could
    reach the last cell.
    """
    found = " ".join(text.split()).encode().lower().split()
    runs = found if words == 1 else [b" ".join(found[i : i + words]) for i in range(0, len(found), words)]
    if max(map(len, runs), default=0) <= LONGEST:
        return [b" %b " % run for run in runs]
    return [w for run in runs for w in ([b" %b " % run] if len(run) <= LONGEST else _cut(run))]


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the plain samples where they are too few to train one."""
    try:
        return zstandard.train_dictionary(size, samples, k=24, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[:size]


def compressor(dictionary: bytes, strategy: int, min_match: int) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=15, chain_log=16, search_log=6, target_length=16, strategy=strategy,
        min_match=min_match, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=data, compression_params=parameters)


class Lengths:
    """The cells of windows: for each search, the lengths under the ordinary and the toxic dictionary."""

    def __init__(self, dictionaries: tuple[bytes, bytes], remembered: int):
        self.pairs = [[compressor(d, *search) for d in dictionaries] for search in SEARCHES]
        self.remembered = remembered
        self.known: dict[bytes, int] = {}

    def cell(self, window: bytes) -> int:
        code = 0
        for pair in self.pairs:
            for one in pair:
                code = code * CELLS + min(len(one.compress(window + PAD)), CELLS - 1)
        return code

    def of(self, found: list[bytes]) -> np.ndarray:
        """Cells, one column for each search."""
        known = self.known
        if len(known) > self.remembered:
            for window in list(known)[self.remembered // 2 :]:
                del known[window]
        for window in set(found):
            if window not in known:
                known[window] = self.cell(window)
        codes = np.array([known[window] for window in found], dtype=np.int64)
        return np.stack([codes // CELLS**2, codes % CELLS**2], axis=1)


@dataclass(frozen=True)
class Model:
    """Fitted state, of bounded size: dictionaries, evidence of each cell, weights of the features."""

    settings: Settings
    dictionaries: tuple[bytes, bytes]
    evidence: np.ndarray
    weights: np.ndarray
    constant: float | None = None  # where there was nothing to learn from

    @property
    def key(self) -> str:
        return hashlib.sha256(b"".join([*self.dictionaries, self.evidence.tobytes()])).hexdigest()


def _features(cells: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    """What a document's windows say together: means, shares beyond thresholds, and the strongest."""
    if not len(cells):
        return np.zeros(10)
    own = [evidence[i, cells[:, i]] for i in range(2)]
    return np.array([x for v in own for x in (v.mean(), *(np.sqrt((v >= t).mean()) for t in (1, 2, 3)), min(v.max(), 6))])


def _logistic(features: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton steps; the last one is the constant."""
    x, w = np.c_[features, np.ones(len(features))], np.zeros(features.shape[1] + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - labels)) + 0.01 * w
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        w = w - np.linalg.solve(bend, slope)
    return w


def fit(rows: list[tuple[str, int]], toxic_share: float, settings: Settings) -> Model:
    """Dictionaries from one half of the sample; evidence, thresholds and weights from the other.

    The toxic dictionary is trained on the windows of toxic documents that are far more
    frequent there than in ordinary ones, the ordinary dictionary on windows of ordinary
    documents. The evidence of a pair of compressed lengths is the log of how much more of
    the toxic text than of the ordinary text has it.
    """
    rows = sorted(rows)
    random.Random(7).shuffle(rows)
    empty = np.zeros((2, CELLS**2))
    by_label = [[windows(text, settings.window_words) for text, toxic in rows if toxic == y] for y in (0, 1)]
    if min(map(len, by_label)) < 4:
        return Model(settings, (b"", b""), empty, np.zeros(11), constant=min(max(toxic_share, 0.0), 1.0))
    chance = random.Random(7)
    first, second = ([docs[i::2] for docs in by_label] for i in (0, 1))
    documents = [Counter(w for doc in docs for w in set(doc)) for docs in first]
    total = [len(docs) + 1 for docs in first]
    rate = lambda y, w: (documents[y][w] + 0.5) / total[y]
    telling = [w for w, n in sorted(documents[1].items()) if n > 1 and rate(1, w) >= settings.over * rate(0, w)]
    toxic = [w for w in telling for _ in range(documents[1][w])] or [w for doc in first[1] for w in doc]
    ordinary = [w for doc in first[0] for w in chance.sample(doc, min(len(doc), settings.document_windows))]
    for samples in (toxic, ordinary):
        chance.shuffle(samples)
    sizes = settings.dictionary_bytes
    dictionaries = train_dictionary(ordinary[: settings.ordinary_windows], sizes[0]), train_dictionary(toxic, sizes[1])
    lengths = Lengths(dictionaries, settings.remembered)
    cells = [[lengths.of(doc) if doc else np.zeros((0, 2), dtype=np.int64) for doc in docs] for docs in second]
    counts = np.zeros((2, 2, CELLS**2))
    for y in (0, 1):
        for own in cells[y]:
            for i in (0, 1):
                np.add.at(counts[i, y], own[:, i], 1)
    shares = (counts + 0.5) / np.maximum(counts.sum(axis=2, keepdims=True), 1)
    evidence = np.log(shares[:, 1]) - np.log(shares[:, 0])
    evidence = np.where(counts.sum(axis=1) < 5, np.minimum(evidence, 0), evidence)
    features = np.array([_features(own, evidence) for y in (0, 1) for own in cells[y]])
    labels = np.repeat([0.0, 1.0], [len(cells[0]), len(cells[1])])
    share = min(max(toxic_share, 0.01), 0.99)
    weight = np.where(labels == 1, share / len(cells[1]), (1 - share) / len(cells[0])) * len(labels)
    return Model(settings, dictionaries, evidence, _logistic(features, labels, weight))


def _lengths_of(key: str, dictionaries: tuple[bytes, bytes], remembered: int) -> Lengths:
    return kept(("lengths", key, remembered), lambda: Lengths(dictionaries, remembered))


def score_texts(model: Model, texts: list[str]) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    lengths = _lengths_of(model.key, model.dictionaries, model.settings.remembered)
    rows = []
    for text in texts:
        found = windows(text, model.settings.window_words)
        rows.append(_features(lengths.of(found), model.evidence) if found else np.zeros(10))
    x = np.c_[np.array(rows).reshape(len(rows), -1), np.ones(len(rows))]
    return 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """A third of all ids, by checksum; an absent id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _share_of_each(sizes: list[int], room: int, most: int) -> int:
    """The largest bound, up to `most`, at which texts of these sizes, longer ones cut to it, fit in the room."""
    for i, size in enumerate(sizes := sorted(sizes)):
        if size * (len(sizes) - i) > room:
            return min(most, room // (len(sizes) - i))
        room -= size
    return most


def thinned(text: str, most: int, slice_bytes: int) -> str:
    """Text of at most `most` bytes: the whole, or slices that lie evenly over it, each of whole words where it has any."""
    data = text.encode()
    if len(data) <= most:
        return text
    parts = max(1, most // (slice_bytes + 1))
    size, out = min(slice_bytes, most), []
    for i in range(parts):
        start = (len(data) - size) * i // max(1, parts - 1)
        some = data[start : start + size]
        words = some.split()
        if start and not data[start - 1 : start].isspace() and len(words) > 1:
            some = some[some.index(words[0]) + len(words[0]) :]
        if data[start + size : start + size + 1].strip() and len(some.split()) > 1:
            some = some[: some.rindex(words[-1])]
        out.append(some.decode(errors="ignore").strip())
    return " ".join(out)


def _thinned(most: int, slice_bytes: int):
    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for start in range(0, rows.num_rows, 256):
                some = rows.slice(start, 256)
                texts = [thinned(text, most, slice_bytes) for (text,) in lists(some, "text")]
                yield batch(SAMPLED, [*(some.column(name) for name in ORDER), texts])

    return thin


def train(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out.

    The sample is the rows with the smallest hashes, `toxic_rows` and `ordinary_rows` of them. It holds
    no more than `sample_bytes` of text: where the texts are longer, all rows stay in it and the longest
    ones give as many bytes each as the room allows, in slices from all over their text. The share of
    toxic rows is counted over all of them.
    """
    settings = settings or Settings()
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy(marks["doc_id"].cast(LongType()).alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    marks = marks.where(~held_out(F.col("doc_id")))
    counts = {int(r["toxic"]): r["count"] for r in marks.groupBy("toxic").count().collect()}
    own = docs.select(docs["doc_id"].cast(LongType()).alias("doc_id"), text_of(docs).alias("text"))
    rows: list[tuple[str, int]] = []
    for toxic, most in ((1, settings.toxic_rows), (0, settings.ordinary_rows)):
        chosen = marks.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id")).limit(most).select("doc_id")
        order = F.xxhash64("doc_id").alias("hash"), F.octet_length("text").cast("long").alias("size"), F.xxhash64("text").alias("tie")
        sample = own.join(F.broadcast(chosen), "doc_id").select(*order, "text")
        room = settings.sample_bytes * most // (settings.toxic_rows + settings.ordinary_rows)
        sizes = [row["size"] for row in sample.select(*ORDER).orderBy(*ORDER).limit(most).collect()]
        bound = _share_of_each(sizes, room, settings.document_bytes)
        thin = sample.mapInArrow(tidy(_thinned(bound, settings.slice_bytes)), SAMPLED)
        rows += [(r["text"], toxic) for r in thin.orderBy(*ORDER).limit(most).select("text").collect()]
    return fit(rows, counts.get(1, 0) / max(1, sum(counts.values())), settings)


def _scored(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for start in range(0, rows.num_rows, 256):
                some = rows.slice(start, 256)
                scores = score_texts(model.value, [text for (text,) in lists(some, "text")])
                predicted = (scores >= model.value.settings.cut).astype(np.int32)
                yield batch(SCORED, [some.column("doc_id"), some.column("held_out"), scores, predicted])

    return score


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Every word of every text is a window, or several if it is long. Null and empty texts have no window and get the score
    of that. Null ids stay null. Repeated rows get equal scores. Other columns are ignored. With no
    labelled rows of both kinds every score is the share of toxic rows.
    """
    source = docs.select(docs["doc_id"].cast(LongType()).alias("doc_id"), text_of(docs).alias("text"))
    source = source.withColumn("held_out", held_out(F.col("doc_id")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return source.mapInArrow(tidy(_scored(shared), keeps=True), SCORED)


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all their columns, whose text scores below the cut."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for start in range(0, rows.num_rows, 256):
                some = rows.slice(start, 256)
                scores = score_texts(shared.value, [text or "" for (text,) in lists(some, "text")])
                yield some.filter(pa.array(scores < shared.value.settings.cut))

    return docs.mapInArrow(tidy(keep, keeps=True), docs.schema)
