"""Hard negatives of embeddings, by threshold joins with suffix-norm bounds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.llm.common import Scratch, batch, batch_of_rows, lists

SCALE = 256
ANCHORS_IN_BLOCK = 256
NUMBERS_IN_BLOCK = 1 << 18  # components of the rows of one block
GROUP = 8  # dimensions that share a posting list
EXACT = 2.0**52  # products of norms below this are exact in floating point

BLOCK = "base long, size int, keys binary, ids binary, labels binary, vectors binary"
FOUND = "anchor long, place int, id long, score long"
LEAST, MOST = -(2**63), 2**63 - 1


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Whole numbers: each component times the scale, rounded down."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(vector: Column) -> Column:
    """Whether a vector is there and has finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def _energies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of squares per dimension, and the largest squared norm, of a partition's vectors."""
    total, largest = np.zeros(0), 0.0
    for rows in batches:
        for (vector,) in lists(rows, "vector"):
            squares = np.array(vector, dtype=np.float64) ** 2
            if len(squares) > len(total):
                total = np.pad(total, (0, len(squares) - len(total)))
            total[: len(squares)] += squares
            largest = max(largest, float(squares.sum()))
    out = [(i, float(x), largest) for i, x in enumerate(total)]
    yield batch_of_rows("dimension int, energy double, largest double", out)


def _arranged(order: np.ndarray):
    def arrange(vector: list[int]) -> np.ndarray:
        """A vector in the order of dimensions, zeros in place of what it lacks."""
        whole = np.zeros(len(order), dtype=np.int64)
        whole[: len(vector)] = vector
        return whole[order]

    return arrange


def _blocks(order: np.ndarray):
    """Packs the rows of a partition into blocks of vectors; `base` names a block by its first row."""
    arrange, size = _arranged(order), max(16, NUMBERS_IN_BLOCK // max(1, len(order)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for start in range(0, rows.num_rows, size):
                some = rows.slice(start, size)
                keys, ids, labels = (np.array(some.column(c)) for c in ("key", "vec_id", "label"))
                vectors = np.array([arrange(v) for (v,) in lists(some, "vector")], dtype=np.int64)
                columns = [x.astype(np.int64).tobytes() for x in (keys, ids, labels, vectors)]
                yield batch(BLOCK, [[int(keys[0])], [len(ids)], *[[c] for c in columns]])

    return pack


def _as_bytes(order: np.ndarray):
    arrange = _arranged(order)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            vectors = [arrange(v) for (v,) in lists(rows, "vector")]
            norms = [float(np.sqrt((v.astype(np.float64) ** 2).sum())) for v in vectors]
            columns = [rows.column("key"), rows.column("vec_id"), rows.column("label")]
            columns += [[v.tobytes() for v in vectors], norms]
            yield batch("key long, vec_id long, label long, vector binary, norm double", columns)

    return convert


def _suffix_norms(vectors: np.ndarray, starts: list[int]) -> np.ndarray:
    """Norm of what is left of each vector from each start on; zero behind the last, a bit too long else."""
    squares = vectors.astype(np.float64) ** 2
    behind = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    norms = np.sqrt(behind[:, starts]) if starts else np.zeros((len(vectors), 0))
    return np.hstack([norms * (1 + 1e-9), np.zeros((len(vectors), 1))])


def at_least(rows: np.ndarray, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, score) of all pairs whose inner product is at least the anchor's threshold.

    Posting lists, one per group of dimensions, omit a row from the group on where the norm of its rest
    times the largest rest of an anchor is below every threshold. Partial scores are accumulated group by
    group, and a pair goes as soon as the rests of both cannot lift it to the threshold. What the lists
    omit is added last, for pairs still there.
    """
    width = rows.shape[1]
    starts = list(range(0, width, GROUP))
    left_r, left_a = _suffix_norms(rows, starts), _suffix_norms(anchors, starts)
    longest = (left_r[:, 0].max() if len(rows) else 0.0) * (left_a[:, 0].max() if len(anchors) else 0.0)
    kind = np.float64 if longest < EXACT else object
    rows, anchors = rows.astype(kind), anchors.astype(kind)
    slack = longest * 1e-12  # rounding of the norms' product

    needed = left_r[:, :-1] * left_a[:, :-1].max(axis=0) >= float(least.min()) - slack
    listed = np.argmin(np.hstack([needed, np.zeros((len(rows), 1), dtype=bool)]), axis=1)  # groups with the row
    by_length = np.argsort(-listed, kind="stable")
    rows, left_r, listed = rows[by_length], left_r[by_length], listed[by_length]
    limits = least.astype(np.float64) - slack
    scores, group, open_pairs = np.zeros((len(rows), len(anchors)), dtype=kind), 0, None
    every = np.arange(len(rows))
    for group, start in enumerate(starts):
        held = int(np.searchsorted(-listed, -group, side="left"))  # rows of the list: those of more than `group` groups
        scores[:held] += rows[:held, start : start + GROUP] @ anchors[:, start : start + GROUP].T
        if group % 2 or group == len(starts) - 1:
            rest = np.minimum(group + 1, listed)
            open_pairs = scores + left_r[every, rest][:, None] * left_a[:, rest].T >= limits
            if open_pairs.sum() * 8 < open_pairs.size:
                break
    if open_pairs is None:  # vectors without components
        open_pairs = scores >= limits
    at, anchor = np.nonzero(open_pairs)
    found, begin = scores[at, anchor], np.minimum(group + 1, listed[at])
    for later in range(int(begin.min()) if len(at) else len(starts), len(starts)):
        span = slice(starts[later], starts[later] + GROUP)
        due = np.flatnonzero(begin <= later)
        found[due] += (rows[at[due], span] * anchors[anchor[due], span]).sum(axis=1)
        rest = np.minimum(np.maximum(begin, later + 1), len(starts))
        open_ = found + left_r[at, rest] * left_a[anchor, rest] >= limits[anchor]
        at, anchor, found, begin = at[open_], anchor[open_], found[open_], begin[open_]
    enough = found >= least.astype(kind)[anchor]
    return by_length[at[enough]], anchor[enough], found[enough]


def _searched(width: int, first: int, same_label: bool):
    """For each window of each anchor, the first rows of a block by score, of those in the window."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch_ in batches:
            for size, *packed, vectors, anchors in lists(batch_, "size", "keys", "ids", "labels", "vectors", "anchors"):
                keys, ids, labels = (np.frombuffer(x, np.int64) for x in packed)
                rows = np.frombuffer(vectors, np.int64).reshape(size, width)
                asked = np.array([np.frombuffer(a["vector"], np.int64) for a in anchors]).reshape(len(anchors), width)
                own_key, own_label = (np.array([a[c] for a in anchors], dtype=np.int64) for c in ("key", "label"))
                least = np.array([min(w["least"] for w in a["windows"]) for a in anchors], dtype=object)
                at, anchor, score = at_least(rows, asked, least)
                fits = (labels[at] == own_label[anchor]) == same_label
                fits &= keys[at] != own_key[anchor]
                at, anchor = at[fits], anchor[fits]
                score = np.array([min(max(int(x), LEAST), MOST) for x in score[fits]], dtype=np.int64)
                order = np.lexsort((ids[at], -score, anchor))
                at, anchor, score = at[order], anchor[order], score[order]
                edges = np.searchsorted(anchor, np.arange(len(anchors) + 1))
                out = []
                for i, one in enumerate(anchors):
                    mine = slice(edges[i], edges[i + 1])
                    for window in one["windows"] if edges[i] < edges[i + 1] else ():
                        inside = (score[mine] <= window["high"]) & (score[mine] >= window["least"])
                        for j in np.flatnonzero(inside)[:first]:
                            out.append((one["key"], window["place"], int(ids[at[mine][j]]), int(score[mine][j])))
                yield batch_of_rows(FOUND, out)

    return search


def _fill(
    windows: DataFrame,
    anchors: DataFrame,
    blocks: DataFrame,
    steps: list[Callable[[], Column]],
    width: int,
    first: int,
    same_label: bool,
    scratch: Scratch,
    name: str,
) -> DataFrame:
    """(anchor, place, rank, id, score): the first rows of each window (key, place, high, low).

    `steps` are falling thresholds. All rows that reach a window's threshold are looked at, so a window
    that gets full is done; the others go on with the next step, the last of which is their lower end.
    """
    done, turn = None, 0
    for turn, step in enumerate(steps):
        asked = windows.join(anchors.select("key", "norm"), "key").withColumn("least", step())
        asked = asked.groupBy("key").agg(F.collect_list(F.struct("place", "high", "least")).alias("windows"))
        number = asked.count()
        if not number:
            break
        count = F.lit(-(-number // ANCHORS_IN_BLOCK)).cast("long")
        one = F.struct("key", "label", "vector", "windows")
        packed = anchors.join(asked, "key").withColumn("queries", F.pmod(F.xxhash64("key"), count))
        packed = packed.groupBy("queries").agg(F.collect_list(one).alias("anchors"))
        packed = scratch.pin(packed, f"{name}-anchors-{turn}")
        grid = blocks.select("base", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("queries"))
        pairs = grid.join(packed, "queries").join(blocks, "base")
        found = pairs.mapInArrow(_searched(width, first, same_label), FOUND)
        by_rank = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), F.col("id"))
        ranked = found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= first)
        ranked = scratch.pin(ranked, f"{name}-found-{turn}")
        if turn < len(steps) - 1:
            full = ranked.where(F.col("rank") == first).select(F.col("anchor").alias("key"), "place")
            windows = scratch.pin(windows.join(full, ["key", "place"], "left_anti"), f"{name}-open-{turn}")
            ranked = ranked.join(full.withColumnRenamed("key", "anchor"), ["anchor", "place"], "left_semi")
        done = ranked if done is None else done.unionByName(ranked)
    return done


def hard_negatives(
    embeddings: DataFrame,
    scratch: Scratch,
    is_anchor: Column | None = None,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    The positives of an anchor are the rows of its label with the highest scores; a positive's negatives
    are the first rows of other labels whose score is between the window's per cents of the positive's.
    Ties go to the smaller vec_id. Scores are exact inner products of the quantised vectors.

    Anchors, in blocks, meet the rows, in blocks, in a few rounds with falling thresholds: an anchor leaves
    as soon as its windows are full. A task holds one block of each; it returns at most the first rows of
    each window, so a vector with very many copies costs no more than another.

    Rows without id, label or vector, or with a component that is null or not finite, take no part.
    Each of several rows with one id, equal or not, counts as a row of its own, an anchor too. A short vector
    is filled up with zeros. Components beyond 64 bits become the nearest such number, and so do scores.
    An empty table, or one without anchors, gives an empty result. Other columns are ignored.
    """
    own = embeddings.select(
        embeddings["vec_id"].cast("long").alias("vec_id"),
        (embeddings["label"] if label is None else label).cast("long").alias("label"),
        F.when(usable(embeddings["embedding"]), quantised(embeddings["embedding"], scale)).alias("vector"),
        (embeddings["vec_id"] % 100 == 0 if is_anchor is None else is_anchor).alias("asked"),
    )
    own = scratch.pin(own.dropna(subset=["vec_id", "label", "vector"]), "rows")
    rows = scratch.pin(own.withColumn("key", F.monotonically_increasing_id()), "keyed")
    energies = rows.select("vector").mapInArrow(_energies, "dimension int, energy double, largest double")
    energies = energies.groupBy("dimension").agg(F.sum("energy").alias("energy"), F.max("largest").alias("largest"))
    known = energies.orderBy(F.desc("energy"), "dimension").collect()  # as many as a vector has components
    order, longest = np.array([r["dimension"] for r in known], dtype=np.int64), max([0.0, *[r["largest"] for r in known]])
    blocks = scratch.pin(rows.mapInArrow(_blocks(order), BLOCK), "blocks")
    anchors = rows.where("asked").mapInArrow(
        _as_bytes(order), "key long, vec_id long, label long, vector binary, norm double"
    )
    anchors = scratch.pin(anchors, "anchors")

    bound = F.col("norm") * F.lit(longest**0.5)
    falling = [lambda f=f: F.floor(bound * F.lit(f)).cast("long") for f in (0.5, 0.25, 0.125)]
    ends = F.lit(0).alias("place"), F.lit(MOST).alias("high"), F.lit(LEAST).alias("low")
    nearest = _fill(
        anchors.select("key", *ends), anchors, blocks, [*falling, lambda: F.col("low")], len(order), positives, True, scratch, "pos"
    )
    if nearest is None:
        ids = "anchor_id long, positive_id long, rank int, negative_id long"
        return rows.sparkSession.createDataFrame([], ids + ", positive_score long, negative_score long")
    nearest = nearest.select(
        F.col("anchor").alias("key"), F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    low, high = (F.lit(p).cast("decimal(3,0)") * F.col("positive_score").cast("decimal(19,0)") for p in window)
    hundred = F.lit(100).cast("decimal(3,0)")
    windows = nearest.where("positive_score >= 0").select(
        "key",
        "place",
        F.call_function("div", high, hundred).alias("high"),
        F.call_function("div", low + F.lit(99).cast("decimal(3,0)"), hundred).alias("low"),
    )
    parts = [lambda n=n: F.expr(f"high - (high - low) div {n}") for n in (4, 2)]
    found = _fill(windows, anchors, blocks, [*parts, lambda: F.col("low")], len(order), negatives, False, scratch, "neg")
    if found is None:
        found = nearest.select(F.col("key").alias("anchor"), "place", F.lit(0).alias("rank"), "key", "key").limit(0)
        found = found.toDF("anchor", "place", "rank", "id", "score")
    named = nearest.join(anchors.select("key", F.col("vec_id").alias("anchor_id")), "key").withColumnRenamed("key", "anchor")
    return found.join(named, ["anchor", "place"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
