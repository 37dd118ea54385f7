"""Near-duplicates by bottom-k sketches of word shingles."""

from __future__ import annotations

import math
import secrets
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldmart.llm.common import Scratch, batch, batch_of_rows, lists, share_smallest, text_of, tidy
from fieldmart.llm.components import connected
from fieldmart.llm.prefixes import WordHashes, shingle_set, tokens_of

SHINGLE_WORDS = 5
SIMILAR = 75  # per cent of the union
SKETCH = 64
SMALL_LIST = 8  # members of an inverted list that are all compared in the first round
PIVOTS = (1, 8)  # of longer lists, round by round; then all, in blocks
BLOCK = 2048  # members of a list in one block
WIDE_SKETCH = 256  # smallest shingle hashes that blocks compare, their highest 32 bits
BROADCAST_ROWS = 500_000
ROWS_AT_ONCE = 512  # texts that a task holds as Python strings

SKETCHED = "row long, part int, doc_id long, digest binary, n_shingles long, name binary, sketch array<long>"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, length: int) -> np.ndarray:
    known = _powers.get(int(base))
    if known is None or len(known) < length:
        known = np.full(max(length, 1 << 16), base, dtype=np.uint64)
        known[0] = 1
        known = _powers[int(base)] = np.cumprod(known)
    return known[:length]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, words: int = SHINGLE_WORDS, hashes: WordHashes | None = None) -> np.ndarray:
    """The sorted distinct 63-bit hashes of a text's shingles; of fewer words, the whole as one."""
    return tokens_of(text, words, WordHashes(b"") if hashes is None else hashes).view(np.uint64)


def _name(found: np.ndarray, key: bytes) -> bytes | None:
    """128 keyed bits that stand for a whole set; none for a text without words."""
    return blake2b(found.tobytes(), digest_size=16, key=key).digest() if len(found) else None


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose texts a task holds as Python strings."""
    for rows in batches:
        for start in range(0, rows.num_rows, ROWS_AT_ONCE):
            yield rows.slice(start, ROWS_AT_ONCE)


def _sketches(size: int, words: int, key: bytes):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, row = WordHashes(key), 0
        for some in _slices(batches):
            out = []
            for part, doc_id, digest, text in lists(some, "part", "doc_id", "digest", "text"):
                found = shingles(text, words, hashes)
                sketch = found[:size].astype(np.int64)
                out.append(((part << 40) + row, part, doc_id, digest, len(found), _name(found, key), sketch))
                row += 1
            yield batch_of_rows(SKETCHED, out)

    return sketch


def estimate(a: np.ndarray, b: np.ndarray, size: int) -> float:
    """Share of the union's bottom-k sketch that is in both sketches."""
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    distinct = np.concatenate([[True], ~twice])
    last = min(size, int(distinct.sum()))
    cut = both[distinct][last - 1]
    return int((twice & (both[1:] <= cut)).sum()) / last


def least_share(size: int, similar: int) -> float:
    """Least share of its sketch that a set has in common with a similar one, in whole hundredths.

    The expected share is the similarity; this is five standard deviations below, 0.47 for 64 values and 75 per cent.
    """
    share = similar / 100
    return max(0, math.floor(100 * (share - 5 * math.sqrt(share * (1 - share) / size)))) / 100


def _promising(size: int, similar: int):
    least = least_share(size, similar)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sketches = zip(rows.column("sketch_a"), rows.column("sketch_b"), strict=True)
            ok = [estimate(a.values.to_numpy(), b.values.to_numpy(), size) >= least for a, b in sketches]
            yield rows.select(["a", "b"]).filter(pa.array(ok, type=pa.bool_()))

    return check


def _verified(words: int, similar: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, set()
        for rows in batches:
            for start in range(0, rows.num_rows, 256):
                some, out = rows.slice(start, 256), []
                for a, b, text_a, text_b in lists(some, "a", "b", "text_a", "text_b"):
                    if a != last:
                        last, left = a, shingle_set(text_a, words)
                    right = shingle_set(text_b, words)
                    common = len(left & right)
                    if 100 * common >= similar * (len(left) + len(right) - common):
                        out.append((a, b))
                yield batch_of_rows("a long, b long", out)

    return check


def _of_sets(words: int, key: bytes):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(key)
        for some in _slices(batches):
            own = [_name(shingles(text, words, hashes), key) == name for name, text in lists(some, "name", "text")]
            yield some.select(["set", "text"]).filter(pa.array(own, type=pa.bool_()))

    return keep


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _inverted_lists(sketches: DataFrame, scratch: Scratch, share: float) -> DataFrame:
    """(value, set, n): for each set its rarest retained values, as many as two similar sets cannot both lack.

    Two sets that have at least the share `share` of their sketches in common must meet in the first
    values of each by any common order that are more than the rest. The order is by how many sets
    retain a value, so values that many sets have (boilerplate) come last and are seldom needed,
    and values that a single set has take up places without being sent on.
    """
    values = sketches.select("set", "n", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    common = values.groupBy("value").agg(F.count("*").alias("sets")).where("sets > 1")
    shared = values.join(common, "value")
    per_set = shared.groupBy("set", "n", "size").agg(F.array_sort(F.collect_list(F.struct("sets", "value"))).alias("values"))
    alone = F.col("size") - F.size("values")
    places = F.col("size") - F.ceil(F.col("size") * F.lit(share)) + 1 - alone
    rarest = per_set.withColumn("places", places.cast("int")).where("places > 0")
    rarest = rarest.select("set", "n", F.explode(F.expr("slice(values, 1, places)")).alias("one"))
    return scratch.pin(rarest.select(F.col("one.value").alias("value"), "set", "n"), "lists")


def _open_members(lists_: DataFrame, roots: DataFrame | None, turn: int) -> DataFrame:
    """(value, set, n, root, length) of the lists that are not one component yet; small ones only in the first round."""
    members = lists_.withColumn("root", F.col("set"))
    if roots is not None:
        known = roots.select(F.col("vertex").alias("set"), F.col("root").alias("known"))
        members = lists_.join(known, "set", "left").withColumn("root", F.coalesce("known", "set")).drop("known")
    lengths = members.groupBy("value").agg(
        F.count("*").alias("length"), F.min("root").alias("first"), F.max("root").alias("last")
    )
    open_lists = lengths.where("first <> last").select("value", "length")
    if turn:
        open_lists = open_lists.where(F.col("length") > SMALL_LIST)
    return members.join(open_lists, "value")


def _pairs(members: DataFrame, pivots: int, similar: int) -> DataFrame:
    """Distinct pairs (a, b) of each list: of its pivots with the members outside their component."""
    chosen = members.select("value", "length", F.col("set").alias("pivot"), F.col("root").alias("pivot_root"), F.col("n").alias("m"))
    every = chosen.where(F.col("length") <= SMALL_LIST)
    longer = chosen.where(F.col("length") > SMALL_LIST).withColumn("slot", F.pmod(F.xxhash64("pivot"), F.lit(pivots)))
    one = F.min(F.struct("pivot", "pivot_root", "m")).alias("one")
    longer = longer.groupBy("value", "slot").agg(one).select("value", "one.*")
    chosen = every.select(*longer.columns).union(longer)
    met = members.join(chosen, "value").where("root <> pivot_root")
    met = met.where(100 * F.least("n", "m") >= similar * F.greatest("n", "m"))
    return met.select(F.least("set", "pivot").alias("a"), F.greatest("set", "pivot").alias("b")).distinct()


def _wide_sketches(words: int, key: bytes):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(key)
        for some in _slices(batches):
            found = [shingles(text, words, hashes)[:WIDE_SKETCH] for (text,) in lists(some, "text")]
            yield batch("set long, wide binary", [some.column("set"), [(x >> np.uint64(31)).astype("<u4").tobytes() for x in found]])

    return sketch


def _compare_blocks(similar: int):
    """Pairs of two blocks of a list that may be similar, each pair in the list of its smallest common value only."""
    least = similar / 100 - 5 * float(np.sqrt(similar / 100 * (1 - similar / 100) / WIDE_SKETCH))

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        value, p, q = (x.as_py() for x in key)
        rows = table.to_pydict()
        block, n, root = (np.array(rows[name]) for name in ("block", "n", "root"))
        wide = [np.frombuffer(x, dtype="<u4") for x in rows["wide"]]
        flat, width = [v for own in rows["values"] for v in own], max(map(len, rows["values"]))
        distinct, codes = np.unique(np.array(flat, dtype=np.int64), return_inverse=True)
        codes = iter(codes)
        held = np.full((len(n), width), len(distinct))
        for i, own in enumerate(rows["values"]):
            held[i, : len(own)] = [next(codes) for _ in own]
        this = int(np.searchsorted(distinct, value))
        out = []
        for i in np.flatnonzero(block == p):
            fit = (block == q) & (root != root[i])
            fit &= 100 * np.minimum(n, n[i]) >= similar * np.maximum(n, n[i])
            if p == q:
                fit[: i + 1] = False
            others = np.flatnonzero(fit)
            smaller = held[i][held[i] < this]
            if len(smaller) and len(others):
                mark = np.zeros(len(distinct) + 1, dtype=bool)
                mark[smaller] = True
                others = others[~mark[held[others]].any(axis=1)]
            for j in others:
                # Whole sets are compared in their complete union, where only the 32 bits can err.
                whole = max(n[i], n[j]) <= WIDE_SKETCH
                size, cut = (2 * WIDE_SKETCH, similar / 100 - 0.02) if whole else (WIDE_SKETCH, least)
                if estimate(wide[i], wide[j], size) >= cut:
                    out.append((min(rows["set"][i], rows["set"][j]), max(rows["set"][i], rows["set"][j])))
        return pa.Table.from_batches([batch_of_rows("a long, b long", out)])

    return compare


def _block_pairs(members: DataFrame, wide: DataFrame, similar: int) -> DataFrame:
    """All pairs across components of the lists that are left, compared within tasks of two blocks each.

    A member travels with its sketch once per block of its list, not once per pair, so a list of m
    members costs m * m / BLOCK rows; only pairs that pass the estimate leave a task.
    """
    per_set = members.groupBy("set").agg(F.sort_array(F.collect_list("value")).alias("values"))
    rows = members.join(per_set, "set").join(wide, "set")
    blocks = F.ceil(F.col("length") / BLOCK).cast("long")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")})
    rows = rows.select("value", "p", "q", "block", "set", "n", "root", "values", "wide")
    return rows.groupBy("value", "p", "q").applyInArrow(_compare_blocks(similar), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    scratch: Scratch,
    words: int = SHINGLE_WORDS,
    similar: int = SIMILAR,
    sketch_size: int = SKETCH,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents with equal shingle sets are one vertex. A vertex retains its `sketch_size` smallest
    shingle hashes; inverted lists of these give the pairs, the sketch of the union estimates
    their similarity, and what may be similar is verified on the full sets.

    Long lists are not expanded into all pairs. In each round a few members of a list are compared
    with all those that are not yet in their component; once a list is one component it is done.
    What is still apart after the last number of pivots is compared completely, block by block of a
    list, so no list is cut short. Pairs within a component need no comparison, as they cannot change it.

    Sets without words link with nothing; null texts have no words. Null ids take part: their
    component_id is the smallest id reachable, null if there is none, and `kept` says whether both are equal.
    Repeated rows are in one component. An empty table gives an empty result. Other columns are ignored.
    """
    rows = _components(docs, scratch, words, similar, sketch_size)
    component = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def _components(
    docs: DataFrame, scratch: Scratch, words: int, similar: int, sketch_size: int, digest: Column | None = None
) -> DataFrame:
    """(part, doc_id, digest, n_shingles, set, root, component_id) of every row; without words the last three are null.

    Hashes are keyed anew in each run, so that nobody can write texts whose hashes meet.
    """
    key = secrets.token_bytes(16)
    digest = F.lit(None).cast("binary") if digest is None else digest
    own = docs.select(docs["doc_id"].cast(LongType()).alias("doc_id"), text_of(docs).alias("text"), digest.alias("digest"))
    parted = own.withColumn("part", F.spark_partition_id())
    rows = scratch.pin(parted.mapInArrow(tidy(_sketches(sketch_size, words, key)), SKETCHED), "sketches")

    some = rows.where("name IS NOT NULL")
    leaves = some.groupBy("part", "name").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("least"), F.min("n_shingles").alias("n")
    )
    sets = leaves.groupBy("name").agg(F.min("row").alias("set"), F.min("least").alias("least"), F.min("n").alias("n"))
    sets = scratch.pin(sets, "sets")
    first = some.groupBy("part", "name").agg(F.min("sketch").alias("sketch"))  # all are equal
    sketches = first.groupBy("name").agg(F.min("sketch").alias("sketch")).join(sets.select("name", "set", "n"), "name").drop("name")
    sketches = scratch.pin(sketches, "set-sketches")

    inverted = _inverted_lists(sketches, scratch, least_share(sketch_size, similar))
    meeting = inverted.groupBy("value").agg(F.count("*").alias("length")).where("length > 1").select("value")
    inverted = scratch.pin(inverted.join(meeting, "value"), "meeting")
    involved = scratch.pin(inverted.select("set").distinct(), "involved")
    named = scratch.pin(sets.join(involved, "set").select("set", "name", F.col("least").alias("own_id")), "named")
    texts = own.join(_small(named), F.col("doc_id").eqNullSafe(F.col("own_id"))).select("set", "name", "text")
    texts = scratch.pin(texts.mapInArrow(tidy(_of_sets(words, key)), "set long, text string").dropDuplicates(["set"]), "texts")
    own_sketches = scratch.pin(sketches.join(involved, "set").select("set", "sketch"), "own-sketches")

    roots, tested, links = None, None, None
    for turn, pivots in enumerate((*PIVOTS, None)):
        members = scratch.pin(_open_members(inverted, roots, turn), f"members-{turn}")
        if members.isEmpty():
            break
        if pivots is None:
            wide = texts.mapInArrow(tidy(_wide_sketches(words, key)), "set long, wide binary")
            promising = _block_pairs(members, wide, similar)
        else:
            pairs = _pairs(members, pivots, similar)
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            pairs = scratch.pin(pairs, f"pairs-{turn}")
            tested = pairs if tested is None else tested.union(pairs)
            promising = pairs.join(own_sketches.withColumnsRenamed({"set": "a", "sketch": "sketch_a"}), "a")
            promising = promising.join(own_sketches.withColumnsRenamed({"set": "b", "sketch": "sketch_b"}), "b")
            promising = promising.mapInArrow(tidy(_promising(sketch_size, similar)), "a long, b long")
        promising = scratch.pin(promising, f"promising-{turn}")
        with_texts = promising.join(texts.withColumnsRenamed({"set": "b", "text": "text_b"}), "b")
        with_texts = with_texts.join(texts.withColumnsRenamed({"set": "a", "text": "text_a"}), "a")
        found = scratch.pin(with_texts.mapInArrow(tidy(_verified(words, similar)), "a long, b long"), f"links-{turn}")
        links = found if links is None else links.union(found)
        roots = scratch.pin(connected(links, scratch, f"roots-{turn}"), f"roots-{turn}")

    tops = sets.select("set", "name", F.col("set").alias("root"), "least")
    if roots is not None:
        known = roots.select(F.col("vertex").alias("set"), F.col("root").alias("known"))
        tops = tops.join(known, "set", "left").withColumn("root", F.coalesce("known", "root")).drop("known")
    smallest = tops.groupBy("root").agg(F.min("least").alias("component_id"))
    tops = tops.join(smallest, "root").select("name", "set", "root", "component_id")
    leaves = leaves.select("part", "name").join(tops, "name")
    return rows.drop("sketch", "row").join(leaves, ["part", "name"], "left").drop("name")


def keep_one_of_each(
    docs: DataFrame,
    scratch: Scratch,
    words: int = SHINGLE_WORDS,
    similar: int = SIMILAR,
    sketch_size: int = SKETCH,
) -> DataFrame:
    """The rows of docs, all their columns, that stay: one of each component, and all without words.

    The row with the smallest id stays, null ids last; of several texts under this id that with the
    smallest digest. Rows with equal id and equal text are told apart by nothing; one of them stays.
    """
    digest = F.unhex(F.sha2(text_of(docs).cast("binary"), 256))
    rows = _components(docs, scratch, words, similar, sketch_size, digest).where("set IS NOT NULL")
    one = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest").alias("one")
    decided = share_smallest(scratch.pin(rows.select("part", "root", one), "decided"), "root", "one", "first")
    decided = decided.withColumn("kept", F.col("one").eqNullSafe(F.col("first")))
    keys = F.col("one.doc_id").alias("__id"), F.col("one.digest").alias("__digest")
    decided = scratch.pin(decided.groupBy(*keys, "kept").agg(F.count("*").alias("n")), "fates")
    meets = docs["doc_id"].cast(LongType()).eqNullSafe(F.col("__id")) & (digest == F.col("__digest"))
    stay = docs.join(decided.where("NOT kept").select("__id", "__digest"), meets, "left_anti")
    again = decided.where("kept AND n > 1").select("__id", "__digest")
    if again.isEmpty():
        return stay
    keyed = stay.withColumns({"__own": docs["doc_id"].cast(LongType()), "__text": digest})
    meets = F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__digest"))
    repeated = keyed.join(again, meets, "left_semi").dropDuplicates(["__own", "__text"])
    return keyed.join(again, meets, "left_anti").unionByName(repeated).drop("__own", "__text")
