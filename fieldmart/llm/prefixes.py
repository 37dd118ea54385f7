"""Similarity join of documents by adaptive prefixes of their word shingles."""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldmart.llm.common import Scratch, batch, batch_of_rows, lists, text_of
from fieldmart.llm.components import connected

SHINGLE_WORDS = 4
SIMILAR = 85  # per cent of the union
MATCHES = 16  # common tokens that every set can ask for
RANKED = 1 << 61  # tokens below this, a quarter of all, come first and are ranked by their frequency
MATCH_COST, VERIFY_COST = 1, 1  # of one entry of a list, and of one shingle of a candidate
SMALL_LIST = 8  # members of a list that are all compared in the first round
PIVOTS = (1, 8)  # of longer lists, round by round; then all, in blocks
BLOCK = 2048  # members of a list in one block
BROADCAST_ROWS = 500_000  # of one number
SLACK = 2  # per cent, for what 32 bits can err
WHOLE = 256  # sets up to this size travel whole, as 32 bits of each token, to where blocks are compared

SIGNED = "row long, part int, doc_id long, digest binary, n long, ranked int, tokens array<long>, text string"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    """Words between white space (0x20, 0x09 to 0x0D), with A-Z in lower case."""
    return text.encode().lower().split()


def shingle_set(text: str, words: int = SHINGLE_WORDS) -> set[tuple[bytes, ...]]:
    """The distinct shingles; of fewer words the whole sequence as one."""
    found = words_of(text)
    size = min(words, len(found))
    return set(zip(*[found[i:] for i in range(size)], strict=False)) if size else set()


class WordHashes:
    """Keyed hashes of words. With a key drawn for each run nobody can make texts whose hashes meet."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=16).digest().decode("latin-1")

    def of(self, found: list[bytes]) -> np.ndarray:
        """64 bits of SipHash for each word; nothing is remembered."""
        values = np.empty(len(found), dtype=object)
        values[:] = found
        return hash_array(values, encoding="latin-1", hash_key=self.key, categorize=False)


def tokens_of(text: str, words: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct 63-bit hashes of a text's shingles."""
    found = words_of(text)
    size = min(words, len(found))
    if not size:
        return np.zeros(0, dtype=np.int64)
    single = hashes.of(found)
    mixed = np.full(len(found) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        mixed = (mixed ^ single[i : len(found) - size + 1 + i]) * _ODD
        mixed ^= mixed >> np.uint64(29)
    mixed = np.sort(mixed >> np.uint64(1))
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])].astype(np.int64)


def short_form(tokens: np.ndarray) -> bytes:
    """The highest 32 bits of each token, distinct ones."""
    return np.unique((tokens >> 31).astype("<u4")).tobytes()


def least_common(n, m, similar: int):
    """So many tokens two sets of n and m must share to be similar."""
    return -(-similar * (n + m) // (100 + similar))


def own_common(n: int, similar: int) -> int:
    """So many tokens a set of n shares with any similar set, at least."""
    return -(-similar * n // 100)


def prefix_length(n: int, similar: int, matches: int) -> int:
    """So many first tokens of a set of n hold `matches` of those it shares with any similar set."""
    return n - own_common(n, similar) + matches


def _signed(words: int, similar: int, key: bytes):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, row = WordHashes(key), 0
        for rows in batches:
            for start in range(0, rows.num_rows, 512):
                out = []
                for part, doc_id, text in lists(rows.slice(start, 512), "part", "doc_id", "text"):
                    found = tokens_of(text, words, hashes)
                    n, ranked = len(found), int(np.searchsorted(found, RANKED))
                    offered = max(ranked, prefix_length(n, similar, min(MATCHES, own_common(n, similar))))
                    digest = blake2b(found.tobytes(), digest_size=16, key=key).digest() if n else None
                    out.append(((part << 40) + row, part, doc_id, digest, n, ranked, found[:offered], text))
                    row += 1
                yield batch_of_rows(SIGNED, out)

    return sign


def _short_forms(words: int, key: bytes):
    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes(key)
        for rows in batches:
            found = [short_form(tokens_of(text, words, hashes)) for (text,) in lists(rows, "text")]
            yield batch("set long, whole binary", [rows.column("set"), found])

    return shorten


PREFIX = "set long, n long, rest long, first int, prefix array<long>"


def choose(n: int, ranked: int, tokens: np.ndarray, sets: np.ndarray, places: np.ndarray, similar: int):
    """How many matches a set asks for, its prefix's shared tokens in order, and how many of them a single match needs.

    `tokens` are those of the set that other `sets` have too, at their `places` among all of its own by hash.

    All sets order tokens alike: those below RANKED by frequency, rare ones first, then the others by hash.
    A longer prefix meets more entries of lists, but of m entries at most m / matches can be candidates; among
    sets of its own size a pair needs `more` matches, as both cannot be similar with less in common.
    """
    counted = places < ranked
    order = np.lexsort((np.where(counted, 0, places), np.where(counted, tokens, 0), np.where(counted, sets, 0), ~counted))
    tokens, sets, places, counted = tokens[order], sets[order], places[order], counted[order]
    # Tokens of one set alone come before all others that are ranked.
    at = np.where(counted, np.arange(len(tokens)) + ranked - counted.sum(), places)
    met = np.concatenate([[0], np.cumsum(sets - 1)])
    own = own_common(n, similar)
    asked, more = np.arange(1, min(own, max(MATCHES, ranked - n + own)) + 1), least_common(n, n, similar) - own
    ends = np.searchsorted(at, [prefix_length(n, similar, int(m)) for m in asked])
    cost = met[ends] * MATCH_COST + met[ends] / (asked + more) * n * VERIFY_COST
    best = int(np.argmin(cost))
    return int(asked[best]), tokens[: ends[best]], int(ends[0])


def _prefixes(similar: int):
    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for i, (set_, n, ranked) in enumerate(lists(rows, "set", "n", "ranked")):
                tokens, sets, places = (rows.column(c)[i].values.to_numpy() for c in ("tokens", "sets", "places"))
                matches, prefix, first = choose(n, ranked, tokens, sets, places, similar)
                if first:
                    out.append((set_, n, n - prefix_length(n, similar, matches), first, prefix))
            yield batch_of_rows(PREFIX, out)

    return shorten


def _verified(words: int, similar: int):
    """Pairs whose whole sets, word by word, are similar."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, set()
        for rows in batches:
            for start in range(0, rows.num_rows, 256):
                out = []
                for a, b, text_a, text_b in lists(rows.slice(start, 256), "a", "b", "text_a", "text_b"):
                    if a != last:
                        last, left = a, shingle_set(text_a, words)
                    right = shingle_set(text_b, words)
                    common = len(left & right)
                    if 100 * common >= similar * (len(left) + len(right) - common):
                        out.append((a, b))
                yield batch_of_rows("a long, b long", out)

    return check


def _open_members(entries: DataFrame, roots: DataFrame | None, turn: int) -> DataFrame:
    """(token, set, n, root, length) of the lists that are not one component yet; small ones only at first."""
    members = entries.withColumn("root", F.col("set"))
    if roots is not None:
        known = roots.select(F.col("vertex").alias("set"), F.col("root").alias("known"))
        members = entries.join(known, "set", "left").withColumn("root", F.coalesce("known", "set")).drop("known")
    found = members.groupBy("token").agg(F.count("*").alias("length"), F.min("root").alias("low"), F.max("root").alias("high"))
    still = found.where((F.col("low") != F.col("high")) & (F.col("length") > (SMALL_LIST if turn else 1)))
    return members.join(still.select("token", "length"), "token")


def _pairs(members: DataFrame, pivots: int, similar: int) -> DataFrame:
    """Distinct pairs (a, b) of each list: its pivots with the members outside their component; all of a small list."""
    slot = F.when(F.col("length") > SMALL_LIST, F.pmod(F.xxhash64("set"), F.lit(pivots))).otherwise(F.col("set"))
    one = F.min(F.struct("set", "root", "n")).alias("one")
    chosen = members.groupBy("token", slot.alias("slot")).agg(one)
    chosen = chosen.select("token", *[F.col(f"one.{c}").alias(f"pivot_{c}") for c in ("set", "root", "n")])
    met = members.join(chosen, "token").where("root <> pivot_root")
    met = met.where(100 * F.least("n", "pivot_n") >= similar * F.greatest("n", "pivot_n"))
    return met.select(F.least("set", "pivot_set").alias("a"), F.greatest("set", "pivot_set").alias("b")).distinct()


def _with_both(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with the columns of both sets."""
    for side in "ba":
        own = table.select(F.col("set").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs


def _compare_blocks(similar: int):
    """Pairs of two blocks of a list with matches enough, each in the list of the smallest token both are listed under."""

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        token, p, q = (x.as_py() for x in key)
        table = table.combine_chunks()
        block, set_, n, root, rest = (table.column(c).to_numpy() for c in ("block", "set", "n", "root", "rest"))
        prefixes, listed = ([np.asarray(x, dtype=np.int64) for x in table.column(c).to_pylist()] for c in ("prefix", "listed"))
        wholes = [None if x is None else np.frombuffer(x, "<u4") for x in table.column("whole").to_pylist()]
        names, codes = np.unique(np.concatenate(prefixes), return_inverse=True)
        width, this, out = max(map(len, prefixes)), int(np.searchsorted(names, token)), []
        held, smaller = np.full((len(n), width), len(names)), np.zeros((len(n), len(names) + 1), dtype=bool)
        ends = np.cumsum([len(x) for x in prefixes])
        for i, (own, tokens) in enumerate(zip(prefixes, listed, strict=True)):
            held[i, : len(own)] = codes[ends[i] - len(own) : ends[i]]
            at = np.searchsorted(names, tokens)
            smaller[i, at[at < this]] = True
        mark = np.zeros(len(names) + 1, dtype=bool)
        for i in np.flatnonzero(block == p):
            fit = (block == q) & (root != root[i]) & (100 * np.minimum(n, n[i]) >= similar * np.maximum(n, n[i]))
            if p == q:
                fit[: i + 1] = False
            others = np.flatnonzero(fit)
            before = np.flatnonzero(smaller[i])
            others = others[~smaller[np.ix_(others, before)].any(axis=1)]
            mark[:] = False
            mark[held[i]] = True
            mark[-1] = False
            asked = least_common(n[others], n[i], similar) - np.maximum(rest[others], rest[i])
            enough = mark[held[others]].sum(axis=1) >= asked
            for j in others[enough]:
                if wholes[i] is not None and wholes[j] is not None:
                    # Nearly the answer: only the bits left out can err, which the words decide later.
                    common = len(np.intersect1d(wholes[i], wholes[j], assume_unique=True))
                    if 100 * common < (similar - SLACK) * (len(wholes[i]) + len(wholes[j]) - common):
                        continue
                out.append((min(set_[i], set_[j]), max(set_[i], set_[j])))
        return pa.Table.from_batches([batch_of_rows("a long, b long", out)])

    return compare


def _block_pairs(members: DataFrame, prefixes: DataFrame, wholes: DataFrame, similar: int) -> DataFrame:
    """All pairs across components of the lists that are left, in tasks of two blocks of a list each.

    A member travels with its prefix, and its short form if `wholes` has one, once per block of its list,
    not once per pair.
    """
    listed = members.groupBy("set").agg(F.collect_list("token").alias("listed"))
    listed = listed.join(prefixes.select("set", "rest", "prefix"), "set").join(wholes, "set", "left")
    rows = members.join(listed, "set")
    blocks = F.ceil(F.col("length") / BLOCK).cast("long")
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")})
    rows = rows.select("token", "p", "q", "block", "set", "n", "root", "rest", "prefix", "listed", "whole")
    return rows.groupBy("token", "p", "q").applyInArrow(_compare_blocks(similar), "a long, b long").distinct()


def similar_documents(
    docs: DataFrame, scratch: Scratch, words: int = SHINGLE_WORDS, similar: int = SIMILAR
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents with equal shingle sets are one vertex. A set's tokens are put into an order common to all sets.
    Whatever number of matches l is asked for, the first n - ceil(similar n) + l tokens of a set of n hold
    l of those it shares with any similar set. Each set takes the l, and so the prefix, with the least
    estimated cost. Two sets must share t tokens; at most as many lie behind the prefix of each as it
    leaves out, and the others are in both, so a pair needs t less the longer rest before it is verified on its
    words. To meet at all, it needs one list of the prefixes for l = 1.

    Long lists are not expanded into all pairs. In each round a few members of a list are compared with
    those not yet in their component; once a list is one component it is done. What is apart after the last
    number of pivots is compared completely, block by block. Pairs within a component cannot change it.

    Sets without words link with nothing, and have their own id as component_id; null texts have no words.
    Null ids take part: their component_id is the smallest id reachable, null if there is none. Repeated
    rows are in one component. An empty table gives an empty result. Other columns are ignored.
    """
    own = docs.select(F.spark_partition_id().alias("part"), docs["doc_id"].cast(LongType()).alias("doc_id"), text_of(docs).alias("text"))
    key = secrets.token_bytes(16)
    signed = scratch.pin(own.mapInArrow(_signed(words, similar, key), SIGNED), "signed")
    rows = scratch.pin(signed.select("row", "part", "doc_id", "n", "digest"), "rows")
    some = rows.where("digest IS NOT NULL")
    leaves = some.groupBy("part", "digest").agg(F.min("row").alias("row"), F.min("doc_id").alias("least"))
    sets = leaves.groupBy("digest").agg(F.min("row").alias("set"), F.min("least").alias("least"))
    sets = scratch.pin(sets, "sets")

    copies = some.select("row").join(sets.select(F.col("set").alias("row")), "row", "left_anti")
    copies = scratch.pin(copies, "copies")
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    own_rows = signed.where("digest IS NOT NULL").join(copies, "row", "left_anti").withColumnRenamed("row", "set")
    offered = own_rows.select("set", F.posexplode("tokens").alias("place", "token"))
    held = offered.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1")
    held = scratch.pin(held, "held")  # its shuffle has all tokens, as that of the join: they do not lie on disk together
    shared = offered.join(held, "token").groupBy("set").agg(F.collect_list(F.struct("token", "sets", "place")).alias("one"))
    shared = shared.select("set", *[F.col(f"one.{c}").alias(c) for c in ("token", "sets", "place")])
    shared = shared.withColumnsRenamed({"token": "tokens", "place": "places"})
    shared = shared.join(own_rows.select("set", "n", "ranked"), "set")
    prefixes = scratch.pin(shared.mapInArrow(_prefixes(similar), PREFIX), "prefixes")
    scratch.drop("held")
    entries = prefixes.select("set", "n", F.explode(F.expr("slice(prefix, 1, first)")).alias("token"))
    entries = scratch.pin(entries, "entries")
    meeting = entries.groupBy("token").agg(F.count("*").alias("length")).where("length > 1")
    involved = entries.join(meeting.select("token"), "token").select("set").distinct()
    texts = signed.select(F.col("row").alias("set"), "text").join(involved, "set")
    texts = scratch.pin(texts, "texts")
    scratch.drop("signed")  # tokens and texts, the largest of the written tables

    roots, links, tested = None, None, None
    for turn, pivots in enumerate((*PIVOTS, None)):
        members = scratch.pin(_open_members(entries, roots, turn), f"members-{turn}")
        if members.isEmpty():
            break
        if pivots is None:
            short = members.where(F.col("n") <= WHOLE).select("set").distinct()
            wholes = texts.join(short, "set").mapInArrow(_short_forms(words, key), "set long, whole binary")
            found = _block_pairs(members, prefixes, wholes, similar)
        else:
            found = _pairs(members, pivots, similar)
            if tested is not None:
                found = found.join(tested, ["a", "b"], "left_anti")
            tested = scratch.pin(found, f"pairs-{turn}")
            both = _with_both(tested, prefixes, ["n", "rest", "prefix"])
            met = F.size(F.array_intersect("prefix_a", "prefix_b"))
            common = F.ceil(F.lit(similar) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + similar))
            found = both.where(met >= common - F.greatest("rest_a", "rest_b")).select("a", "b")
        found = _with_both(scratch.pin(found, f"candidates-{turn}"), texts, ["text"])
        found = scratch.pin(found.mapInArrow(_verified(words, similar), "a long, b long"), f"links-{turn}")
        links = found if links is None else links.union(found)
        roots = scratch.pin(connected(links, scratch, f"roots-{turn}"), f"roots-{turn}")

    tops = sets.select("set", "digest", "least", F.col("set").alias("root"))
    if roots is not None:
        known = roots.select(F.col("vertex").alias("set"), F.col("root").alias("known"))
        tops = tops.join(known, "set", "left").withColumn("root", F.coalesce("known", "root")).drop("known")
    smallest = tops.groupBy("root").agg(F.min("least").alias("component"))
    named = leaves.select("part", "digest").join(tops.join(smallest, "root").select("digest", "component"), "digest")
    found = rows.select("part", "doc_id", "n", "digest").join(named, ["part", "digest"], "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
