"""Benchmark decontamination by winnowing. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from fieldmart.llm.common import Scratch, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 500_000  # of two or three numbers each; beyond, joins shuffle


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lower, BETWEEN_WORDS), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _up_to(last: Column) -> Column:
    """0, 1 ... last; empty if that is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def fingerprints(words: Column, window: int, k: int) -> Column:
    """For each run of `window` words the smallest hash among its k-word runs, marked with the window.

    Equal runs of words have equal smallest hashes wherever they stand, so no shared run is missed.
    A window of fewer than k words is hashed whole.
    """
    k = min(k, window)
    inside = window - k + 1

    def of_hashes(h: Column) -> Column:
        at = lambda i: [F.get(h, i + j) for j in range(inside)]
        smallest = (lambda i: F.least(*at(i))) if inside > 1 else (lambda i: at(i)[0])
        return F.transform(_up_to(F.size(h) - inside), lambda i: F.xxhash64(smallest(i), F.lit(window)))

    def of_words(w: Column) -> Column:
        run = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])
        return let(F.transform(_up_to(F.size(w) - k), run), of_hashes)

    return let(F.transform(words, lambda word: F.xxhash64(word)), of_words)


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """Distinct (item_id, gram, length): runs of `window` words, or the whole of a shorter item."""
    words = benchmark.where(F.col("item_id").isNotNull())
    words = words.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words"))
    size = F.size("words")
    runs = F.when(size < window, F.array("words")).otherwise(
        F.transform(_up_to(size - window), lambda i: F.slice(F.col("words"), i + 1, window))
    )
    runs = words.where(size > 0).select("item_id", F.explode(runs).alias("run"))
    return runs.select("item_id", F.array_join("run", " ").alias("gram"), F.size("run").alias("length")).distinct()


def _small(df: DataFrame) -> DataFrame:
    """Broadcast after counting, if the rows are few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def find_hits(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = 10, k: int = 5
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, mark, start, length, gram) of every window of an item in a document, and the items' windows.

    `mark` is a hash of the text, so that repeated ids with other texts stay apart. First the
    documents' fingerprints meet the items'; a document without a common one is done. In
    the others every run of words under a common fingerprint is compared word for word with the
    items' windows. The items' side is broadcast if it is small when counted, else both are shuffled.
    """
    windows = scratch.pin(item_windows(benchmark, window), "windows")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # at most `window` numbers
    own = docs.select(docs["doc_id"].cast(LongType()).alias("doc_id"), text_of(docs).alias("text"))
    own = own.withColumn("mark", F.xxhash64("text", F.octet_length("text")))
    if not lengths:
        empty = own.select("doc_id", "mark", F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit("").alias("gram"))
        return empty.where(F.lit(False)), windows

    print_of = F.lit(None).cast("long")
    for n in lengths:
        one = F.get(fingerprints(F.split("gram", " "), n, k), F.lit(0))
        print_of = F.when(F.col("length") == n, one).otherwise(print_of)
    wanted = scratch.pin(windows.select(print_of.alias("print")).distinct(), "wanted")
    words = words_of(F.col("text"))
    prints = let(words, lambda w: F.array_distinct(F.concat(*[fingerprints(w, n, k) for n in lengths])))
    found = own.select("doc_id", "mark", F.explode(prints).alias("print")).join(_small(wanted), "print")
    common = found.groupBy("doc_id", "mark").agg(F.collect_set("print").alias("prints"))
    common = scratch.pin(common, "common")

    def runs(w: Column, n: int) -> Column:
        marked = F.transform(fingerprints(w, n, k), lambda p, i: F.when(F.array_contains("prints", p), i))
        return F.transform(
            F.filter(marked, lambda i: i.isNotNull()),
            lambda i: F.struct(
                i.alias("start"), F.lit(n).alias("length"), F.array_join(F.slice(w, i + 1, n), " ").alias("gram")
            ),
        )

    same = common.withColumnsRenamed({"doc_id": "own_id", "mark": "own_mark"})
    meets = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark"))
    suspects = own.dropDuplicates(["doc_id", "mark"]).join(_small(same), meets)
    candidates = suspects.select(
        "doc_id", "mark", F.explode(let(words, lambda w: F.concat(*[runs(w, n) for n in lengths]))).alias("run")
    ).select("doc_id", "mark", "run.*")
    grams = windows.select("gram", "length").distinct()
    hits = candidates.join(_small(grams), ["gram", "length"], "left_semi")
    return scratch.pin(hits.select("doc_id", "mark", "start", "length", "gram"), "hits"), windows


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = 10, k: int = 5
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies inside any occurrence of a window of an item. The fingerprint of a window
    of `window` words is the smallest hash of its k-word runs, so every shared run of `window` words
    or more is found; items of fewer words are one window. items_sha256 is over the ids of
    the items found, sorted and joined by commas; with none, over the empty string.

    A null or empty text has no words. Items without id or words are no items; repeated items
    count once. Null ids stay null, repeated rows get equal results, other columns are ignored.
    """
    hits, windows = find_hits(docs, benchmark, scratch, window, k)
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))

    def cover(done: Column, span: Column) -> Column:
        end = F.greatest(done["end"], span["start"] + span["length"])
        fresh = end - F.greatest(done["end"], span["start"])
        return F.struct(end.alias("end"), (done["total"] + F.greatest(fresh, F.lit(0))).alias("total"))

    spans = F.array_sort(F.collect_set(F.struct("start", "length")))
    words = hits.groupBy("doc_id", "mark").agg(spans.alias("spans"))
    words = words.select("doc_id", "mark", F.aggregate("spans", start, cover, lambda d: d["total"]).alias("n_hit"))
    grams = hits.select("doc_id", "mark", "gram", "length").distinct()
    items = grams.join(_small(windows), ["gram", "length"]).select("doc_id", "mark", "item_id").distinct()
    items = items.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    words = words.withColumnsRenamed({"doc_id": "word_id", "mark": "word_mark"})
    items = items.withColumnsRenamed({"doc_id": "item_doc", "mark": "item_mark"})
    all_rows = docs.select(
        docs["doc_id"].cast(LongType()).alias("doc_id"),
        F.xxhash64(text_of(docs), F.octet_length(text_of(docs))).alias("mark"),
        F.size(words_of(docs["text"])).cast("long").alias("n_words"),
    )
    meets_words = F.col("doc_id").eqNullSafe(F.col("word_id")) & (F.col("mark") == F.col("word_mark"))
    meets_items = F.col("doc_id").eqNullSafe(F.col("item_doc")) & (F.col("mark") == F.col("item_mark"))
    joined = all_rows.join(words, meets_words, "left").join(items, meets_items, "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = 10, k: int = 5) -> DataFrame:
    """The rows of docs, all their columns, that share no window with an item."""
    hits, _ = find_hits(docs, benchmark, scratch, window, k)
    bad = hits.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct()
    mark = F.xxhash64(text_of(docs), F.octet_length(text_of(docs)))
    meets = docs["doc_id"].cast(LongType()).eqNullSafe(F.col("__id")) & (mark == F.col("__mark"))
    return docs.join(_small(bad), meets, "left_anti")
