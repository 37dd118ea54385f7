import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from fieldmart.llm.exact_dedup import ENTRY, exact_dedup, keep_first, merge_runs


def brute(rows, keep):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        best = (max if keep == "largest" else min)(ids, default=None)
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, best, len(groups[text or ""]), doc_id == best, digest))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_against_brute_force(documents, scratch):
    texts = ["a", "b", None, "", "ß\n", "A", "a ", "long " * 30_000]
    rows = [(i, texts[i * 7 % 8] if i % 3 else "hot") for i in range(300)]
    for keep in ("smallest", "largest"):
        for bucket_rows in (5, 200_000):
            df = exact_dedup(documents(rows, 19), scratch, keep=keep, bucket_rows=bucket_rows)
            assert found(df) == brute(rows, keep)


def test_null_ids_and_repeated_rows(documents, scratch):
    rows = [(None, "a"), (5, "a"), (None, "b"), (None, "b"), (7, "c"), (7, "c"), (-4, "a")]
    assert found(exact_dedup(documents(rows), scratch)) == brute(rows, "smallest")


def test_smallest_and_largest_ids_there_are(documents, scratch):
    low, high = -(2**63), 2**63 - 1
    rows = [(low, "a"), (None, "a"), (low, "b"), (high, "b"), (high, "c"), (None, "c"), (None, "d"), (low, "e"), (0, "e")]
    for keep in ("smallest", "largest"):
        assert found(exact_dedup(documents(rows), scratch, keep=keep)) == brute(rows, keep)


def test_one_row_of_each_text_stays(documents, clash, scratch):
    assert keep_first(documents([]), scratch).collect() == []
    rows = [(None, "a"), (5, "a"), (3, "a"), (3, "a"), (None, "b"), (None, "b"), (3, "c"), (7, None), (8, ""), (9, "d")]
    kept = [(3, "a"), (None, "b"), (3, "c"), (7, None), (9, "d")]
    for docs in (documents(rows), clash(rows, "node", "digest", "keep", "bucket", "last")):
        stay = keep_first(docs, scratch)
        assert stay.columns == docs.columns
        assert found(stay.select("doc_id", "text")) == sorted(kept, key=repr)


def test_empty_table_and_clashing_columns(documents, clash, scratch):
    assert exact_dedup(documents([]), scratch).collect() == []
    rows = [(1, "a"), (2, "a")]
    df = exact_dedup(clash(rows, "node", "digest", "keep", "bucket", "check", "size"), scratch)
    assert found(df) == brute(rows, "smallest")


def test_normalised_text(documents, scratch):
    df = exact_dedup(documents([(1, "A b"), (2, "a B")]), scratch, normalise=F.lower)
    assert [(r.keep_id, r.group_size) for r in df.collect()] == [(1, 2), (1, 2)]


def test_merge_keeps_digest_bytes_and_verifies():
    one = np.zeros(2, dtype=ENTRY)
    one["digest"] = [[1, 0, 0, 9], [1, 0, 0, 9]]
    one["check"], one["keep"], one["size"] = [5, 6], [3, 4], 1
    other = one[:1].copy()
    other["keep"] = 2
    merged = merge_runs([one, other])
    assert merged.dtype == ENTRY
    assert [(int(e["check"]), int(e["keep"]), int(e["size"])) for e in merged] == [(5, 2, 2), (6, 4, 1)]
    assert merged["digest"][0].tobytes() == one["digest"][0].tobytes()
