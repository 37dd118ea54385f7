"""Hard negatives against a plain version."""

import math

import numpy as np
import pytest

from fieldmart.llm import negatives
from fieldmart.llm.negatives import at_least, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = "anchor_id positive_id rank negative_id positive_score negative_score".split()


def plain(rows, positives=5, count=10, step=100):
    own = []
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    found = []
    for i, (anchor, a, label) in enumerate(own):
        if anchor % step:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(a, v, strict=False)), vec_id, other == label)
            for j, (vec_id, v, other) in enumerate(own)
            if i != j
        )
        for p, positive, _ in [s for s in scored if s[2]][:positives]:
            fit = [s for s in scored if not s[2] and 30 * -p <= 100 * -s[0] <= 90 * -p][:count]
            found += [(anchor, positive, k + 1, s[1], -p, -s[0]) for k, s in enumerate(fit)]
    return sorted(found)


def mined(df, scratch, **how):
    return sorted(tuple(r) for r in hard_negatives(df, scratch, **how).select(COLUMNS).collect())


def random_rows(count, width, labels, seed, step=100):
    rng = np.random.default_rng(seed)
    made = rng.normal(size=(count, width)).astype(np.float32)
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    return [(i * step // 4, [float(x) for x in v], int(rng.integers(labels))) for i, v in enumerate(made)]


@pytest.mark.parametrize("width, labels", [(3, 2), (33, 90)])
def test_equals_the_plain_version(spark, scratch, width, labels):
    rows = random_rows(240, width, labels, width)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert mined(df, scratch) == plain(rows)


def test_small_blocks_and_many_anchors(spark, scratch, monkeypatch):
    monkeypatch.setattr(negatives, "NUMBERS_IN_BLOCK", 64)
    monkeypatch.setattr(negatives, "ANCHORS_IN_BLOCK", 3)
    rows = random_rows(150, 5, 3, 7)
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(4), scratch) == plain(rows)


def test_copies_ties_and_repeated_rows(spark, scratch):
    same = [(i, [0.5, 0.5], i % 3) for i in range(0, 2000, 20)]
    again = [(0, [0.5, 0.5], 0), (100, [0.5, -0.25], 1), (100, [0.1, 0.9], 2)]
    rows = same + same[:7] + again + [(i, [0.2 + i / 999, 0.3], i % 2) for i in range(1, 40)]
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(5), scratch) == plain(rows)


def test_missing_values_short_vectors_and_zero_scores(spark, scratch):
    bad = [None, [0.5, None], [float("nan"), 1.0], [float("inf"), 0.0], []]
    rows = [(i * 50, v, i % 2) for i, v in enumerate(bad)] + [(None, [0.5, 0.5], 1), (300, [0.5, 0.5], None)]
    rows += [(400, [1.0], 0), (401, [0.5, 0.25, 4.0], 0), (402, [0.4, 3.0], 1), (403, [], 1), (500, [0.0, 1.0], 1)]
    rows += [(600, [-1.0, -1.0], 0), (700, [0.0], 3), (701, [0.0, 0.0], 3)]
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(3), scratch) == plain(rows)


def test_numbers_too_large_for_floating_point(spark, scratch):
    rows = [(i * 100, [float(2**20 * (i + 1)), float(3 + i), 2.0**18], i % 2) for i in range(9)]
    assert mined(spark.createDataFrame(rows, SCHEMA), scratch) == plain(rows)
    huge = [(i * 100, [3e38, 1.0 * i], i % 2) for i in range(4)]
    found = mined(spark.createDataFrame(huge, SCHEMA), scratch, window=(0, 100))
    assert found and {row[4] for row in found} == {2**63 - 1}


@pytest.mark.parametrize("rows", [[], [(1, [0.5], 0), (2, [0.5], 1)], [(100, [], 0), (2, [], 0), (3, [], 1)]])
def test_empty_table_no_anchor_no_component(spark, scratch, rows):
    assert mined(spark.createDataFrame(rows, SCHEMA), scratch) == plain(rows)


def test_clashing_names(spark, scratch):
    from pyspark.sql import functions as F

    rows = random_rows(40, 4, 2, 1)
    names = "key anchor place score rank id base norm asked vector anchor_id".split()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in names})
    assert mined(df, scratch) == plain(rows)


def test_threshold_join_omits_and_prunes_but_loses_nothing():
    rng = np.random.default_rng(3)
    weights = np.exp(-np.arange(40) / 6)
    rows = (rng.normal(size=(300, 40)) * weights * 100).astype(np.int64)
    anchors = (rng.normal(size=(17, 40)) * weights * 100).astype(np.int64)
    whole = rows @ anchors.T
    for share in (0.9, 0.5, 0.1, 0.0, -1.0):
        least = np.array([int(share * column.max()) for column in whole.T], dtype=object)
        at, anchor, score = at_least(rows, anchors, least)
        expected = whole >= least.astype(np.int64)
        assert sorted(zip(at, anchor, strict=True)) == list(zip(*np.nonzero(expected), strict=True))
        assert (score == whole[at, anchor]).all()
