"""Every stage against a plain version, each on its own input, over a whole test folder."""

import corpus_pipeline
from fieldmart.llm import toxicity
from fieldmart.llm.catalog import table
from fieldmart.llm.common import Scratch

from .helpers import grams, hit_words
from .test_minhash import brute as components
from .test_packing import checked


def test_stages(spark, sf_dir):
    scratch = Scratch(spark, "test")
    docs = table(spark, sf_dir, "documents").select(corpus_pipeline.COLUMNS)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = scratch.pin(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if name == "packing":
            checked(before, after, 1024)
            break
        assert after.columns == corpus_pipeline.COLUMNS
        rows = {tuple(r) for r in docs.collect()}
        assert {tuple(r) for r in after.collect()} <= rows
        seen[name] = (before, sorted(r.doc_id for r in after.collect()))
        docs = after
    source = table(spark, sf_dir, "documents")
    scored = toxicity.score(source, toxicity.train(source, table(spark, sf_dir, "labels"))).collect()
    assert seen["toxicity"][1] == sorted(r.doc_id for r in scored if not r.predicted)
    before, after = seen["exact dedup"]
    assert after == sorted({text: doc_id for doc_id, text in sorted(before)}.values())
    before, after = seen["near dedup"]
    assert after == sorted(doc_id for doc_id, _, _, kept in components(before) if kept)
    before, after = seen["decontamination"]
    windows = {w for r in table(spark, sf_dir, "benchmark").collect() for w in grams(r.text)[1]}
    assert after == sorted(i for i, text in before if not hit_words(grams(text)[0], windows))
    scratch.drop()


def test_run_is_the_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns)
    assert out.count() > 0
