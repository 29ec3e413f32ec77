"""The pipeline's stages, each against a plain version on its own input."""
import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute
import corpus_pipeline as p
from paylake.llm import quality
from paylake.llm.common import documents, settle

SF_SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = documents(spark, SF_SMALL)
    names, stages = zip(*p.STAGES)
    good = settle(stages[0](spark, docs, SF_SMALL), "good")
    want = {r.doc_id for r in quality.measure(docs).select("_row.doc_id", "_q.kept").collect() if r.kept}
    assert {r.doc_id for r in good.collect()} == want and good.columns == docs.columns

    one = settle(stages[1](spark, good, SF_SMALL), "one")
    rows = sorted((r.doc_id, r.text) for r in good.collect())
    part = brute.groups([brute.fingerprint(t) for _, t in rows], 3)
    first = {}
    for (k, _), g in zip(rows, part):
        first.setdefault(g, k)
    assert sorted(r.doc_id for r in one.collect()) == sorted(first.values()) and one.columns == docs.columns

    clean = settle(stages[2](spark, one, SF_SMALL), "clean")
    text = {r.doc_id: r.text for r in clean.collect()}
    before = {r.doc_id: r.text for r in one.collect()}
    assert text.keys() == before.keys() and clean.columns == docs.columns
    for k, t in before.items():
        spans = brute.base_spans(t)
        assert ("[SECRET]" in text[k]) >= bool(spans)
        for s in filter(None, spans.split(",")):
            _, a, b = s.split(":")
            assert t[int(a):int(b)] not in text[k]

    mix = settle(stages[3](spark, clean, SF_SMALL), "mix")
    assert mix.columns == docs.columns
    copies = Counter(r.doc_id for r in mix.collect())
    assert max(copies.values()) <= 3 and copies.keys() <= text.keys()

    out = stages[4](spark, mix, SF_SMALL)
    from tokenizers import Tokenizer
    from paylake.llm.bpe_trie import default_path
    t = Tokenizer.from_file(default_path())
    ids = {k: t.encode(v, add_special_tokens=False).ids for k, v in text.items() if k in copies}
    got = out.collect()
    assert Counter(r.doc_id for r in got) == copies
    assert all(r.token_ids == ids[r.doc_id] for r in got)


def test_empty_table(spark):
    docs = documents(spark, SF_SMALL).limit(0)
    for _, stage in p.STAGES:
        docs = settle(stage(spark, docs, SF_SMALL), "none")
        assert docs.count() == 0
