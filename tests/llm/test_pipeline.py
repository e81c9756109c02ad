"""The corpus pipeline, stage by stage, against plain versions on the smallest tables."""

import re

import corpus_pipeline as P
from conftest import SMALL
from partyfold.llm.common import stored
from test_llm_small import plain_base, plain_components


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SMALL), name)
        kept[name] = (before, docs)
        if name != "byte_bpe":
            assert docs.columns == columns
    before, after = kept["language_id"]
    assert after.count() == before.filter("text rlike '[a-zA-Z]'").count()
    before, after = kept["jaccard_join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert {str(r.doc_id) for r in after.collect()} == {c for _, _, c in plain_components(rows, 5, 80, 100)}
    before, after = kept["secret_scan"]
    old, new = ({r.doc_id: r for r in x.collect()} for x in (before, after))
    assert old.keys() == new.keys()
    for k in old:
        assert (old[k].text == new[k].text) == (not plain_base(old[k].text))
        assert not plain_base(new[k].text) and new[k].n_chars == len(new[k].text)
    before, after = kept["source_mix"]
    words = lambda df: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in df.collect())
    assert abs(words(after) / words(before) - 1.5) < 0.1
    assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
    before, after = kept["byte_bpe"]
    assert after.count() == before.count() and after.filter("not round_trip or n_tokens = 0").count() == 0


def test_run(spark):
    out = P.run(spark, SMALL)
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "round_trip"] and out.count() > 0
    assert P.ORACLE_SQL is None
