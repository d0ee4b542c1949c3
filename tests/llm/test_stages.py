"""Every stage of the pipeline on odd rows: nulls in any column, empty and long texts, repeated rows, clashing names, and none at all."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fragloom.llm.common import materialize
from tests.llm.conftest import add_clashing

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
OWN = ["_id", "_kept", "_row", "_key", "_source", "kept", "component_id", "n_shingles"]


def test_stages_take_odd_rows(spark, corpus):
    docs = add_clashing(corpus).withColumns({n: F.lit(f"own {n}") for n in OWN})
    before, kept = corpus.count(), {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), name)
        rows = [r.asDict() for r in out.collect()]
        if name != "sharding":
            assert out.columns == docs.columns, name
        assert all(r[n] == f"own {n}" for r in rows for n in OWN), name
        if name not in ("mixing", "sharding"):
            assert 0 < len(rows) <= before
        before, kept[name], docs = len(rows), rows, out
    assert all(any(c.isalpha() for c in r["text"] or "") for r in kept["language_id"]) and any(r["doc_id"] is None for r in kept["language_id"])
    texts = [r["text"] for r in kept["near_dedup"]]
    assert len(set(texts)) == len(texts)  # no exact copies are left, repeated rows neither
    assert max(len(t) for t in texts) > 100_000
    slots = {(r["shard"], r["slot"]) for r in kept["sharding"]}
    assert len(slots) == len(kept["sharding"]) == len(kept["mixing"])


def test_stages_take_no_rows(spark, empty):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.count() == 0, name
