"""The pipeline on the smallest tables, stage by stage."""

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fragloom.llm import neardup, queries
from fragloom.llm.common import materialize

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        kept[name] = docs
        if name != "sharding":
            assert docs.columns == columns
    texts = {r["doc_id"]: r["text"] for r in kept["language_id"].collect()}
    assert len(texts) == 200  # all are in some language
    components = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(kept["language_id"]).collect()}
    assert {r["doc_id"] for r in kept["near_dedup"].collect()} == set(components.values())
    norm = lambda t: " " + " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))) + " "
    items = [norm(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in kept["near_dedup"].collect() if not any(i in norm(r["text"]) for i in items)}
    assert {r["doc_id"] for r in kept["decontamination"].collect()} == clean
    repeats = [r["count"] for r in kept["mixing"].groupBy("doc_id").count().collect()]
    assert max(repeats) <= 3 and kept["sharding"].count() == sum(repeats)
    sizes = [r["count"] for r in kept["sharding"].groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_run_and_names(spark):
    assert set(corpus_pipeline.run(spark, SF).columns) == {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"}
    names = list(queries.queries())
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14))


def test_chat_matches_its_sql(spark):
    import duckdb

    c = duckdb.connect()
    c.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    got = sorted(tuple(r) for r in queries.queries()["op2_chat"](spark, SF).select(*names).collect())
    assert got == sorted(c.sql(f"SELECT {', '.join(names)} FROM ({queries.oracle_sql()['op2_chat']})").fetchall())


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_collocations", "op13_warc"])
def test_new_operators_match_their_sql(spark, name):
    import duckdb

    c, sf = duckdb.connect(), SF.replace("0.001", "0.01")
    for t in ("conversations", "documents", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = queries.queries()[name](spark, sf)
    want = c.sql(queries.oracle_sql()[name])
    assert sorted(found.columns) == sorted(want.columns)
    assert sorted(map(repr, (tuple(r) for r in found.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_first_document_follows_the_last(spark):
    rows = queries.queries()["op5_fingerprint"](spark, SF).agg(F.count("*").alias("n"), F.count_if(F.col("near_edited") > F.col("near_next")).alias("nearer")).first()
    assert rows["n"] == 200 and rows["nearer"] > 190
