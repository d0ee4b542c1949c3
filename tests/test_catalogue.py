"""Every query with SQL against DuckDB, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from fragloom.plans import catalogue, fixtures
from fragloom.settings import Settings

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(rows):
    return sorted(tuple("" if v is None else f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    names = sorted(df.columns)
    relation = duck.sql(entry.oracle_sql()[name])
    assert sorted(relation.columns) == names
    got = plain([tuple(r[c] for c in names) for r in df.collect()])
    at = [relation.columns.index(c) for c in names]
    assert got == plain([tuple(r[i] for i in at) for r in relation.fetchall()])


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 200


def test_kind_2_queries_search_with_the_default_budget(spark, tmp_path):
    """Branching documents take more than a few hundred steps, which only a cut budget would hide."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.where("n_chars BETWEEN 600 AND 2500").write.parquet(f"{tmp_path}/documents.parquet")
    steps = [r["search_steps"] for r in entry.queries()["type2_articles"](spark, str(tmp_path)).collect()]
    assert 200 < max(steps) <= Settings().type2_search_budget == catalogue.TYPE2.type2_search_budget


def test_kind_2_fragments_are_one_window_per_grapheme(spark, tmp_path):
    text = "".join(chr(0x61 + i % 26) for i in range(40)) + "e\u0301\U0001f600"
    spark.createDataFrame([(7, text, "en", "s")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    units = [*text[:40], "e\u0301", "\U0001f600"]
    got = sorted((r["line_no"], r["pos"], r["text"]) for r in fixtures.cluster_fragments(spark, str(tmp_path)).collect())
    assert got == [(i, i * 10 // 42 * 10, "".join(units[max(0, i - 6) : i + 7])) for i in range(42)]
