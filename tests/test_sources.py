"""Readers of external sets, layouts of former versions, and accounts of articles: each with malformed rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fragloom.functions import text, urls
from fragloom.functions.shipping import ship
from fragloom.operators import audit, export, publish
from fragloom.sources import metadata as sources
from fragloom.sources import minutes


def test_country_lists_and_code_tables(spark, tmp_path):
    (tmp_path / "list").write_text("A.com\tFR\tFrance\nb.org\tGM\tGermany\na.com\tUS\tUnited States\nc.net\tfr\tlower\nd.net\tFR\tRépublique\n")
    domains, names = sources.country_lookup(spark, str(tmp_path / "list"))
    assert {r["domain"]: r["codes"] for r in domains.collect()} == {"a.com": ["FR", "US"], "b.org": ["GM"], "d.net": ["FR"]}
    assert {r["code"]: r["name"] for r in names.collect()} == {"FR": "France", "GM": "Germany", "US": "United States"}
    (tmp_path / "bad").write_text("a.com\tFR\n")
    with pytest.raises(Exception, match="three columns"):
        sources.country_lookup(spark, str(tmp_path / "bad"))[0].collect()
    (tmp_path / "iso.json").write_text('{"GM": "DE", "XX": "YY"}')
    assert sources.code_table(spark, str(tmp_path / "iso.json"), {"FR": "FR", "XX": "ZZ"}) == {"FR": "FR", "GM": "DE", "XX": "YY"}


def test_suffix_lists_are_read_and_shown(spark, tmp_path):
    (tmp_path / "suffixes").write_text("// comment\n\ncom\nco.uk // private\n*.ck\n!www.ck\n")
    rules = urls.read_suffixes(spark, str(tmp_path / "suffixes"))
    assert [rules.registrable(h) for h in ("a.b.com", "x.co.uk", "q.www.ck", "a.b.ck")] == ["b.com", "x.co.uk", "www.ck", "a.b.ck"]
    assert {(r["rule"], r["kind"]) for r in urls.suffix_table(spark, rules).collect()} == {("com", "exact"), ("co.uk", "exact"), ("ck", "wildcard"), ("www.ck", "exception")}


def test_json_sets_skip_and_count_what_is_malformed(spark, tmp_path):
    ship(spark)
    (tmp_path / "pages").write_text('{"url":"u1","title":"T"}\n{"url":\n[1]\n\n{"title":"no url"}\nnull\n{"url":"u2","title":7,"more":{}}\n')
    rows = sources.json_rows(spark, str(tmp_path / "pages"), sources.PAGE)
    (stats,) = sources.json_stats(rows).collect()
    assert (stats["rows"], rows.where("r.url is not null").count()) == (7, 2) and 2 <= stats["malformed_rows"] <= 4
    assert [(r["url"], r["line_no"], r["title"]) for r in sources.page_records(spark, str(tmp_path / "pages")).orderBy("line_no").collect()] == [("u1", 1, "T"), ("u2", 7, "7")]
    (tmp_path / "tags").write_text('{"url":"u","title":"","date":"20250316001500","metatags":[{"key":"og:title","value":"O"},{"key":"datepublished","value":"2025-03-16"}]}\n{"url":"v","metatags":"none"}\n')
    tags = {r["url"]: r for r in sources.tag_records(spark, str(tmp_path / "tags")).collect()}
    assert tags["u"]["title"] == "O" and tags["u"]["published"]["field"] == "datepublished"
    (tmp_path / "places").write_text('{"URL":"http://A.de/x","DateTime":"20250316001500","DomainCountryCode":"gm","CountryCode":"FR"}\n{"URL":"http://b.de/","DateTime":"never","DomainCountryCode":"QQ"}\nbroken\n')
    places = sources.place_records(spark, str(tmp_path / "places"), F.create_map(F.lit("GM"), F.lit("DE"))).orderBy("url").collect()
    assert [(r["host"], r["domain_code"], r["place_code"], r["seen_at"]) for r in places] == [("a.de", "GM", "FR", datetime(2025, 3, 16, 0, 15)), ("b.de", None, None, None)]


def test_minutes_in_words_and_raw_files_that_went_stale(spark, tmp_path):
    rows = spark.createDataFrame([("20250316000100",), ("2025-03-16T01:01:00+01:00",), ("soon",), (None,)], "t string")
    assert [r[0] for r in rows.select(minutes.stamp(minutes.parse_minute(F.col("t")))).collect()] == ["20250316000100", "20250316000100", None, None]
    for name in ("a", "b"):
        (tmp_path / name).write_text(name)
    found = minutes.digests(spark, str(tmp_path))
    manifest = found.unionByName(found.limit(1).withColumn("sha256", F.lit("other"))).unionByName(found.limit(1).withColumn("path", F.lit("gone")))
    assert sorted((r["path"] == "gone", r["sha256"] == "other") for r in minutes.stale_raw(manifest, found).collect()) == [(False, True), (True, False)]
    assert spark.range(1).select(text.portable_path(F.lit("raw\\2025\\a.json"))).first()[0] == "raw/2025/a.json"


def _enriched(spark):
    rows = spark.createDataFrame([(1, "d", "en", "https://x.org/1", "text", 3)], "type int, observed_at string, lang string, url string, text string, fragments long")
    rows = export.numbered(rows.selectExpr("*", "fragments as primary_fragments", "'connected' as assembly", "0L as position_joins", "false as bounded_fallback", "'none' as search"), [])
    return rows.withColumn("metadata", F.struct(F.struct(F.lit("FR").alias("iso2")).alias("source_country"), F.lit("T").alias("title")))


def test_flat_rows_of_former_versions_are_upgraded(spark):
    flat = publish.legacy(_enriched(spark), F.lit("20250316000100"), F.lit("ab" * 32))
    (old,) = flat.collect()
    assert old["source_country"] == "FR" and '"title":"T"' in old["metadata_json"] and len(old["observation_id"]) == 64
    (new,) = publish.upgrade_flat(flat).collect()
    (direct,) = publish.compact(_enriched(spark), F.lit("20250316000100"), F.lit("ab" * 32)).collect()
    assert new == direct and new["observation_id"] != old["observation_id"] and new["metadata"]["source_minute"] == "20250316000100"


def test_accounts_of_articles(spark):
    rows = spark.createDataFrame([("u1", "all ``` of it", []), ("u2", "some", [(10, "left over")])], "url string, text string, unmerged array<struct<pos:int,text:string>>")
    assert [r["url"] for r in export.problems(rows).collect()] == ["u2"]
    told = {r["url"]: r["markdown"] for r in export.readable(rows).collect()}
    assert told["u1"].startswith("# u1\n\n````text\nall ``` of it") and "10: left over" in told["u2"] and "left over" not in told["u1"]
    runs = spark.createDataFrame([(1, 2.0), (2, 9.0), (3, 9.0), (4, None)], "id int, seconds double")
    assert [r["id"] for r in audit.slowest(runs, 2, order=["id"]).collect()] == [3, 2]
