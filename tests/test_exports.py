"""Exports of JSON lines: order, header, report, refusal to overwrite, nothing after a failure, and nothing read that is not as it was written."""

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from fragloom.operators import enrich, export
from fragloom.sources import exports

META = {"schema": "observations", "profile": "é"}


def _observations(spark, n=60):
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 2).otherwise(1).cast("smallint").alias("type"), F.lit("en").alias("lang"), F.concat(F.lit("https://x.org/"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("url"), F.lit("d").alias("observed_at"),
        F.col("id").alias("fragments"), F.col("id").alias("primary_fragments"), F.lit("connected").alias("assembly"), F.lit(0).cast("long").alias("position_joins"), F.lit(False).alias("bounded_fallback"),
        F.when(F.col("id") == 5, None).otherwise("not_applicable").alias("search"), F.concat(F.lit('line\n"two" \\ é  '), F.col("id").cast("string")).alias("text"),
    )
    return export.numbered(rows.repartition(4), [])


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_export_is_ordered_and_reported(spark, tmp_path, compression):
    rows, path = _observations(spark), tmp_path / "out"
    report = exports.write_observations(rows, str(path), META, compression=compression)
    assert report["rows"] == 60 and report["meta"] == META and exports.report(str(path)) == report
    lines = []
    for f in report["files"]:
        raw = (path / f["name"]).read_bytes()
        assert (len(raw), hashlib.sha256(raw).hexdigest()) == (f["bytes"], f["sha256"])
        own = (gzip.decompress(raw) if compression == "gzip" else raw).decode().split("\n")
        assert json.loads(own[0]) == {"meta": META} and own[-1] == "" and len(own) == f["rows"] + 2
        lines += own[1:-1]
    assert [json.loads(x)["id"] for x in lines] == list(range(1, 61)) and list(json.loads(lines[0])) == export.COLUMNS
    head, back = exports.read_observations(spark, str(path))
    assert {json.loads(r["meta"])["profile"] for r in head.collect()} == {"é"}
    plain = lambda df: sorted(tuple(r) for r in df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in export.COLUMNS]).collect())
    assert plain(back) == plain(rows)
    assert {x.name for x in path.iterdir() if not x.name.startswith(".")} == {"report.json", *(f["name"] for f in report["files"])}
    with pytest.raises(Exception, match="exists"):
        exports.write_observations(rows, str(path), META)
    assert exports.report(str(path)) == report


def test_nothing_stays_after_a_failed_task(spark, tmp_path):
    bad = _observations(spark).withColumn("text", F.when(F.col("id") == 41, F.raise_error(F.lit("boom")).cast("string")).otherwise(F.col("text")))
    with pytest.raises(Exception, match="boom"):
        exports.write_observations(bad, str(tmp_path / "out"), META)
    assert not list(tmp_path.rglob("part-*")) and not (tmp_path / "out" / "report.json").exists()
    assert exports.write_observations(_observations(spark, 3), str(tmp_path / "again"), META)["rows"] == 3


def test_an_empty_export_is_a_header(spark, tmp_path):
    report = exports.write_observations(_observations(spark, 0), str(tmp_path / "out"), META)
    assert report["rows"] == 0 and len(report["files"]) <= 1


def test_what_differs_from_the_report_is_not_read(spark, tmp_path):
    path = tmp_path / "out"
    report = exports.write_observations(_observations(spark), str(path), META, compression="none")
    part = path / report["files"][0]["name"]
    part.write_bytes(part.read_bytes().replace(b"connected", b"estimated", 1))
    with pytest.raises(exports.Spoilt, match=part.name):
        exports.read_observations(spark, str(path))


def test_an_export_that_changes_observations_is_removed(spark, tmp_path):
    rows = _observations(spark)
    exports.write_lines(rows.withColumn("text", F.upper("text")), str(tmp_path / "out"), ["id"], META)
    with pytest.raises(exports.Spoilt, match="unchanged"):
        exports.changed(rows, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_enriched_observations_keep_their_own_columns(spark, tmp_path):
    rows = _observations(spark, 9).withColumn("metadata", F.struct(F.col("url").alias("source_domain"), F.lit(None).cast("string").alias("title"), F.array(F.lit("a")).alias("places")))
    exports.write_observations(rows, str(tmp_path / "out"), META)
    _, back = exports.read_observations(spark, str(tmp_path / "out"), "metadata struct<source_domain:string,title:string,places:array<string>>")
    assert sorted(map(str, back.select("id", "metadata").collect())) == sorted(map(str, rows.select("id", "metadata").collect()))
    assert enrich.WITHIN == 3600


def test_articles_are_bound_to_their_manifests(spark, tmp_path):
    schema = "url string, date string, language string, segmentation_type int, algorithm string, raw_path string, raw_sha256 string, text string"
    def write(name, rows):
        df = spark.createDataFrame(rows, schema.replace("language", "lang").replace("segmentation_type", "type"))
        exports.write_articles(df, str(tmp_path / name), META)
        return exports.read_articles(spark, str(tmp_path / name), manifests, schema)

    manifests = spark.createDataFrame([("raw/a", "1"), ("raw/b", "2")], "raw_path string, raw_sha256 string")
    good = [("u2", "d", "en", 1, "w", "raw/a", "1", "x"), ("u1", "d", "en", 1, "w", "raw/b", "2", "y")]
    assert [r["url"] for r in write("good", good).orderBy("file", "line_no").collect()] == ["u1", "u2"]
    for name, row, message in [("sha", ("u3", "d", "en", 1, "w", "raw/a", "2", "z"), "vouches"), ("twice", good[0], "2 times"), ("mixed", ("u4", "d", "en", 1, "v", "raw/a", "1", "z"), "algorithms")]:
        with pytest.raises(exports.Spoilt, match=message):
            write(name, [*good, row])
