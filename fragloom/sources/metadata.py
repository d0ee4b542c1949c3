"""Readers of the external metadata sets, and the plan of what to fetch for a minute."""

from __future__ import annotations

import io
import zipfile
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fragloom.functions.metadata import parse_graph, parse_page, parse_tags, timestamp
from fragloom.functions.shipping import ship
from fragloom.functions.urls import idna_host
from fragloom.sources.minutes import numbered_lines, scanned

PAGE = "url string, title string, desc string, outletName string, domain string, author string, lang string, date string"
TAGS = "url string, title string, lang string, date string, metatags array<struct<key:string,value:string>>"
PLACES = "URL string, DateTime string, DomainCountryCode string, CountryCode string"
FIELDS = 27
#: Bytes of one unpacked archive entry, and of one line.
MAX_EXPANDED, MAX_LINE = 512 << 20, 8 << 20


def with_header(spark: SparkSession, path: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """Lines of files whose first line is a header object: the headers and the rows."""
    lines = numbered_lines(scanned(spark.read.text(path)))
    head = lines.where("line_no = 1").select("file", F.get_json_object("value", "$.meta").alias("meta"))
    rows = lines.where("line_no > 1").select("file", "line_no", F.from_json("value", schema).alias("r")).select("file", "line_no", "r.*")
    return head, rows


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """file, line_no, r (null where the line can't be parsed) of JSON lines; malformed lines are counted, not fatal."""
    lines = numbered_lines(scanned(spark.read.text(path)))
    parsed = F.when(F.expr("try_parse_json(value)").isNotNull() & (F.octet_length("value") <= MAX_LINE), F.from_json("value", schema))
    return lines.select("file", "line_no", parsed.alias("r"))


def json_stats(rows: DataFrame) -> DataFrame:
    """rows and malformed_rows of JSON lines as json_rows gives them, by file."""
    return rows.groupBy("file").agg(F.count("*").alias("rows"), F.count_if(F.col("r").isNull()).alias("malformed_rows"))


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """url, line_no and the fields of page records."""
    ship(spark)
    rows = json_rows(spark, path, PAGE).where(F.col("r.url").isNotNull())
    return rows.select(F.col("r.url").alias("url"), "file", "line_no", parse_page(F.col("r")).alias("p")).select("url", "file", "line_no", "p.*")


def tag_records(spark: SparkSession, path: str) -> DataFrame:
    """url, line_no and the fields of tag records."""
    ship(spark)
    rows = json_rows(spark, path, TAGS).where(F.col("r.url").isNotNull())
    return rows.select(F.col("r.url").alias("url"), "file", "line_no", parse_tags(F.col("r")).alias("p")).select("url", "file", "line_no", "p.*")


def place_records(spark: SparkSession, path: str, iso: Column) -> DataFrame:
    """url, host, seen_at, domain_code (only codes that have an ISO counterpart), place_code."""
    ship(spark)
    r = json_rows(spark, path, PLACES).where(F.col("r.URL").isNotNull())
    code = F.upper("r.DomainCountryCode")
    return r.select(
        F.col("r.URL").alias("url"), idna_host(F.col("r.URL")).alias("host"), timestamp(F.col("r.DateTime")).alias("seen_at"),
        F.when(F.element_at(iso, code).isNotNull(), code).alias("domain_code"), F.col("r.CountryCode").alias("place_code"),
    )


def graph_lines(spark: SparkSession, path: str) -> DataFrame:
    """source, value, replaced of zip archives with exactly one entry of tab-separated lines.

    Bytes that are no UTF-8 are replaced and the line says so. An archive is one
    task's work; it is read by line, not unpacked whole.
    """
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def lines(batches):
        import pandas as pd

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    if len(z.infolist()) != 1 or z.infolist()[0].file_size > MAX_EXPANDED:
                        raise ValueError(f"{name} has more than one entry or is too large")
                    block = []
                    with z.open(z.infolist()[0]) as stream:
                        for raw in stream:
                            if len(raw) > MAX_LINE:
                                raise ValueError(f"{name} has a line that is too long")
                            try:
                                text, replaced = raw.decode(), False
                            except UnicodeDecodeError:
                                text, replaced = raw.decode("utf-8", "replace"), True
                            block.append((name, text.rstrip("\r\n"), replaced))
                            if len(block) == 4096:
                                yield pd.DataFrame(block, columns=["source", "value", "replaced"])
                                block = []
                    yield pd.DataFrame(block, columns=["source", "value", "replaced"])

    return files.mapInPandas(lines, "source string, value string, replaced boolean")


def graph_records(lines: DataFrame, iso: Column) -> DataFrame:
    """source, replaced and the fields of records with exactly 27 fields of the web kind."""
    ship(lines.sparkSession)
    fields = lines.select("source", "replaced", F.split("value", "\t", -1).alias("f")).where(F.size("f") == FIELDS)
    parsed = fields.select("source", "replaced", parse_graph(F.col("f"), iso).alias("g"))
    return parsed.where("g is not null").select("source", "replaced", "g.*")


def dataset_stats(lines: DataFrame, matched: DataFrame) -> DataFrame:
    """rows, malformed (another number of fields, or a web record without a time), utf8_replacement by source, with the matched ones."""
    f = F.split("value", "\t", -1)
    malformed = (F.size(f) != FIELDS) | ((F.get(f, F.lit(2)) == "1") & timestamp(F.get(f, F.lit(1))).isNull())
    base = lines.groupBy("source").agg(F.count("*").alias("rows"), F.count_if(malformed).alias("malformed_rows"), F.count_if("replaced").alias("utf8_replacement_rows"))
    hits = matched.groupBy("source").agg(F.count("*").alias("matched_rows"))
    return base.join(hits, "source", "left").fillna(0, ["matched_rows"])


def country_lookup(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """domain, codes (sorted set), and code, name (the first in the file) of a three-column list."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i"))
    rows = lines.select(F.split("value", "\t", -1).alias("f"), "_b", "_i")
    rows = rows.where(F.when(F.size("f") == 3, True).otherwise(F.raise_error(F.lit("a lookup row must have three columns")).cast("boolean")))
    rows = rows.select(F.lower(F.col("f")[0]).alias("domain"), F.col("f")[1].alias("code"), F.col("f")[2].alias("name"), "_b", "_i").where(F.col("code").rlike("^[A-Z]{2}$"))
    domains = rows.groupBy("domain").agg(F.sort_array(F.collect_set("code")).alias("codes"))
    names = rows.groupBy("code").agg(F.min_by("name", F.struct("_b", "_i")).alias("name"))
    return domains, names


def code_table(spark: SparkSession, path: str, inline: dict[str, str] | None = None) -> dict[str, str]:
    """Country codes to ISO ones: inline pairs, overridden by a JSON object in a file; a bounded table of some 250 entries."""
    row = spark.read.option("wholetext", "true").text(path).select(F.from_json("value", "map<string,string>").alias("m")).first()
    return {**(inline or {}), **(row["m"] or {})}


def fetch_plan(minute: str, base: str) -> list[tuple[str, str]]:
    """What belongs to a minute: (dataset, URL) of pages and tags of the minute, places of the day, and the graph's drops around it."""
    at = datetime.strptime(minute, "%Y%m%d%H%M%S")
    quarter = at.replace(minute=at.minute // 15 * 15, second=0)
    plan = [("lookup", f"{base}/lookup/domains.txt"), ("suffixes", f"{base}/lookup/suffixes.dat"), ("pages", f"{base}/pages/{minute}.pages.json.gz"), ("tags", f"{base}/tags/{minute}.tags.json.gz"), ("places", f"{base}/places/{minute[:8]}.places.json.gz")]
    for k in range(3):
        stamp = (quarter + timedelta(minutes=15 * k)).strftime("%Y%m%d%H%M%S")
        plan += [("graph", f"{base}/graph/{stamp}{part}.csv.zip") for part in (".", ".translation.")]
    return [(name, url.replace("..", ".")) for name, url in plan]


def fetch_plans(minutes: DataFrame, base: str) -> DataFrame:
    """fetch_plan for a column of minutes, natively: minute, dataset, stamp, translated."""
    ts = F.to_timestamp("minute", "yyyyMMddHHmmss")
    quarter = F.date_trunc("hour", ts) + F.make_interval(mins=(F.floor(F.minute(ts) / 15) * 15).cast("int"))
    stamp = lambda t: F.date_format(t, "yyyyMMddHHmmss")
    row = lambda name, s, translated=False: F.struct(F.lit(name).alias("dataset"), s.alias("stamp"), F.lit(translated).alias("translated"))
    graph = [row("graph", stamp(quarter + F.make_interval(mins=F.lit(15 * k))), t) for k in range(3) for t in (False, True)]
    whole = F.array(row("pages", F.col("minute")), row("tags", F.col("minute")), row("places", F.substring("minute", 1, 8)), *graph)
    return minutes.select("minute", F.explode(whole).alias("_p")).select("minute", "_p.*")
