"""Minute files of JSON lines: scan with line numbers, strict parsing, calendar, verification of the raw store."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fragloom.functions.rows import once

STRINGS, BYTES = ("date", "url", "lang", "pre", "ngram", "post"), ("type", "pos")
FIRST_MINUTE = "20200101000000"


def numbered_lines(lines: DataFrame) -> DataFrame:
    """lines with line_no, from 1, in each file. lines: file, _block (where the split begins), _id (monotonically_increasing_id over the scan), and more.

    Rows of a split follow each other in a task, so a line's number is its id
    less the split's first one, plus the lines of the splits before: one row a
    split is aggregated and sent to all, and no line is sorted or sent to another task.
    """
    blocks = lines.groupBy("file", "_block").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    shift = blocks.select("file", "_block", (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return lines.join(F.broadcast(shift), ["file", "_block"]).withColumn("line_no", F.col("_id") + F.col("_shift")).drop("_block", "_id", "_shift")


def scanned(lines: DataFrame) -> DataFrame:
    """file, _block, _id, value of a text scan, as numbered_lines takes them."""
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), "value")


def read_minutes(spark: SparkSession, *path: str, number: bool = True) -> DataFrame:
    """file, line_no (from 1, blank lines too), value of every line of .json and .json.gz files: those named, or all right in a folder.

    Multi-member gzip files are read whole; a truncated one fails the job. An
    empty folder is an error. number=False leaves line_no out, and with it the
    second scan that counts the lines of splits.
    """
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.json*").text(list(path))
    if not lines.inputFiles():
        raise FileNotFoundError(f"no .json or .json.gz file in {', '.join(path)}")
    if not number:
        return lines.select(F.col("_metadata.file_path").alias("file"), "value")
    return numbered_lines(scanned(lines)).select("file", "line_no", "value")


def source_minute(file: Column) -> Column:
    """The 14 digits of a minute file's name; without them, those of its folder, where that is named minute=..."""
    own = F.nullif(F.regexp_extract(file, r"(\d{14})[^/]*$", 1), F.lit(""))
    return F.coalesce(own, F.regexp_extract(file, r"/minute=(\d{14})/[^/]*$", 1))


def blank(value: Column) -> Column:
    """Nothing but space, tab, line feed, form feed and carriage return; a line with any other white space is a record, and an invalid one."""
    return value.rlike(r"^[ \t\n\r\f]*\z")


def parse_records(lines: DataFrame) -> DataFrame:
    """lines with `record` (null unless the line is exactly one valid record) and `blank`.

    All eight fields must be there with their JSON types, type and pos as whole
    numbers from 0 to 255; repeated keys, trailing text and invalid UTF-8 are
    refused; other fields are ignored.
    """
    # one walk over the object; then each field is at hand, whatever its type. Parsing ends with the first value, so the line's length after it tells that nothing was left out
    fields = ", ".join(f"{name}: variant" for name in (*STRINGS, *BYTES))
    parsed = once(lines, "_v", F.expr(f"""try_variant_get(try_parse_json(concat('[', value, ',{{"pos":', length(value), '}}]')), '$', 'array<struct<{fields}>>')"""))
    parsed = parsed.withColumn("_o", F.when((F.size("_v") == 2) & (F.expr("try_variant_get(_v[1].pos, '$', 'bigint')") == F.length("value")), F.get("_v", F.lit(0))))
    kind = lambda name: F.expr(f"schema_of_variant(_o.{name})")
    number = lambda name: F.expr(f"try_variant_get(_o.{name}, '$', 'bigint')")
    valid = F.expr("is_valid_utf8(value)")
    for name in STRINGS:
        valid &= kind(name) == "STRING"
    for name in BYTES:
        valid &= (kind(name) == "BIGINT") & number(name).between(0, 255)
    text = lambda name: F.expr(f"try_variant_get(_o.{name}, '$', 'string')").alias(name)
    record = F.struct(*[text(n) for n in ("date", "url", "lang")], *[number(n).cast("smallint").alias(n) for n in BYTES], *[text(n) for n in ("pre", "ngram", "post")])
    return once(parsed.withColumn("blank", blank(F.col("value"))), "record", F.when(F.coalesce(valid, F.lit(False)), record)).drop("_v", "_o")


def require_valid(parsed: DataFrame) -> DataFrame:
    """The non-blank rows; the first invalid line met fails the job with its file and number."""
    where = F.concat(F.lit("invalid record in "), F.col("file"), F.lit(" line "), F.col("line_no").cast("string"))
    checked = F.when(F.col("record").isNull(), F.raise_error(where).cast("boolean")).otherwise(True)
    return parsed.where(~F.col("blank")).where(checked)


def parse_minute(text: Column) -> Column:
    """Timestamp of 14 digits or of an ISO time with zone; null for others."""
    digits = F.when(text.rlike(r"^\d{14}$"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))
    return F.coalesce(digits, F.try_to_timestamp(text))


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss")


def shift_minutes(minute: Column, by: int) -> Column:
    """The 14 digits of so many minutes later: successor with 1, predecessor with -1."""
    return stamp(F.to_timestamp(minute, "yyyyMMddHHmmss") + F.make_interval(mins=F.lit(by)))


def minute_calendar(spark: SparkSession, start: str, end: str, now: str | None = None) -> DataFrame:
    """All whole minutes from start to end, both included; neither before 2020 nor after now."""
    for x in (start, end):
        if len(x) != 14 or not x.isdigit() or x[12:] != "00" or x < FIRST_MINUTE:
            raise ValueError(f"{x} is not a whole minute at or after {FIRST_MINUTE}")
    if start > end or (now and end > now):
        raise ValueError("the range is empty or reaches into the future")
    ends = [F.to_timestamp(F.lit(x), "yyyyMMddHHmmss") for x in (start, end)]
    return spark.range(1).select(F.explode(F.sequence(*ends, F.expr("interval 1 minute"))).alias("ts")).select(stamp(F.col("ts")).alias("minute"), "ts")


def missing_minutes(calendar: DataFrame, present: DataFrame) -> DataFrame:
    """Minutes of the calendar that have no source."""
    return calendar.join(present.select("minute").distinct(), "minute", "left_anti")


def files_between(spark: SparkSession, folder: str, start: str, end: str) -> dict[str, str]:
    """Minute and path of the minute files of a range, by name only: in the folder itself and in its day folders YYYY/MM/DD.

    Of the day folders only those of the range are listed, so the listing is
    bounded by the range and not by all that was ever collected.
    """
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    first, last = (datetime.strptime(x[:8], "%Y%m%d") for x in (start, end))
    days = [f"{folder.rstrip('/')}/{first + timedelta(days=k):%Y/%m/%d}" for k in range((last - first).days + 1)]
    found = {}
    for place in [folder, *days]:
        path = jvm.org.apache.hadoop.fs.Path(place)
        files = path.getFileSystem(hadoop)
        if place == folder or files.exists(path):
            for p in (s.getPath() for s in files.listStatus(path) if s.isFile()):
                if m := re.match(r"(\d{14})[^/]*\.json(\.gz)?$", p.getName()):
                    found.setdefault(m[1], str(p.toString()))
    return {m: p for m, p in found.items() if start <= m <= end}


def digests(spark: SparkSession, *path: str) -> DataFrame:
    """path, bytes and sha256 of files, or of every file of a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(path))
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def stale_raw(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Entries of the raw manifest (path, bytes, sha256) whose file is absent or differs: to be fetched again."""
    return manifest.join(found, ["path", "bytes", "sha256"], "left_anti")
