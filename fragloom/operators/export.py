"""Articles to observations, their dictionary-coded form, and the export's report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fragloom.functions.shipping import ship
from fragloom.operators.assemble import assemble_body_column
from fragloom.sources.scratch import discard, materialize

COLUMNS = ["id", "type_id", "type", "lang", "url", "observed_at", "fragments", "primary_fragments", "assembly", "position_joins", "bounded_fallback", "search", "text"]


def _require(condition: Column, message: str) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean"))


def bodies(articles: DataFrame, source: list[str] | None = None) -> DataFrame:
    """One row an article with its text, and what its counters need (left_over, ambiguous, best_effort); written, so that the kernels run once whatever reads it.

    Fragment accounting and the containment of all evidence are checked; kind 2
    needs the best-effort text. Articles that were made with bodies keep theirs. _row tells the rows apart.
    """
    ship(articles.sparkSession)
    whole = "body" in articles.columns  # made where the kernel ran
    left = F.col("left_over") if whole else F.size("unmerged")
    ok = _require((F.col("inputs") > 0) & (F.col("inputs") - F.col("merged") == left) & (F.col("completeness") == "not_verified"), "fragment accounting mismatch")
    best = F.col("diagnostics.best_effort")
    held = F.contains(best["text"], F.col("text")) & F.forall("unmerged", lambda f: F.contains(best["text"], f["text"]))
    ok = ok & _require((F.col("type") == 1) | (best.isNotNull() & held), "best-effort text is missing or lost evidence")
    none = F.array().cast("array<struct<pos:smallint,text:string>>")
    own = F.col("body") if whole else assemble_body_column(F.when(F.col("type") == 1, F.col("text")).otherwise(""), F.when(F.col("type") == 1, F.col("unmerged")).otherwise(none))
    parts = articles.where(ok).withColumn("_body", own)
    one = F.col("type") == 1
    joined = F.when(one, F.col("_body.joins") > 0).otherwise(best["ordering"] == "estimated")
    out = parts.select(
        *(source or []), "type", "lang", "url", F.col("date").alias("observed_at"), F.col("inputs").alias("fragments"), F.col("merged").alias("primary_fragments"),
        F.when(joined, "estimated").otherwise("connected").alias("assembly"), F.when(one, F.col("_body.joins")).otherwise(best["position_only_joins"]).cast("long").alias("position_joins"),
        F.when(one, F.col("_body.bounded")).otherwise(best["comparison_budget_exhausted"]).alias("bounded_fallback"),
        F.when(one, "not_applicable").otherwise(F.col("diagnostics.search_status")).alias("search"), F.when(one, F.col("_body.text")).otherwise(best["text"]).alias("text"),
        left.cast("long").alias("left_over"), F.coalesce(F.col("diagnostics.stop_reason") == "ambiguous_continuation", F.lit(False)).alias("ambiguous"), best.isNotNull().alias("best_effort"),
    )
    return _with_rows(out)


def observations(articles: DataFrame, source: list[str] | None = None) -> DataFrame:
    """One observation an article, numbered per source file in order of url, date, lang, type, and per type."""
    return numbered(bodies(articles, source), source or [])


def _with_rows(rows: DataFrame) -> DataFrame:
    return materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")


def _ranged(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows in ranges of the order, with the number of the range as _part; written, as ranges are cut by samples that differ from run to run."""
    return materialize(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")


def _placed(ranged: DataFrame, order: list[str], name: str, by: list[str]) -> DataFrame:
    """ranged with the place, from 0, of each row in the order among rows of equal `by`: ranges are sorted apart, and only their counts are summed, one row a range and `by`."""
    counts = ranged.groupBy("_part", *by).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", *by, F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order)) - 1
    return ranged.withColumn("_place", place).join(starts, ["_part", *by]).withColumn(name, (F.col("_before") + F.col("_place")).cast("long")).drop("_before", "_place")


def numbered(rows: DataFrame, source: list[str]) -> DataFrame:
    """rows with id and type_id from 1, per source and per source and type, in order of the key.

    Keys alone are dealt to ranges and numbered, without the texts, so a source
    with most of the rows is many ranges; the numbers are joined by row.
    """
    order = ["url", "observed_at", "lang", "type", "_row"]
    kept = rows if "_row" in rows.columns else _with_rows(rows)
    ranged = _ranged(kept.select(*source, *order), [*source, *order])
    placed = _placed(_placed(ranged, order, "id", source), order, "type_id", [*source, "type"])
    numbers = materialize(placed.select("_row", (F.col("id") + 1).alias("id"), (F.col("type_id") + 1).alias("type_id")), "numbers")
    discard(ranged)
    return kept.drop("id", "type_id").join(numbers, "_row").select(*source, *COLUMNS)


def dictionary(rows: DataFrame, order: str = "id") -> DataFrame:
    """text_id (from 0, in order of first appearance) and text of all distinct texts of one export."""
    first = rows.groupBy("text").agg(F.min(order).alias("_first"))
    return _placed(_ranged(first, ["_first"]), ["_first"], "text_id", []).select("text_id", "text")


def packed(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """rows with text_id in place of text, found by its SHA-256, so that texts are not compared or sorted."""
    digest = F.sha2("text", 256).alias("_digest")
    return rows.select("*", digest).join(texts.select("text_id", digest), "_digest").drop("text", "_digest")


def unpacked(rows: DataFrame, texts: DataFrame) -> DataFrame:
    return rows.join(texts, "text_id").drop("text_id")


def sample(rows: DataFrame) -> DataFrame:
    """The export's sample: the first observation of kind 1 and the 25th of kind 2."""
    return rows.where(((F.col("type") == 1) & (F.col("type_id") == 1)) | ((F.col("type") == 2) & (F.col("type_id") == 25)))


def spread(rows: DataFrame, order: list[str], total: int) -> DataFrame:
    """Evenly spaced rows: those at places floor(i n / total) of the order."""
    ranged = _ranged(rows, order)
    n = ranged.count()
    if not n:
        return rows.limit(0)
    # a place is taken if some i has floor(i n / total) equal to it
    i = F.ceil(F.col("_at") * total / F.lit(n))
    return _placed(ranged, order, "_at", []).where((F.floor(i * n / total) == F.col("_at")) & (i < total)).select(rows.columns)


def report(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts of an export in one aggregate."""
    return rows.groupBy(*(by or [])).agg(
        F.count("*").alias("observations"), F.count_if(F.col("type") == 1).alias("type1"), F.count_if(F.col("type") == 2).alias("type2"), F.countDistinct("text").alias("unique_texts"),
        F.count_if(F.col("assembly") == "estimated").alias("estimated"), F.coalesce(F.sum("position_joins"), F.lit(0)).alias("joins"), F.count_if("bounded_fallback").alias("bounded"),
    )


def problems(articles: DataFrame) -> DataFrame:
    """Articles with fragments that joined nothing."""
    return articles.where(F.size("unmerged") > 0)


def readable(articles: DataFrame) -> DataFrame:
    """url and a Markdown account of each article: text, then what is left, fenced."""
    from fragloom.functions.text import fenced

    rest = F.array_join(F.transform("unmerged", lambda f: F.concat(F.lit("- "), f["pos"].cast("string"), F.lit(": "), f["text"])), "\n")
    body = F.concat_ws("\n\n", F.concat(F.lit("# "), "url"), fenced(F.col("text")), F.when(F.size("unmerged") > 0, fenced(rest)))
    return articles.select("url", body.alias("markdown"))
