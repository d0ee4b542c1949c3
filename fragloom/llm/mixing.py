"""Mixing sources to target weights.

Tokens are summed by source, each source's repetition rate is its target over
its tokens, and every document is emitted floor(rate) times plus once more with
probability equal to the fraction, by a seeded hash of the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fragloom.llm.common import fresh, materialize, words

SEED = 20240611
#: A document is repeated at most this many times.
MAX_RATE = 3.0


def _unit(*columns: Column, seed: int) -> Column:
    """A uniform number in [0, 1) from a seeded hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


def ranked_sources(sizes: DataFrame, source: str) -> DataFrame:
    """Rank of each source from 0, by code point, null last.

    Ranges of sources are numbered in parallel; the range starts come from one
    row a range. The ranges are written first, as range bounds are sampled anew
    at each execution.
    """
    order = F.col(source).asc_nulls_last()
    parts = materialize(sizes.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "mix-sources")
    starts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = starts.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return parts.withColumn("_at", at).join(starts, "_part").withColumn("rank", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before", "_n")


def fill_targets(sources: DataFrame, size: str, weight: str, max_rate: float = MAX_RATE) -> DataFrame:
    """Share the sum of sizes by weight; no target above max_rate times the source's size, the excess shared again by weight.

    Each round is one aggregate over the sources. Sources above their cap at the
    present level stay capped, as the level only rises; the rounds end when no
    further source is capped, mostly after two to four.
    """
    cap = F.col(size) * max_rate
    total = sources.agg(F.sum(size)).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col(weight) * level > cap
        row = sources.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col(weight))), F.count(F.when(full, 1))).first()
        if row[2] == capped or not row[1]:
            break
        capped, level = row[2], max(level, (total - row[0]) / row[1])
    return sources.withColumn("target", F.least(cap, F.col(weight) * level).cast("double"))


def assign_copies(docs: DataFrame, *, text: str = "text", source: str = "source", doc_id: str = "doc_id", weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_rate: float = MAX_RATE, seed: int = SEED) -> DataFrame:
    """docs with size, source_size, target and copies: how often the mix takes each.

    Null texts have size 0; null is a source of its own. A source without words
    has target and rate 0. Rows with equal id and text draw alike. Sources weigh
    `weights` in code point order, repeating. Columns of docs named size,
    source_size, target or copies are replaced. The join to the table of sources
    is broadcast only while Spark's own size limit holds; beyond it, a hot
    source is split by adaptive execution.
    """
    base = docs.drop("size", "source_size", "target", "copies").withColumn("size", words(F.col(text)))
    named = fresh(docs, "_source")
    sizes = base.groupBy(F.col(source).alias("_source")).agg(F.sum("size").alias("source_size"))
    ranked = materialize(ranked_sources(sizes, "_source"), "mix-ranked")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    targets = fill_targets(ranked.withColumn("_weight", weight), "source_size", "_weight", max_rate)
    targets = targets.select(F.col("_source").alias(named), "source_size", "target")
    joined = base.join(targets, F.col(source).eqNullSafe(F.col(named))).drop(named)
    rate = F.least(F.lit(max_rate), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    draw = _unit(F.col(doc_id), F.col(text), seed=seed) < rate - F.floor(rate)
    return joined.withColumn("copies", F.floor(rate) + draw.cast("long"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as often as its copies say, with copy from 0."""
    taken = assign_copies(docs, **options).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("copies")


def query(spark, sf_dir):
    """op1: words taken from each document. An empty table gives an empty result."""
    from fragloom.llm.common import read

    out = assign_copies(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
