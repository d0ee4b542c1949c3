"""The corpus pipeline: its stages run one after another on documents.

Each stage works on all rows that the one before kept, and all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from fragloom.llm import decontam, language, mixing, neardup, sharding
from fragloom.llm.common import fresh, materialize, read, sent_if_few


def _set_aside(docs, *names):
    """docs with its own columns of these names, which an operator would replace, renamed; and the columns that give docs back."""
    taken = {c: fresh(docs, f"_own_{c}") for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(taken), {c: F.col(taken.get(c, c)).alias(c) for c in docs.columns}


def language_stage(spark, docs, sf_dir):
    """Documents go that are in no language: null texts and texts without a letter. lang takes the prediction."""
    rows, back = _set_aside(docs, "lang_pred", "score")
    kept = language.identify(rows, language.train(rows)).where(F.col("lang_pred") != language.UNDETERMINED)
    return kept.select(*(back | {"lang": F.col("lang_pred").alias("lang")}).values())


def neardup_stage(spark, docs, sf_dir):
    """One document of each group of near duplicates stays (five words, 0.8), the one with the smallest id; rows of equal id stay or go together."""
    found, own = neardup.near_duplicates(docs.select("doc_id", "text")), fresh(docs, "_id")
    rest = found.groupBy(F.col("doc_id").alias(own)).agg(F.max("kept").alias("_kept")).where("not _kept").select(own)
    return docs.join(sent_if_few(materialize(rest, "near-copies")), F.col("doc_id").eqNullSafe(F.col(own)), "left_anti").select(docs.columns)


def decontam_stage(spark, docs, sf_dir):
    """Documents go that hold a benchmark item."""
    rows, back = _set_aside(docs, "hits")
    found = decontam.contaminated(rows, read(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select(*back.values())


def mixing_stage(spark, docs, sf_dir):
    """Documents are repeated or dropped so that sources come near their targets."""
    rows, back = _set_aside(docs, "size", "source_size", "target", "copies", "copy")
    return mixing.mix(rows).select(*back.values())


def sharding_stage(spark, docs, sf_dir):
    """Documents with shard and slot."""
    return sharding.assign_shards(docs)


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", neardup_stage),
    ("decontamination", decontam_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Three of the stages are models or sketches that SQL cannot express; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on documents; each result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
