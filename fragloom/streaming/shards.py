"""Committed windows to shards of a size: many small batches become few large ones, without a rewrite of what readers hold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fragloom.streaming import batch as B
from fragloom.streaming import planner as P
from fragloom.streaming.job import CommitLog, data_digests, single_writer

PARTS = (B.PUBLISHED, B.QUARANTINE, B.FILES)


class StorageFull(RuntimeError):
    """What is to be written does not fit the storage; nothing was written or deleted."""


@dataclass(frozen=True)
class Window:
    """A committed batch: its entry, span, bytes and folder."""

    entry: int
    start: str
    end: str
    bytes: int
    data: str


def packed(windows: list[Window], limit: int, last: str | None = None, free: int = 1 << 62, reserve: int = 0) -> list[list[Window]]:
    """Windows in order of time in shards that are closed by the window that fills them.

    The last shard stays open unless its end reaches `last`, or space is scarce.
    """
    shards: list[list[Window]] = []
    open_: list[Window] = []
    for w in sorted(windows, key=lambda w: (w.start, w.entry)):
        open_.append(w)
        if P.seal(sum(x.bytes for x in open_), limit, free, reserve, P.minute_of(w.end), P.minute_of(last) if last else 1 << 62):
            shards.append(open_)
            open_ = []
    return shards


def _used(spark: SparkSession, folder: str) -> int:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def windows(log: CommitLog) -> list[Window]:
    """Batches that no shard has taken in yet; one entry each, as many as were committed since the last seal."""
    rows = log.current().where("lane != 'seal' and lines > 0").select("entry", "start", "end", "data", F.expr("aggregate(files.bytes, 0L, (a, x) -> a + x)").alias("bytes"))
    return [Window(r["entry"], r["start"], r["end"], r["bytes"] or 0, r["data"]) for r in rows.collect()]


def seal(spark: SparkSession, root: str, limit: int, *, last: str | None = None, maximum_gb: float = 1e9, reserve: int = 0, free: int = 1 << 62) -> list[int]:
    """Put committed windows into shards of about `limit` bytes; returns the numbers of the new seals.

    A shard is written aside, in order of minute, and checked for the rows and
    identities of its windows; then one entry replaces theirs. A crash before
    that entry leaves only a folder that the next run overwrites. Folders of
    replaced entries stay for readers that opened them until vacuum is called.
    Raises StorageFull before it writes what does not fit (counted twice).
    """
    log, done = CommitLog(spark, root), []
    with single_writer(root):
        number = (log.read().where("lane = 'seal'").agg(F.max("entry")).first()[0] or 0) + 1
        for shard in packed(windows(log), limit, last, free, reserve):
            if not P.fits(_used(spark, log.root), sum(w.bytes for w in shard), maximum_gb):
                raise StorageFull(f"{log.root} would grow beyond {maximum_gb} GB")
            data, counts = f"shards/seal={number:09d}", {}
            for part in PARTS:
                have = [f"{log.root}/{w.data}/{part}" for w in shard]
                rows, by = spark.read.parquet(*have), "metadata.source_minute" if part == B.PUBLISHED else None
                if by:
                    rows = rows.repartitionByRange(max(1, -(-sum(w.bytes for w in shard) // limit)), F.col(by)).sortWithinPartitions(by, "observation_id")
                else:
                    rows = rows.coalesce(1)  # a row a file, or a refused record
                rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{log.root}/{data}/{part}")
                counts[part] = _conserved(spark, have, f"{log.root}/{data}/{part}", part)
            lines = spark.read.parquet(f"{log.root}/{data}/{B.FILES}").agg(F.sum("lines"), F.sum("expanded_bytes")).first()
            log.seal(number, {
                "start": shard[0].start, "end": max(w.end for w in shard), "data": data, "minutes": counts[B.FILES], "observations": counts[B.PUBLISHED], "quarantined": counts[B.QUARANTINE],
                "lines": lines[0], "bytes": lines[1], "replaces": [w.entry for w in shard], "files": data_digests(spark, f"{log.root}/{data}"),
            })
            done.append(number)
            number += 1
    return done


def _conserved(spark: SparkSession, before: list[str], after: str, part: str) -> int:
    """The rows of a part, if they are the same before and after: their number, and the sum of their hashes."""
    plain = {B.PUBLISHED: ["observation_id", "text"], B.QUARANTINE: ["file", "source_line", "record"], B.FILES: ["file", "lines", "articles"]}[part]
    told = [spark.read.parquet(*p).agg(F.count("*"), F.sum(F.xxhash64(*plain).cast("decimal(38,0)"))).first() for p in (before, [after])]
    if told[0] != told[1]:
        raise RuntimeError(f"{part} of {after} differs from what it replaces")
    return told[0][0]


def vacuum(spark: SparkSession, root: str, before: float) -> list[str]:
    """Delete folders of entries that seals replaced before a time (seconds since the epoch), when no reader uses them any more."""
    log = CommitLog(spark, root)
    with single_writer(root):
        entries = log.read()
        old = entries.where((F.col("lane") == "seal") & (F.col("committed_at") < before)).select(F.explode("replaces").alias("entry"))
        gone = sorted(r["data"] for r in entries.where("lane != 'seal'").join(old, "entry", "left_semi").select("data").collect())
        for data in gone:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{log.root}/{data}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return gone
