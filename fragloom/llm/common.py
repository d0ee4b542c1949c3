"""Shared helpers: scratch tables, small statistics, global order."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fragloom.functions.shipping import ship

#: ASCII white space, as the contracts define words.
WORD = r"[^\x20\x09-\x0D]++"

#: Rows of one Arrow batch; texts average a few KB, so a batch stays at a few MB.
ARROW_ROWS = 1000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset (local tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="fragloom-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/fragloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: this cuts the lineage, and a lost executor costs no more than its own tasks."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the scratch files that materialized frames read."""
    for df in frames:
        spark = df.sparkSession
        jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles() if "/fragloom/" in f}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


#: Rows of ids or numbers that are sent to all tasks; more are joined by shuffle.
BROADCAST_ROWS = 300_000


def fresh(df: DataFrame, name: str) -> str:
    """name, lengthened until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def sent_if_few(df: DataFrame) -> DataFrame:
    """df, to be sent to all tasks if its rows, counted, are at most BROADCAST_ROWS; df must be materialized and narrow."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


#: A key is heavy if it has more than a 1/SPREAD of all rows; there are at most SPREAD such keys, whatever the size.
SPREAD = 400


def spread_limit(rows: int) -> int:
    """Rows beyond which a key is heavy."""
    return max(1, rows // SPREAD)


def heavy_keys(rows: DataFrame, key: str) -> DataFrame:
    """key, _parts: the heavy keys of rows (materialized), at most SPREAD, and into how many parts more than one each is to be dealt."""
    limit = spread_limit(rows.count())
    return rows.groupBy(key).agg(F.floor(F.count("*") / limit).alias("_parts")).where("_parts > 0")


def join_spread(rows: DataFrame, table: DataFrame, key: str, heavy: DataFrame, identity: list[str]) -> DataFrame:
    """rows joined with a table of unique keys, so that no task gets much more than a 1/SPREAD of the rows for one key.

    Rows of heavy keys are dealt by a hash of the columns that tell them apart,
    and the table's rows are repeated for them.
    """
    heavy, parts = F.broadcast(heavy), F.coalesce("_parts", F.lit(0).cast("bigint"))
    dealt = rows.join(heavy, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*identity), parts + 1)).drop("_parts")
    repeated = table.join(heavy, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), parts))).drop("_parts")
    return dealt.join(repeated, [key, "_salt"]).drop("_salt")


def ready_for_python(spark: SparkSession) -> None:
    """Send our sources to the workers, and keep Arrow batches small unless the session has chosen a size itself."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(ARROW_ROWS))


def words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 5 is 0; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def prefix_sums(df: DataFrame, key: str, value: str, out: str, block: int = 4096) -> DataFrame:
    """Exclusive running sum of `value` by an integer `key` that runs from 0 without large gaps.

    Two levels: sums within blocks of keys run in parallel, and one task adds up
    the block totals, of which there are 1/4096 as many rows.
    """
    blocks = df.withColumn("_block", F.floor(F.col(key) / block))
    inner = Window.partitionBy("_block").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("_block").agg(F.sum(value).alias("_total"))
    totals = totals.select("_block", F.coalesce(F.sum("_total").over(outer), F.lit(0)).alias("_before"))
    within = blocks.withColumn("_within", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return within.join(totals, "_block").withColumn(out, F.col("_before") + F.col("_within")).drop("_block", "_before", "_within")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
