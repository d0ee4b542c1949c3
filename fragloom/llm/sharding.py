"""Sharding by a two-pass external shuffle, in DataFrame operations only.

Pass 1 scatters records uniformly into buckets of bounded bytes by a seeded
hash. Pass 2 puts each bucket in hash order, cuts it into blocks that fit in
memory (one block, unless rows repeat), and shuffles each block with
shuffle(), which is Fisher-Yates with a seed. The position in the shuffled
whole fixes shard and slot, so counts of shards differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fragloom.llm.common import prefix_sums

SEED = 7919
#: Bytes of text of one bucket, on average.
BUCKET_BYTES = 4 << 20
#: Bytes of text of one block in memory; only buckets beyond it have several.
BLOCK_BYTES = 16 << 20
#: Bytes of text of one task, on average, and the least number of tasks.
TASK_BYTES, LEAST_TASKS = 32 << 20, 16
#: Bytes of text of one file, on average.
FILE_BYTES = 128 << 20


def shuffle_records(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with `position`, a gapless uniform permutation from 0.

    Null texts count one byte, as empty ones do. Rows equal in id and text fall
    into one bucket, however many; such a bucket is sorted with spilling and cut
    into several blocks, so memory stays bounded. A column of docs named
    position is replaced. Reruns, and tasks that are run again, agree whatever
    the partitions of docs and the session's settings: shuffle() draws from the
    seed and the task's number, so tasks are as many as the bytes ask for, and
    each takes its blocks in order. Rows that are equal in all columns (maps
    aside) may change places.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    total = docs.agg(F.sum(size)).first()[0] or 0
    buckets, tasks = max(1, -(-total // bucket_bytes)), max(LEAST_TASKS, -(-total // TASK_BYTES))
    columns = [c for c in docs.columns if c != "position"]
    plain = [c for c, kind in docs.dtypes if c in columns and "map<" not in kind and "variant" not in kind]
    key = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    keyed = docs.select(F.struct(*columns).alias("_row"), key.alias("_key"), F.xxhash64(*plain).alias("_tie"), size.alias("_size")).withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)))
    counts = docs.groupBy(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket")).agg(F.count("*").alias("_n"))
    starts = prefix_sums(counts, "_bucket", "_n", "_start").select("_bucket", "_start")
    by_hash = Window.partitionBy("_bucket").orderBy("_key", "_tie")
    blocks = keyed.repartition(tasks, "_bucket").withColumn("_block", F.floor((F.sum("_size").over(by_hash.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")) / block_bytes))
    blocks = blocks.groupBy("_bucket", "_block").agg(F.collect_list(F.struct("_key", "_tie", "_row")).alias("_rows"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_bucket").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("_before", F.coalesce(before, F.lit(0))).join(starts, "_bucket").repartition(tasks, "_bucket").sortWithinPartitions("_bucket", "_block")
    dealt = blocks.select((F.col("_start") + F.col("_before")).alias("_first"), F.posexplode(F.shuffle(F.array_sort("_rows", _by_key), F.lit(seed))).alias("_at", "_item"))
    return dealt.select("_item._row.*", (F.col("_first") + F.col("_at")).cast("long").alias("position"))


def _by_key(a, b):
    less = (a["_key"] < b["_key"]) | ((a["_key"] == b["_key"]) & (a["_tie"] < b["_tie"]))
    more = (a["_key"] > b["_key"]) | ((a["_key"] == b["_key"]) & (a["_tie"] > b["_tie"]))
    return F.when(less, -1).when(more, 1).otherwise(0)


def assign_shards(docs: DataFrame, shards: int = 16, **options) -> DataFrame:
    """docs with shard (0 to shards - 1) and slot (gapless from 0 within a shard); columns of docs so named are replaced."""
    dealt = shuffle_records(docs.drop("shard", "slot"), **options)
    return dealt.select(*[c for c in dealt.columns if c != "position"], F.pmod("position", F.lit(shards)).cast("int").alias("shard"), F.floor(F.col("position") / shards).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, *, text: str = "text", files_per_shard: int | None = None, shards: int = 16, **options) -> None:
    """Write each shard's records in slot order, as files under shard=N; as many as the bytes ask for unless their number is given."""
    if files_per_shard is None:
        total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
        files_per_shard = max(1, -(-total // (FILE_BYTES * shards)))
    dealt = assign_shards(docs, shards, text=text, **options)
    dealt.repartitionByRange(shards * files_per_shard, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def query(spark, sf_dir):
    """op3: shard and slot of every document; the law is `rows`. An empty table gives an empty result."""
    from fragloom.llm.common import read

    text = F.coalesce(F.col("text"), F.lit(""))
    return assign_shards(read(spark, sf_dir, "documents")).select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
