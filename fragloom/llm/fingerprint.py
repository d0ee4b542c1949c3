"""Document fingerprints: a quartile bucket digest of byte triplets.

Every byte triplet of a text is hashed into one of 256 buckets. A bucket's code
says above how many of the three quartiles of all counts its count lies. The
digest is the codes, two bits each, and the logarithm of the length. Two
digests differ by the sum of the differences of codes and lengths, with a bound.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fragloom.llm.common import read, ready_for_python
from fragloom.llm.vectext import buffers

BUCKETS = 256
#: Codes of unrelated texts differ by 1.25 on average; from there on digests count as unlike.
BOUND = 1.25 * BUCKETS
#: Bytes hashed at once.
CHUNK = 1 << 20


def _counts(data: np.ndarray) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    for a in range(0, max(0, len(data) - 2), CHUNK):
        x = data[a : a + CHUNK + 2].astype(np.uint32)
        h = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        total += np.bincount(h >> np.uint32(24), minlength=BUCKETS)
    return total


def digest(data: np.ndarray) -> bytes:
    """65 bytes: the length code, then 256 codes of two bits. Texts under three bytes have all codes 0."""
    counts = _counts(data)
    quartiles = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts[:, None] > quartiles[None, :]).sum(1).astype(np.uint8).reshape(-1, 4)
    packed = codes[:, 0] << 6 | codes[:, 1] << 4 | codes[:, 2] << 2 | codes[:, 3]
    return bytes([min(255, round(8 * np.log2(len(data) + 1)))]) + packed.tobytes()


def _digests(texts: pa.Array) -> pa.Array:
    data, at = buffers(texts)
    return pa.array([digest(data[a:b]).hex() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.string())


def _codes(digests: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex("".join(digests.to_pylist())), np.uint8).reshape(len(digests), 1 + BUCKETS // 4)
    body = raw[:, 1:]
    return raw[:, 0].astype(np.int64), np.stack([body >> 6, body >> 4 & 3, body >> 2 & 3, body & 3], 2).reshape(len(digests), BUCKETS).astype(np.int8)


def difference(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Sum of differences of codes, and of length codes beyond one, at most BOUND."""
    (la, ca), (lb, cb) = _codes(a), _codes(b)
    return np.minimum(np.abs(ca - cb).sum(1, dtype=np.int64) + np.maximum(0, np.abs(la - lb) - 1), BOUND)


def likeness(a: pa.Array, b: pa.Array) -> pa.Array:
    """1 for equal digests, 0 from the bound on."""
    return pa.array(1.0 - difference(a, b) / BOUND, pa.float64()) if len(a) else pa.array([], pa.float64())


def fingerprint_column(text):
    """Fingerprint of a text column, in hex; null as the empty text."""
    return F.arrow_udf(_digests, "string")(text)


def likeness_column(a, b):
    """Likeness of two fingerprint columns, 0 to 1; neither may be null."""
    return F.arrow_udf(likeness, "double")(a, b)


def fingerprints(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """docs with `fingerprint`, which replaces a column of that name. Whole texts; no shuffle."""
    ready_for_python(docs.sparkSession)
    return docs.withColumn("fingerprint", fingerprint_column(F.col(text)))


#: Bytes of text of one range, on average, and the least number of ranges; ranges of one task, on average.
RANGE_BYTES, LEAST_RANGES, TASK_RANGES = 8 << 20, 64, 4


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds that are not above the key, 0 for null; found in two steps, among every so many of them and then between two of these."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    known = lambda values: F.array(*[F.lit(b) for b in values]).cast("array<bigint>")
    below = lambda values: F.size(F.filter(values, lambda b: b <= key))
    block = below(known([b[0] for b in blocks]))
    found = (block - 1) * step + below(F.get(F.array(*[known(b) for b in blocks]), block - 1))
    return F.when(key.isNull() | (key < F.lit(bounds[0])), F.lit(0)).otherwise(found)


def with_next(raw: DataFrame, key: str, derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of derive(raw) with `next`, a struct of the following row by key, of the first row after the last.

    Rows of equal key follow each other by the columns, and null keys come
    first. Keys are cut into ranges of about RANGE_BYTES of text by approximate
    quantiles; each range also gets a copy of the first row of the next range
    that has any, so one shuffle of the rows suffices, and ranges are worked on
    apart. The key is a whole number; other types, whose quantiles would not
    follow their order, are refused. A column of derive(raw) named next is left out; those named _to, _head,
    _part, _row or _copy are refused.
    """
    spark, rows = raw.sparkSession, derive(raw)
    if taken := {"_to", "_head", "_part", "_row", "_copy"} & set(rows.columns):
        raise ValueError(f"columns are named {sorted(taken)}")
    if (kind := dict(raw.dtypes)[key]) not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{key} is {kind}, not a whole number")
    columns = [c for c in rows.columns if c not in (key, "next")]
    texts = [F.octet_length(c).cast("long") for c, kind in raw.dtypes if kind == "string"]
    total = raw.agg(F.sum(sum(texts, F.lit(8)))).first()[0] or 0
    parts = max(LEAST_RANGES, -(-total // RANGE_BYTES))
    bounds = raw.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0] or []
    bounds = sorted(set(bounds))
    part = _range_of(F.col(key), bounds)
    row = F.struct(F.col(key).alias("_key"), *columns)
    ranged = rows.select(part.cast("int").alias("_part"), row.alias("_row"))
    firsts = raw.groupBy(part.cast("int").alias("_part")).agg(F.min(key).alias("_first"), F.max(F.col(key).isNull()).alias("_null")).orderBy("_part").collect()
    if not firsts:
        return ranged.select("_row.*", F.col("_row").alias("next")).drop("_key").limit(0)
    at = [x["_part"] for x in firsts]
    # the least key of a range, under the range before it (of the last for the first)
    heads = [(at[i - 1], None if firsts[i]["_null"] else firsts[i]["_first"]) for i in range(len(at))]
    keys = spark.createDataFrame(heads, f"_to int, _head {dict(raw.dtypes)[key]}")
    copies = derive(raw.join(F.broadcast(keys), F.col(key).eqNullSafe(F.col("_head"))))
    copies = copies.groupBy("_to").agg(F.min(row).alias("_row")).select(F.col("_to").alias("_part"), "_row", F.lit(1).alias("_copy"))
    order = Window.partitionBy("_part").orderBy("_copy", "_row")
    led = ranged.withColumn("_copy", F.lit(0)).unionByName(copies).repartition(-(-parts // TASK_RANGES), "_part").withColumn("next", F.lead("_row").over(order)).where("_copy = 0")
    return led.select(F.col("_row._key").alias(key), *[F.col(f"_row.{c}").alias(c) for c in columns], "next")


def query(spark, sf_dir):
    """op5: fingerprints of all texts and edited texts. An empty table gives an empty result; a single document follows itself."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", fingerprints)
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", 1, n - cut), F.substring("next.text", 1, cut))
    out = rows.select("doc_id", n.cast("long").alias("n_chars"), "fingerprint", F.col("next.fingerprint").alias("_next"), edited.alias("_edited"))
    out = out.withColumn("edited_fingerprint", fingerprint_column(F.col("_edited")))
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness_column(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness_column(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )
