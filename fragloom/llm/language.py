"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character n-grams, hashed. The weights are
trained by follow-the-regularised-leader with elastic-net penalties, one text
after another, and the temperature of the softmax is set on texts kept apart.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fragloom.llm.common import discard, fresh, held_out, materialize, read, ready_for_python
from fragloom.llm.vectext import buffers, lists

BITS = 16
ORDERS = (1, 2, 3)
#: Labelled texts that are fitted on, at most, of each language; chosen by a hash.
TRAIN_DOCS = 600
#: Mass of a text's features.
SCALE = 40.0
ALPHA, BETA, L1, L2, EPOCHS = 0.4, 1.0, 0.02, 0.001, 3
#: Table entries that are gathered at once.
WINDOW = 1 << 22
UNDETERMINED = "und"
_LETTERLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter; numerals such as ½ or Ⅷ, which word patterns take for letters too, are none."""
    return any(m[0].isalpha() for m in _LETTERLIKE.finditer(text or ""))


def characters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All characters as numbers (their UTF-8 bytes, A-Z lower-cased), and the n + 1 offsets of each text's characters."""
    data, offsets = buffers(texts)
    base, end = int(offsets[0]), int(offsets[-1])
    part = data[base:end]
    start = np.flatnonzero((part & 0xC0) != 0x80)
    lead = part[start].astype(np.uint32)
    char = lead + 32 * ((lead >= 65) & (lead <= 90)).astype(np.uint32)
    length = np.diff(np.append(start, len(part)))
    wide = np.flatnonzero(length > 1)
    for k in range(1, 4):
        more = wide[length[wide] > k]
        char[more] = char[more] << np.uint32(8) | part[start[more] + k]
    return char, np.searchsorted(start, offsets - base)


def ngrams(char: np.ndarray, at: np.ndarray, order: int, a: int, b: int) -> np.ndarray:
    """Buckets of the n-grams that begin at characters a to b; 1 << BITS where one would leave its text."""
    reach = min(len(char), b + order - 1)
    part = char[a:reach]
    h = np.full(b - a, np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF))
    for k in range(order):
        x = part[k : k + b - a]
        h[: len(x)] = (h[: len(x)] ^ x) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
    h = (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)
    for k in range(1, order):
        over = at[1:] - k
        over = over[(over >= np.maximum(at[:-1], a)) & (over < b)]
        h[over - a] = 1 << BITS
    return h


def totals(char: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of table rows over each text's n-grams, and the number of n-grams. table: 2^BITS + 1 rows, the last 0."""
    n, width = len(at) - 1, table.shape[1]
    out, window = np.zeros((n, width)), max(1024, WINDOW // width)
    for a in range(0, len(char), window):
        b = min(len(char), a + window)
        first, last = np.searchsorted(at, a, "right") - 1, np.searchsorted(at, b, "left")
        cuts = np.maximum(at[first:last], a) - a
        full = np.flatnonzero(np.diff(np.append(cuts, b - a)))
        for order in ORDERS:
            got = table[ngrams(char, at, order, a, b)]
            out[first + full] += np.add.reduceat(got, cuts[full], axis=0, dtype=np.float32)
    length = np.diff(at)
    return out, sum(np.maximum(0, length - o + 1) for o in ORDERS)


def _counted(texts: pa.Array) -> pa.Array:
    """Distinct buckets of each text and their shares of its n-grams."""
    char, at = characters(texts)
    keys, shares, offsets = [], [], [0]
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own = np.array([0, b - a])
        total = np.zeros((1 << BITS) + 1, np.int64)
        for order in ORDERS:
            for x in range(a, b, WINDOW):
                y = min(b, x + WINDOW)
                total += np.bincount(ngrams(char[a:b], own, order, x - a, y - a), minlength=len(total))
        key = np.flatnonzero(total[:-1])
        keys.append(key)
        shares.append(total[key] / max(1, total[:-1].sum()))
        offsets.append(offsets[-1] + len(key))
    empty = [np.zeros(0)]
    key, share = np.concatenate(keys or empty), np.concatenate(shares or empty)
    at = np.array(offsets)
    return pa.StructArray.from_arrays([lists(key.astype(np.int32), at, pa.int32()), lists(share.astype(np.float32), at, pa.float32())], ["keys", "shares"])


def _held_by(texts: pa.Array) -> np.ndarray:
    """Number of texts that hold each bucket."""
    char, at = characters(texts)
    total = np.zeros((1 << BITS) + 1, np.int64)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        own, seen = np.array([0, b - a]), np.zeros(len(total), bool)
        for order in ORDERS:
            for x in range(a, b, WINDOW):
                seen[ngrams(char[a:b], own, order, x - a, min(b, x + WINDOW) - a)] = True
        total += seen
    return total[:-1]


def document_counts(texts: DataFrame) -> np.ndarray:
    """Texts (column _text) that hold each bucket, over all rows: summed in each task, then by bucket."""

    def run(batches):
        total = sum((_held_by(b.column(0)) for b in batches), np.zeros(1 << BITS, np.int64))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    found = texts.select("_text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << BITS, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


class Model:
    """Languages, the table of idf times weight, biases and temperature."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float) -> None:
        self.languages, self.table, self.bias, self.temperature = languages, table, bias, temperature

    def logits(self, texts: pa.Array) -> np.ndarray:
        char, at = characters(texts)
        sums, n = totals(char, at, self.table)
        return (SCALE * sums / np.maximum(1, n)[:, None] + self.bias) / self.temperature


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: list[str], documents: np.ndarray, total: int) -> Model:
    """FTRL-proximal over the texts in hash order; every fifth text sets the temperature only. documents: of total, those that hold each bucket."""
    width, size = len(languages), 1 << BITS
    idf = np.log((1 + total) / (1 + documents)) + 1
    z, n = np.zeros((size + 1, width)), np.zeros((size + 1, width))  # the last row is the bias

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    def prepared(i: int) -> tuple[np.ndarray, np.ndarray]:
        """Made anew for each use, as all of them together are many times the size of the rows."""
        k, s = rows[i]
        return np.append(k, size), np.append(SCALE * s.astype(float) * idf[k], 1.0)

    spare = {i for i in range(len(rows)) if i % 5 == 4} if len(rows) >= 20 else set()
    for _ in range(EPOCHS):
        for i in range(len(rows)):
            if i in spare:
                continue
            at, x = prepared(i)
            w = weights(at)
            p = _softmax(x @ w)
            p[labels[i]] -= 1.0
            g = x[:, None] * p
            old = n[at]
            n[at] = old + g * g
            z[at] += g - (np.sqrt(n[at]) - np.sqrt(old)) / ALPHA * w
    w = weights(np.arange(size + 1))
    table = np.vstack([w[:-1] * idf[:, None], np.zeros((1, width))]).astype(np.float32)
    held = sorted(spare) or range(len(rows))
    logits = np.array([x @ w[at] for at, x in map(prepared, held)])
    truth = labels[list(held)]
    # smoothed targets, as else texts that are all right would ask for a temperature of 0
    sure = (len(truth) + 1) / (len(truth) + 2)
    target = np.full((len(truth), width), (1 - sure) / max(1, width - 1))
    target[np.arange(len(truth)), truth] = sure
    grid = np.geomspace(0.02, 20, 161)
    loss = [-(target * np.log(np.maximum(_softmax(logits / t), 1e-12))).sum(1).mean() for t in grid]
    return Model(languages, table, w[-1], float(grid[int(np.argmin(loss))]))


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", bound: int = TRAIN_DOCS) -> Model | None:
    """Fit on at most `bound` texts of each language, whole, outside the held-out fifth, with the idf of all such texts; None without any. Feature counts, not texts, come to the driver."""
    ready_for_python(docs.sparkSession)
    known = docs.select(F.col(text).alias("_text"), F.col(lang).alias("_lang"), F.col(doc_id).alias("_id"))
    known = known.where(F.col("_lang").isNotNull() & F.col("_text").isNotNull() & ~held_out(F.col("_id")))
    counts = {r["_lang"]: r["count"] for r in known.groupBy("_lang").count().collect()}
    if not counts:
        return None
    languages = sorted(counts)
    share = F.coalesce(*[F.when(F.col("_lang") == x, F.lit(min(1.0, 0.95 * bound / n))) for x, n in counts.items()])
    key = F.xxhash64(F.lit(5), "_id", "_lang", "_text")
    # about `bound` of each language by hash, at most that many by place; rows of equal id, language and text count once
    likely = known.select("_lang", key.alias("key")).where(F.pmod("key", F.lit(1 << 30)) < share * (1 << 30)).distinct()
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("key"))
    picked = materialize(likely.withColumn("_place", place).where(F.col("_place") <= bound).select("_lang", "key"), "language-sample")
    rows = known.withColumn("key", key).join(F.broadcast(picked), ["_lang", "key"]).groupBy("_lang", "key").agg(F.any_value("_text").alias("_text"))
    table = rows.select("key", "_lang", F.arrow_udf(_counted, "struct<keys:array<int>,shares:array<float>>").asNondeterministic()("_text").alias("f")).select("key", "_lang", "f.*").toArrow().sort_by([("key", "ascending"), ("_lang", "ascending")])
    discard(picked)
    if not table.num_rows:
        return None
    keys, shares = (table[c].combine_chunks() for c in ("keys", "shares"))
    at = np.concatenate(([0], np.cumsum(keys.value_lengths().to_numpy())))
    k, s, named = keys.flatten().to_numpy(), shares.flatten().to_numpy(), table["_lang"].to_pylist()
    del table
    pa.default_memory_pool().release_unused()
    parts = [(k[a:b], s[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    place = {x: i for i, x in enumerate(languages)}
    return fit(parts, np.array([place[x] for x in named]), languages, document_counts(known), sum(counts.values()))


def identify(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (the calibrated probability), which replace columns of these names.

    Null texts and texts without a letter are `und` with score 0, as all are
    without a model. Whole texts; no shuffle.
    """
    ready_for_python(docs.sparkSession)

    def run(texts: pa.Array) -> pa.Array:
        lettered = np.array([has_letter(x) for x in texts.to_pylist()], bool)
        if model is None or not len(lettered):
            return pa.StructArray.from_arrays([pa.array([UNDETERMINED] * len(lettered), pa.string()), pa.array(np.zeros(len(lettered)))], ["lang", "score"])
        p = _softmax(model.logits(texts))
        names = np.array([*model.languages, UNDETERMINED], object)
        best = np.where(lettered, p.argmax(1), len(model.languages))
        return pa.StructArray.from_arrays([pa.array(names[best].tolist(), pa.string()), pa.array(np.where(lettered, p.max(1), 0.0))], ["lang", "score"])

    out, held = docs.drop("lang_pred", "score"), fresh(docs, "_l")
    out = out.withColumn(held, F.arrow_udf(run, "struct<lang:string,score:double>").asNondeterministic()(text))
    return out.select("*", F.col(f"{held}.lang").alias("lang_pred"), f"{held}.score").drop(held)


def query(spark, sf_dir):
    """op4: language of every text. An empty table gives an empty result."""
    docs = read(spark, sf_dir, "documents")
    out = identify(docs.select("doc_id", "text"), train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
