"""Phrase collocation mining, level by level.

Level k counts phrases of k words whose two phrases of k - 1 words are both
frequent, which no frequent phrase can do without. What is frequent reaches the
tasks as a bitmap of fixed size per level, over hashes of language and phrase:
a false hit costs a row that the threshold drops afterwards, never a result.
Within a task, phrases are numbers: a phrase of k words is the pair of its
first k - 1 words and its last one, made exact by a dictionary of its chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fragloom.llm.common import heavy_keys, join_spread, materialize, read, ready_for_python, sent_if_few

LONGEST = 5
LEAST = 100
#: Rows kept of each language; the report's own limit.
TOP = 2000
UNKNOWN = "und"
#: Bits of a level's map of frequent phrases: 8 MB, whatever the corpus.
MAP_BITS = 26
#: Bytes of text that are counted together before their counts leave a task.
CHUNK = 8 << 20

#: floor(1000 a n / (l r)), with products of up to 37 digits.
SCORE = "(cast(1000 * a as decimal(18,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(19,0)))"

#: What a byte becomes: A to Z lower case, the ends of pieces a newline, a tab a space.
_BYTES = np.arange(256, dtype=np.uint8)
_BYTES[65:91] += 32
_BYTES[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 10
_BYTES[9] = 32
_TABLE = _BYTES.tobytes()


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 of equal keys, and the first place of each."""
    found = pa.array(keys).dictionary_encode()
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.empty(len(found.dictionary), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return codes, first


def _words(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of joined texts as dictionary array, and which have the next one in the same piece."""
    data = np.frombuffer(text, np.uint8)
    inside = (data != 32) & (data != 10)
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())])
    breaks = np.flatnonzero(data == 10)
    at = np.searchsorted(breaks, starts)
    joined = np.zeros(len(starts), bool)
    joined[:-1] = at[1:] == at[:-1]
    return words.dictionary_encode(), joined


def _is_frequent(lang: bytes, phrases: list[bytes], bits: np.ndarray) -> np.ndarray:
    """Whether each phrase's bit is set."""
    seed, mask = zlib.crc32(lang + b"\n"), (1 << MAP_BITS) - 1
    at = np.fromiter((zlib.crc32(p, seed) & mask for p in phrases), np.int64, len(phrases))
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _counted(lang: str, text: bytes, maps: list[np.ndarray]) -> tuple[list[bytes], np.ndarray]:
    """Phrases of one word more than there are maps, with their counts in the joined texts of a language."""
    words, joined = _words(text)
    word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    vocabulary = words.dictionary.to_pylist()
    if not maps:
        return [*vocabulary, b""], np.append(np.bincount(word, minlength=len(vocabulary)), len(word))
    key = lang.encode()
    at, codes, phrases = np.arange(len(word)), word, vocabulary  # places where a phrase of the level before begins
    for k, bits in enumerate(maps, 2):
        good = _is_frequent(key, phrases, bits)[codes]
        frequent = np.zeros(len(word) + 1, bool)
        frequent[at[good]] = True
        left = good & frequent[at + 1] & joined[at]
        at, before, names = at[left], codes[left], phrases
        codes, first = _numbered(before * len(vocabulary) + word[at + k - 1])
        phrases = [names[b] + b" " + vocabulary[w] for b, w in zip(before[first].tolist(), word[at[first] + k - 1].tolist(), strict=True)]
    return phrases, np.bincount(codes, minlength=len(phrases))


def _counter(maps):
    """A task's counts of (lang, phrase) over chunks of texts; the empty phrase stands for all words of level 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = [np.frombuffer(m, np.uint8) for m in maps.value]
        held: dict[str, list[bytes]] = {}
        size = 0

        def flush():
            for lang, texts in held.items():
                phrases, counts = _counted(lang, b"\n".join(texts).translate(_TABLE), levels)
                for i in range(0, len(phrases), 100_000):
                    part = pa.array(phrases[i : i + 100_000], pa.binary()).cast(pa.string())
                    yield pa.record_batch([pa.array([lang] * len(part), pa.string()), part, pa.array(counts[i : i + 100_000].astype(np.int64))], ["lang", "phrase", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
                held.setdefault(lang, []).append(text.as_py())
                size += len(text.as_buffer() or b"")
                if size >= CHUNK:
                    yield from flush()
                    size = 0
        yield from flush()

    return run


def frequent_map(level: DataFrame) -> bytes:
    """The bitmap of a level's phrases: bit crc32(lang, newline, phrase) mod 2^MAP_BITS.

    Tasks put the bits of 8,192 places into one row, so at most 2^13 rows of
    1 KB come to the driver, however many phrases there are.
    """
    at = (F.crc32(F.concat("lang", F.lit("\n"), "phrase").cast("binary")) % (1 << MAP_BITS)).alias("at")
    words = level.select(at).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    rows = words.groupBy(F.shiftright("word", 7).alias("row")).agg(F.collect_list(F.struct("word", "bits")).alias("words"))
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for row in rows.toLocalIterator():
        for w in row["words"]:
            out[w["word"]] = w["bits"]
    return out.tobytes()


def frequent_phrases(docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST) -> list[DataFrame]:
    """Level tables (lang, phrase, n) of all phrases of 1 to `longest` words with n >= least; level 1 also has each language's number of words, as the empty phrase.

    Words are `[^\\x20\\x09]+` of lower-cased pieces between `.,;:!?` and line
    ends; no phrase crosses pieces or documents. Null text counts as empty,
    null lang as `und`. No level is emptied by a limit: levels grow with the corpus.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")).where("text != ''")
    levels, maps = [], []
    for k in range(1, longest + 1):
        sent = spark.sparkContext.broadcast(maps)
        counts = rows.mapInArrow(_counter(sent), "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        levels.append(materialize(counts.where((F.col("n") >= least) | (F.col("phrase") == "")), f"phrases-{k}"))
        if k < longest:
            maps = [*maps, frequent_map(levels[-1].where("phrase != ''"))]
    return levels


def _part(phrase: Column, start: int, size: Column | int) -> Column:
    return F.array_join(F.slice(phrase, start, size), " ")


def _key(phrase: str) -> Column:
    return F.concat("lang", F.lit("\n"), phrase)


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, contained: int = 100) -> DataFrame:
    """lang, phrase, a, l, r, n, score, words: phrases of 2 to `longest` words with a >= least.

    A cut after k words scores floor(1000 a n / (l r)), exact in decimals; the
    lowest-scoring cut counts, of equal ones the first. Phrases are dropped that
    lie within a longer one with 100 f(longer) >= contained * a: as counts fall
    with length, one of one word more tells. Other columns of docs are dropped.
    An empty table gives an empty result.
    """
    levels = frequent_phrases(docs, text=text, lang=lang, longest=longest, least=least)
    counts = reduce(DataFrame.unionByName, levels[: longest - 1]).where("phrase != ''")
    found = []
    for k in range(2, longest + 1):
        level = levels[k - 1]
        if k < longest:
            w = F.split("phrase", " ")
            inside = levels[k].select("lang", F.explode(F.array(_part(w, 1, k), _part(w, 2, k))).alias("phrase"), "n")
            inside = inside.groupBy("lang", "phrase").agg(F.max("n").alias("_longer"))
            level = level.join(inside, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (F.col("_longer") * 100 < F.col("n") * contained)).drop("_longer")
        found.append(level.withColumn("words", F.lit(k).cast("long")))
    kept = materialize(reduce(DataFrame.unionByName, found).withColumnRenamed("n", "a"), "phrases-kept")
    w = F.split("phrase", " ")
    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words").cast("int") - 1)).alias("cut"))
    cuts = cuts.withColumns({"_left": _part(w, 1, F.col("cut")), "_right": F.array_join(F.slice(w, F.col("cut") + 1, F.col("words").cast("int")), " ")})
    cuts = materialize(cuts.withColumns({"_l": _key("_left"), "_r": _key("_right")}).drop("_left", "_right"), "phrases-cuts")
    for key, n in (("_l", "l"), ("_r", "r")):  # a common word begins very many phrases
        cuts = join_spread(cuts, counts.select(_key("phrase").alias(key), F.col("n").alias(n)), key, heavy_keys(cuts, key), ["lang", "phrase", "cut"])
    total = materialize(levels[0].where("phrase = ''").select("lang", "n"), "phrases-words")
    cuts = cuts.join(sent_if_few(total), "lang").withColumn("score", F.expr(SCORE))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a", "n", "words")).alias("_b"))
    return best.select("lang", "phrase", "_b.a", "_b.l", "_b.r", "_b.n", "_b.score", "_b.words")


def query(spark, sf_dir):
    """op12: each language's first 2,000 phrases of all documents."""
    found = collocations(read(spark, sf_dir, "documents").select("text", "lang"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return found.withColumn("rank", rank.cast("long")).where(F.col("rank") <= TOP).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _sql() -> str:
    grams = " UNION ALL ".join(f"SELECT lang, {k} AS k, array_to_string(w[i:i + {k - 1}], ' ') AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM p)" for k in range(1, LONGEST + 1))
    return f"""WITH p AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda x: x != '') AS w FROM (SELECT coalesce(lang, '{UNKNOWN}') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
  g AS (SELECT lang, k, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL),
  n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
  c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= {LEAST}),
  s AS (SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score, j
    FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN n USING (lang)
    JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:j], ' ') JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(w[j + 1:c.k], ' ')),
  b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
  d AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN c o ON o.lang = c.lang AND o.k > c.k AND 100 * o.a >= 100 * c.a AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b ANTI JOIN d USING (lang, phrase) QUALIFY rank <= {TOP}"""


SQL = _sql()
