"""URL filter: host and path rules, then a ratio of character language models.

Two variable-order Markov models, one of accepted and one of rejected URLs,
predict each character from up to three before it; shorter contexts back up
longer ones by how often these were seen (Witten-Bell). The URL's score is the
difference of log-likelihoods by its length, and the threshold is calibrated on
URLs kept apart. Characters are folded into 48 symbols, so a model has at most
48^4 counts, whatever the corpus; the counts themselves are taken over all URLs
that the rules decide, in DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragloom.llm.common import fresh, read, ready_for_python
from fragloom.llm.vectext import buffers

#: The symbols; beside them there are the beginning, 0, and any other character, 1.
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789./-_?=&#%:"
BEGIN, OTHER = "^", "~"
SIZE, ORDER = len(SYMBOLS) + 2, 4
#: Scores are counted in so many bins from -LIMIT to LIMIT for calibration.
BINS, LIMIT = 4000, 8.0

#: The rules of op8: verdict, host and path.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

_SYMBOL = np.ones(256, np.int64)
_SYMBOL[[ord(c) for c in SYMBOLS]] = np.arange(2, SIZE)
_SYMBOL[65:91] = _SYMBOL[97:123]


def host_of(url: Column) -> Column:
    """What follows the first :// up to a slash, question mark or hash, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*+)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark or hash; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*+([^?#]*+)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """struct<verdict, rule> of the longest rule that fits, null if none does; of equal ones the first."""
    best = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda x: len(x[1])) if rules else []:
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        best = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(best)
    return best


def symbol_grams(url: Column) -> Column:
    """The 4-grams of a URL's symbols after three beginnings, as strings; none for null and empty URLs. Any other character is one symbol."""
    lower = F.translate(url, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    padded = F.concat(F.lit(BEGIN * (ORDER - 1)), F.regexp_replace(lower, r"[^a-z0-9./\-_?=&#%:]", OTHER))
    grams = F.transform(F.sequence(F.lit(1), F.char_length(url)), lambda i: F.substring(padded, i, ORDER))
    return F.when(F.char_length(url) > 0, grams)


def gram_codes(grams: list[str]) -> np.ndarray:
    """Numbers of 4-grams below 48^4."""
    place = {c: i for i, c in enumerate(BEGIN + OTHER + SYMBOLS)}
    return np.array([sum(place[c] * SIZE ** (ORDER - 1 - k) for k, c in enumerate(g)) for g in grams], np.int64)


def gram_counts(decided: DataFrame) -> DataFrame:
    """gram, accepted, rejected over all rows of decided (url, verdict)."""
    grams = decided.select("verdict", F.explode(symbol_grams(F.col("url"))).alias("gram"))
    return grams.groupBy("gram").agg(F.count_if(F.col("verdict") == "allow").alias("accepted"), F.count_if(F.col("verdict") == "block").alias("rejected"))


def markov(gram: np.ndarray, count: np.ndarray) -> np.ndarray:
    """log P(character | three before) for all 48^4 grams, interpolated over shorter contexts."""
    counts = np.bincount(gram, count, SIZE**ORDER).reshape([SIZE] * ORDER)
    p = np.full(SIZE, 1.0 / SIZE)
    for order in range(ORDER):
        c = counts.sum(axis=tuple(range(ORDER - 1 - order))) if order < ORDER - 1 else counts
        total, kinds = c.sum(-1, keepdims=True), (c > 0).sum(-1, keepdims=True)
        p = (c + kinds * p) / np.maximum(total + kinds, 1) + np.where(total + kinds > 0, 0.0, 1.0) * p
    return np.log(p).astype(np.float32).ravel()


@dataclass
class Ratio:
    """Difference of the two models' logs by gram, and the threshold: a URL is allowed at or above it."""

    table: np.ndarray
    threshold: float = 0.0


def score_column(url: Column, table: np.ndarray) -> Column:
    """Log-likelihood difference by length; 0 for null and empty URLs."""

    def run(urls: pa.Array) -> pa.Array:
        data, at = buffers(urls)
        raw = data[at[0] : at[-1]]
        # one symbol a character: bytes that continue one are left out
        lead = np.flatnonzero((raw & 0xC0) != 0x80)
        at = np.searchsorted(lead, at - at[0])
        n = np.diff(at)
        place = np.arange(len(lead)) - np.repeat(at[:-1], n)
        symbol = _SYMBOL[raw[lead]]
        gram = symbol.copy()
        for k in range(1, ORDER):
            gram[k:] += np.where(place[k:] >= k, symbol[:-k], 0) * SIZE**k
        total = np.bincount(np.repeat(np.arange(len(n)), n), table[gram], len(n))
        return pa.array(total / np.maximum(1, n))

    return F.arrow_udf(run, "double").asNondeterministic()(url)


def train(decided: DataFrame) -> Ratio:
    """Models and threshold from decided (url, verdict): four fifths of the distinct URLs, by hash, give the counts, the rest the threshold.

    The threshold is where the shares of wrongly judged accepted and rejected
    URLs have the least sum. Without URLs of both kinds all scores are 0 and
    all URLs are allowed.
    """
    ready_for_python(decided.sparkSession)
    fifth = F.pmod(F.xxhash64(F.lit(3), "url"), F.lit(5))
    rows = gram_counts(decided.where(fifth != 0)).toArrow()
    gram, accepted, rejected = gram_codes(rows["gram"].to_pylist()), rows["accepted"].to_numpy(), rows["rejected"].to_numpy()
    if not len(gram) or not accepted.any() or not rejected.any():
        return Ratio(np.zeros(SIZE**ORDER, np.float32))
    table = markov(gram, accepted) - markov(gram, rejected)
    apart = decided.where(fifth == 0).select("verdict", score_column(F.col("url"), table).alias("s"))
    bins = F.least(F.greatest(F.floor((F.col("s") + LIMIT) / (2 * LIMIT) * BINS), F.lit(0)), F.lit(BINS - 1))
    found = apart.groupBy(bins.alias("bin")).agg(F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b")).collect()
    a, b = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for r in found:
        a[r["bin"] + 1], b[r["bin"] + 1] = r["a"], r["b"]
    if not a.any() or not b.any():
        return Ratio(table)
    wrong = np.cumsum(a) / a.sum() + 1 - np.cumsum(b) / b.sum()
    return Ratio(table, float(threshold_bin(wrong) / BINS * 2 * LIMIT - LIMIT))


def threshold_bin(wrong: np.ndarray) -> float:
    """Middle of the longest run of bins with the least error, the first of equally long ones; between two runs the error is higher."""
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    return float(max(np.split(best, np.flatnonzero(np.diff(best) > 1) + 1), key=len).mean())


def filter_urls(pages: DataFrame, *, url: str = "url", rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """pages with host, path, rule, score and verdict, which replace columns of these names.

    Null URLs and those without :// have empty host and path, fit no rule, and
    are judged by their score as all others that fit none.
    """
    ready_for_python(pages.sparkSession)
    parts = pages.drop("host", "path", "rule", "score", "verdict").withColumn("host", host_of(F.col(url))).withColumn("path", path_of(F.col(url)))
    own = fresh(pages, "_rule")
    parts = parts.withColumn(own, rule_of(F.col("host"), F.col("path"), rules))
    model = train(parts.where(F.col(own).isNotNull()).select(F.col(url).alias("url"), F.col(f"{own}.verdict").alias("verdict")))
    judged = parts.withColumn("score", score_column(F.col(url), model.table))
    verdict = F.coalesce(F.col(f"{own}.verdict"), F.when(F.col("score") >= model.threshold, "allow").otherwise("block"))
    return judged.withColumn("rule", F.col(f"{own}.rule")).withColumn("verdict", verdict).drop(own)


def query(spark, sf_dir):
    """op8: verdict on every page's URL. An empty table gives an empty result."""
    return filter_urls(read(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")
