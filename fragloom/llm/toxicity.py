"""Toxicity by multiple-instance learning.

A text is a bag of sentences. A sentence's probability is logistic in its
words and their beginnings (inflected and compounded forms share them), a
text's is the noisy-or of its sentences, and only the text's label is known in
training. The sentences' own probabilities then tell where the offending ones
are.

Features that texts of label 1 hold more often than chance allows (G2 test)
are candidates; their weights maximise the noisy-or likelihood under an L1
penalty that is chosen on training texts kept apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragloom.llm.common import discard, fresh, held_out, materialize, read, ready_for_python
from fragloom.llm.vectext import PLAIN, buffers, lists, prefixes, tokens

#: Labelled texts that are fitted on, at most; those with the smallest hashes of id and text.
TRAIN_DOCS = 6000
#: Features hash to so many buckets, 2 to the power of it.
BITS = 20
#: Lengths in bytes of the beginnings of longer words that are features beside the word.
BEGINNINGS = (4, 5)
#: G2 from which a feature is a candidate: chance exceeds it once in 16,000 features.
SCREEN = 16.0
ROUNDS = 120
#: Penalties against the mean loss of a text: L1, of which one is chosen, and L2.
STRENGTHS, L2 = (1e-5, 3e-5, 1e-4, 3e-4), 1e-5
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True

Model = tuple[np.ndarray, np.ndarray, float]


def bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of words (a row a word, -1 for none); offsets of sentences' words; offsets of texts' sentences; first byte and end of each sentence.

    Sentences end at one of . ! ? and line feeds; those without words don't count.
    """
    data, offsets = buffers(texts)
    hashes, begin, end, at = tokens(texts, True, PLAIN)
    if not len(hashes):
        none = np.zeros(0, np.int64)
        return np.zeros((0, 1 + len(BEGINNINGS)), np.int64), np.zeros(1, np.int64), np.zeros(len(offsets), np.int64), none, none
    base = int(offsets[0])
    marks = np.cumsum(_ENDS[data[base : int(offsets[-1])]])[begin - base]
    new = np.ones(len(hashes), bool)
    new[1:] = marks[1:] != marks[:-1]
    new[at[:-1][at[:-1] < len(hashes)]] = True
    sentence = np.flatnonzero(new)
    last = np.concatenate((sentence[1:], [len(hashes)])) - 1
    shift = np.uint64(64 - BITS)
    columns = [(hashes >> shift).astype(np.int64)]
    for n in BEGINNINGS:
        columns.append(np.where(end - begin > n, (prefixes(data, begin, end, n) >> shift).astype(np.int64), -1))
    return np.stack(columns, 1), np.concatenate((sentence, [len(hashes)])), np.searchsorted(sentence, at), begin[sentence], end[last]


def _numbered(candidates: np.ndarray) -> np.ndarray:
    """Number of each bucket among the candidates, else -1; the last entry stands for no feature."""
    place = np.full((1 << BITS) + 1, -1, np.int64)
    place[candidates] = np.arange(len(candidates))
    return place


def held(features: np.ndarray, sentence_at: np.ndarray, place: np.ndarray, candidates: int) -> tuple[np.ndarray, np.ndarray]:
    """Sentence and candidate number of all candidates in sentences, each once a sentence, in order."""
    number = place[features]
    word, _ = at = np.nonzero(number >= 0)
    sentence = np.searchsorted(sentence_at, word, "right") - 1
    pairs = np.unique(sentence * max(1, candidates) + number[at])
    return pairs // max(1, candidates), pairs % max(1, candidates)


def _softplus(x):
    return np.logaddexp(0.0, x)


def noisy_or(logits: np.ndarray, text_of: np.ndarray, texts: int) -> np.ndarray:
    """1 minus the product of the sentences' 1 - p, by text; 0 for texts without sentences."""
    return -np.expm1(-np.bincount(text_of, _softplus(logits), texts))


class Bags:
    """Sentences that hold candidates (text of each, and feature by feature), the number of others, and the label, by text."""

    def __init__(self, text_of: np.ndarray, feature: np.ndarray, sentence_of: np.ndarray, others: np.ndarray, label: np.ndarray, features: int) -> None:
        self.text_of, self.feature, self.sentence_of, self.others, self.label, self.features = text_of, feature, sentence_of, others, label, features

    def only(self, keep: np.ndarray) -> Bags:
        """The bags of some texts."""
        sentences = keep[self.text_of]
        words = sentences[self.sentence_of]
        renumbered = (np.cumsum(keep) - 1)[self.text_of[sentences]]
        return Bags(renumbered, self.feature[words], (np.cumsum(sentences) - 1)[self.sentence_of[words]], self.others[keep], self.label[keep], self.features)

    def loss(self, theta: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean log loss of the labels under noisy-or, and its gradient; the last of theta is the bias."""
        n = max(1, len(self.label))
        s = np.bincount(self.sentence_of, theta[self.feature], len(self.text_of)) + theta[-1]
        total = np.bincount(self.text_of, _softplus(s), len(self.label)) + self.others * _softplus(theta[-1])
        total = np.maximum(total, 1e-12)
        loss = np.where(self.label > 0, -np.log(-np.expm1(-total)), total).sum() / n
        pull = np.where(self.label > 0, -1.0 / np.expm1(np.minimum(total, 50.0)), 1.0) / n
        g = pull[self.text_of] / (1.0 + np.exp(-np.maximum(s, -50.0)))
        bias = g.sum() + (pull * self.others).sum() / (1.0 + np.exp(-max(theta[-1], -50.0)))
        return float(loss), np.append(np.bincount(self.feature, g[self.sentence_of], self.features), bias)


def fit(bags_: Bags, strength: float) -> np.ndarray:
    """Weights and, last, the bias: ROUNDS steps of Adam over all texts at once, weights that end near 0 cut off."""
    theta = np.zeros(bags_.features + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    theta[-1] = -6.0
    for t in range(1, ROUNDS + 1):
        _, grad = bags_.loss(theta)
        grad[:-1] += strength * np.sign(theta[:-1]) + L2 * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta -= 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    theta[:-1][np.abs(theta[:-1]) < 0.05] = 0.0
    return theta


def choose(bags_: Bags, apart: np.ndarray) -> np.ndarray:
    """Fit on all texts with the strength that loses least on the texts kept apart when only the others are fitted on."""
    if not apart.any() or apart.all():
        return fit(bags_, STRENGTHS[-2])
    rest, spare = bags_.only(~apart), bags_.only(apart)
    losses = [spare.loss(fit(rest, s))[0] for s in STRENGTHS]
    return fit(bags_, STRENGTHS[int(np.argmin(losses))])


def sample(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", bound: int = TRAIN_DOCS) -> DataFrame:
    """_key, _label, _text of at most `bound` labelled texts outside the held-out fifth, rows of equal id and text once; the label of an id is the largest it has.

    Only hashes are joined and put in order; the texts are then taken by hash.
    """
    key = F.xxhash64(F.lit(77), F.col(doc_id), F.col(text))
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col(doc_id))).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_label"))
    keyed = docs.select(F.col(doc_id).alias("_id"), key.alias("_key")).join(known, "_id").groupBy("_key").agg(F.max("_label").alias("_label"))
    chosen = materialize(keyed.orderBy("_key").limit(bound), "toxicity-keys")
    rows = docs.select(key.alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key")
    found = materialize(rows.groupBy("_key").agg(F.any_value("_label").alias("_label"), F.any_value("_text").alias("_text")), "toxicity-sample")
    discard(chosen)
    return found


def _apart() -> Column:
    return F.pmod("_key", F.lit(5)) == 0


def candidates(rows: DataFrame) -> np.ndarray:
    """Buckets of the features that texts of label 1 hold more often than others do, by G2 over the texts that are not kept apart."""

    def count(batches):
        total = np.zeros((2, 1 << BITS), np.int64)
        for b in batches:
            features, sentence_at, text_at, _, _ = bags(b.column(1))
            text_of = np.repeat(np.arange(b.num_rows), np.diff(sentence_at[text_at]))
            y = b.column(0).to_numpy(zero_copy_only=False) > 0
            at = np.nonzero(features >= 0)
            pairs = np.unique(text_of[at[0]] * (1 << BITS) + features[at])
            for side in (0, 1):
                total[side] += np.bincount(pairs[y[pairs >> BITS] == side] & ((1 << BITS) - 1), minlength=1 << BITS)
        some = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[1][some]), pa.array(total[0][some])], ["bucket", "a", "b"])

    rest = rows.where(~_apart())
    yes = rest.where("_label > 0").count()
    no = rest.count() - yes
    counts = rest.select("_label", "_text").mapInArrow(count, "bucket bigint, a bigint, b bigint").groupBy("bucket").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    part = lambda x, of: F.when(x > 0, x * F.log(x * F.lit(float(yes + no)) / (of))).otherwise(0.0)
    a, b = F.col("a"), F.col("b")
    held_by, lacked_by = a + b, yes + no - a - b
    g2 = 2 * (part(a, held_by * yes) + part(b, held_by * no) + part(yes - a, lacked_by * yes) + part(no - b, lacked_by * no))
    found = counts.where((g2 > SCREEN) & (a * no > b * yes)).select("bucket").toArrow()["bucket"].to_numpy()
    return np.sort(found)


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", bound: int = TRAIN_DOCS) -> Model | None:
    """Fit on at most `bound` labelled texts, whole: candidate buckets, their weights, bias; None without any. Numbers of candidates, not texts, come to the driver."""
    ready_for_python(docs.sparkSession)
    rows = sample(docs, labels, text=text, doc_id=doc_id, label=label, bound=bound)
    buckets = candidates(rows)

    def featurize(texts: pa.Array) -> pa.Array:
        features, sentence_at, text_at, _, _ = bags(texts)
        sentence, number = held(features, sentence_at, _numbered(buckets), len(buckets))
        at = np.searchsorted(sentence, text_at)
        local = sentence - np.repeat(text_at[:-1], np.diff(at))
        return pa.StructArray.from_arrays([pa.array(np.diff(text_at)), lists(local, at, pa.int64()), lists(number, at, pa.int64())], ["sentences", "at", "numbers"])

    kind = "struct<sentences:bigint,at:array<bigint>,numbers:array<bigint>>"
    table = rows.select("_key", "_label", _apart().alias("_apart"), F.arrow_udf(featurize, kind).asNondeterministic()("_text").alias("f")).select("_key", "_label", "_apart", "f.*").toArrow().sort_by("_key")
    discard(rows)
    if not table.num_rows:
        return None
    columns = {c: table[c].combine_chunks() for c in table.column_names}
    text_of = np.repeat(np.arange(table.num_rows), columns["at"].value_lengths().to_numpy())
    width = int(columns["sentences"].to_numpy().max()) + 1
    sentence, sentence_of = np.unique(text_of * width + columns["at"].flatten().to_numpy(), return_inverse=True)
    owner = sentence // width
    others = columns["sentences"].to_numpy() - np.bincount(owner, minlength=table.num_rows)
    label_ = columns["_label"].to_numpy().astype(float)
    theta = choose(Bags(owner, columns["numbers"].flatten().to_numpy(), sentence_of, others, label_, len(buckets)), columns["_apart"].to_numpy(zero_copy_only=False))
    return buckets, theta[:-1], float(theta[-1])


def score_column(text, model: Model | None):
    """struct<score, offending: array<struct<start, end, score>>>: start and end are bytes of the UTF-8 text; offending sentences score 0.5 or more."""
    buckets, weights, bias = model or (np.zeros(0, np.int64), np.zeros(0), -20.0)

    def run(texts: pa.Array) -> pa.Array:
        features, sentence_at, text_at, begin, end = bags(texts)
        n = len(text_at) - 1
        _, offsets = buffers(texts)
        sentence, number = held(features, sentence_at, _numbered(buckets), len(buckets))
        s = np.bincount(sentence, weights[number], len(begin)) + bias
        text_of = np.repeat(np.arange(n), np.diff(text_at))
        score = noisy_or(s, text_of, n)
        bad = np.flatnonzero(s >= 0)
        to = np.searchsorted(bad, text_at)
        first = offsets[text_of[bad]]
        spans = pa.StructArray.from_arrays([pa.array(begin[bad] - first), pa.array(end[bad] - first), pa.array(1 / (1 + np.exp(-s[bad])))], ["start", "end", "score"])
        return pa.StructArray.from_arrays([pa.array(np.clip(score, 0.0, 1.0)), pa.ListArray.from_arrays(pa.array(to, pa.int32()), spans)], ["score", "offending"])

    kind = "struct<score:double,offending:array<struct<start:bigint,end:bigint,score:double>>>"
    return F.arrow_udf(run, kind).asNondeterministic()(text)


def score_toxicity(docs: DataFrame, model, *, text: str = "text") -> DataFrame:
    """docs with score, predicted and offending, which replace columns of these names. Null texts and texts without words score 0; no shuffle."""
    ready_for_python(docs.sparkSession)
    out, held_ = docs.drop("score", "predicted", "offending"), fresh(docs, "_t")
    out = out.withColumn(held_, score_column(F.col(text), model))
    return out.select("*", f"{held_}.score", (F.col(f"{held_}.score") >= 0.5).cast("int").alias("predicted"), f"{held_}.offending").drop(held_)


def query(spark, sf_dir):
    """op7: scores of all texts. An empty table gives an empty result; without labels all scores are near 0."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score_toxicity(docs.withColumn("held_out", held_out(F.col("doc_id"))), model)
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))
