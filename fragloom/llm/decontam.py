"""Benchmark decontamination by BM25 over an inverted index of test items.

Every passage of every training text is a query. An item's impacts are divided
by the score of the item's own text, so a passage scores 1 that holds all of
the item's words, and one threshold serves all items. Passages are retrieved by
block-max WAND: its first test, whether the lists of the query can reach the
threshold at all, is made for all passages at once (lists of frequent words,
which cannot reach it alone, only raise the bound); the rest is walked pivot by
pivot. Retrieved passages count if they also hold the question and the answer,
or the item as a whole where no question mark parts it, or nearly all of it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from fragloom.llm.common import read, ready_for_python
from fragloom.llm.vectext import PLAIN, buffers, mix, tokens

K1, B = 1.2, 0.75
#: Share of an item's own score that a passage must reach.
THRESHOLD = 0.6
#: Share of the question's and of the answer's word runs that a passage must hold, and the length of a run.
OVERLAP, RUN = 0.6, 3
#: Share of the score and of the whole item's runs that make a hit whatever part the rest is in.
NEARLY = 0.9
#: Items of one index, which all tasks hold; more items make more passes over the texts.
INDEX_ITEMS = 5000
#: Items of one block of a list.
BLOCK = 16
#: Least words of a passage.
PASSAGE = 64

_question = re.compile(rb"\?[\s\"')\]]").search


def _hits(kind: str) -> str:
    """Type of the hits of items whose ids are of some type."""
    return f"array<struct<item:{kind},score:double,question_overlap:double,answer_overlap:double,word_start:bigint>>"


def _runs(words: np.ndarray) -> np.ndarray:
    n = min(RUN, len(words))
    if not n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            total += mix(words[j : j + len(total)], 31 + j)
    return np.unique(total)


def _share(part: np.ndarray, runs_of_passage: np.ndarray, words_of_passage: np.ndarray, n: int) -> float:
    if not len(part):
        return 1.0
    return float(np.isin(part, runs_of_passage if n >= RUN else _runs_of(words_of_passage, n)).mean())


def _runs_of(words: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(max(0, len(words) - n + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            total += mix(words[j : j + len(total)], 31 + j)
    return total


class Index:
    """Inverted lists of items with normalised impacts, their maxima by list and by block."""

    def __init__(self, texts: list[str], frequency: dict[int, int] | None = None, total: int | None = None, mean: float | None = None) -> None:
        column = pa.array(texts, pa.string())
        hashes, begin, _, at = tokens(column, True, PLAIN)
        data, offsets = buffers(column)
        self.words = [hashes[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        self.length = max([len(w) for w in self.words], default=0)
        # the answer is the last sentence, where there are several; only after a question mark is it one for sure
        self.parts, self.whole, self.asked = [], [], []
        for i, w in enumerate(self.words):
            own = begin[at[i] : at[i + 1]]
            raw = data[offsets[i] : offsets[i + 1]]
            stops = np.flatnonzero((raw[:-1] == 46) | (raw[:-1] == 33) | (raw[:-1] == 63) | (raw[:-1] == 10)) + offsets[i] if len(raw) else np.zeros(0, int)
            stops = stops[stops < own[-1]] if len(own) else stops
            cut = int(np.searchsorted(own, stops[-1])) if len(stops) else len(w)
            q, a = w[:cut], w[cut:]
            self.parts.append(((_runs(q), min(RUN, len(q))), (_runs(a), min(RUN, len(a)))))
            self.whole.append((_runs(w), min(RUN, len(w))))
            between = bytes(data[own[cut - 1] : own[cut]]) if 0 < cut < len(w) else b""
            self.asked.append(_question(between) is not None)
        distinct = [np.unique(w, return_counts=True) for w in self.words]
        if frequency is None:
            frequency, total, mean = statistics([self.words])
        avg = max(1.0, mean)
        rows = []
        for i, (terms, tf) in enumerate(distinct):
            df = np.array([frequency[t] for t in terms.tolist()], float)
            idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
            score = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(self.words[i]) / avg))
            if len(terms):
                rows.append((terms, np.full(len(terms), i), score / score.sum()))
        terms = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.uint64)
        items = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0, np.int64)
        weight = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0)
        order = np.lexsort((items, terms))
        self.items, self.weight = items[order], weight[order]
        self.terms, self.first = np.unique(terms[order], return_index=True)
        self.first = np.append(self.first, len(terms))
        self.most = np.maximum.reduceat(self.weight, self.first[:-1]) if rows else np.zeros(0)
        self.postings, self.blocks = [], []
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            ids, w = self.items[a:b].tolist(), self.weight[a:b].tolist()
            block: dict[int, float] = {}
            for i, x in zip(ids, w, strict=True):
                block[i // BLOCK] = max(block.get(i // BLOCK, 0.0), x)
            self.postings.append((ids, w))
            self.blocks.append(block)
        # frequent words: as many as stay, in every item, below the threshold with something to spare
        size = np.diff(self.first)
        self.limit, mass = 0, np.zeros(len(texts))
        self.spare = THRESHOLD
        for limit in sorted(set(size.tolist()), reverse=True):
            mass = np.bincount(self.items, self.weight * np.repeat(size >= limit, size), len(texts))
            if mass.max() > THRESHOLD - 0.25:
                break
            self.limit, self.spare = limit, THRESHOLD - mass
        self.rare = size < self.limit if self.limit else np.ones(len(size), bool)
        if np.isscalar(self.spare):
            self.spare = np.full(len(texts), self.spare)
        self.gate = np.zeros(1 << 16, bool)
        self.gate[self.terms >> np.uint64(48)] = True

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each word's list, or -1."""
        out = np.full(len(hashes), -1)
        maybe = np.flatnonzero(self.gate[hashes >> np.uint64(48)])
        at = np.minimum(np.searchsorted(self.terms, hashes[maybe]), max(0, len(self.terms) - 1))
        same = self.terms[at] == hashes[maybe] if len(self.terms) else np.zeros(0, bool)
        out[maybe[same]] = at[same]
        return out

    def retrieve(self, query: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """Items that the words (list numbers, distinct) score at least the threshold, by block-max WAND."""
        ends = 1 << 60
        cursors = [[self.postings[t][0][0], 0, t] for t in query.tolist()]
        found = []
        slack = threshold - 1e-9
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                bound += self.most[t]
                if bound >= slack:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            head = cursors[: pivot + 1]
            if sum(self.blocks[t].get(item // BLOCK, 0.0) for _, _, t in head) < slack:
                to = min((item // BLOCK + 1) * BLOCK, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else ends)
            elif head[0][0] == item:
                score = sum(self.postings[t][1][p] for _, p, t in head)
                if score >= slack:
                    found.append((item, score))
                to = item + 1
            else:
                to = item
            for c in head:
                ids, p = self.postings[c[2]][0], c[1]
                while p < len(ids) and ids[p] < to:
                    p += 1
                c[0], c[1] = (ids[p] if p < len(ids) else ends), p
            cursors = [c for c in cursors if c[0] < ends]
        return found

    def search(self, texts: pa.Array) -> list[list[tuple[int, float, float, float, int]]]:
        """For each text, its best passage for every item that it holds: item, score, overlaps, first word."""
        hashes, _, _, at = tokens(texts, True, PLAIN)
        out: list[list] = [[] for _ in range(len(at) - 1)]
        if not len(hashes) or not len(self.terms):
            return out
        half = max(PASSAGE // 2, self.length)
        lists_of = self.lookup(hashes)
        text_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
        cell_base = np.concatenate(([0], np.cumsum(np.diff(at) // half + 2)))
        hit = np.flatnonzero(lists_of >= 0)
        hit = hit[self.rare[lists_of[hit]]]
        if not len(hit):
            return out
        # a word is in the passage that begins in its cell and in the one that begins a cell before
        cell = cell_base[text_of[hit]] + (hit - at[text_of[hit]]) // half + 1
        term = lists_of[hit]
        near = self._candidates(np.concatenate((cell, cell - 1)), np.concatenate((term, term)))
        best: dict[tuple[int, int], tuple] = {}
        for c in near.tolist():
            i = int(np.searchsorted(cell_base, c, "right")) - 1
            a = at[i] + max(0, (c - cell_base[i] - 1) * half)
            b = min(at[i + 1], at[i] + (c - cell_base[i] + 1) * half)
            query = np.unique(lists_of[a:b])
            for item, score in self.retrieve(query[query >= 0]):
                words = hashes[a:b]
                runs = _runs_of(words, RUN)
                (q, nq), (x, nx) = self.parts[item]
                overlap = _share(q, runs, words, nq), _share(x, runs, words, nx)
                all_runs, n = self.whole[item]
                whole = _share(all_runs, runs, words, n)
                if min(overlap) >= OVERLAP or (whole >= OVERLAP and not self.asked[item]) or min(whole, score) >= NEARLY:
                    best[i, item] = max(best.get((i, item), (0.0,)), (score, *overlap, int(a - at[i])))
        for (i, item), (score, q, x, start) in sorted(best.items()):
            out[i].append((item, score, q, x, start))
        return out

    def _candidates(self, passage: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Passages whose words can reach the threshold for some item, by their less frequent words."""
        reach = np.unique(passage, return_inverse=True)
        bound = np.bincount(reach[1], self.most[term])
        keep = bound[reach[1]] >= self.spare.min() - 1e-9
        passage, term = passage[keep], term[keep]
        if not len(passage):
            return passage
        count = (self.first[1:] - self.first[:-1])[term]
        to = np.repeat(self.first[:-1][term] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        key, at = np.unique(np.repeat(passage, count) * len(self.words) + self.items[to], return_inverse=True)
        score = np.bincount(at, self.weight[to])
        return np.unique(key[score >= self.spare[key % len(self.words)] - 1e-9] // len(self.words))


def statistics(blocks) -> tuple[dict[int, int], int, float]:
    """Items that hold each word, number of items and their mean length, over all blocks of items' words."""
    frequency: dict[int, int] = {}
    total = length = 0
    for block in blocks:
        for words in block:
            total, length = total + 1, length + len(words)
            for t in np.unique(words).tolist():
                frequency[t] = frequency.get(t, 0) + 1
    return frequency, total, length / max(1, total)


def indexes(spark: SparkSession, items: DataFrame, item_id: str, text: str) -> list[tuple[list[int], Index]]:
    """One index for every INDEX_ITEMS items, with word statistics over all. Null texts and texts without words are in no list."""
    items = items.where(F.col(text).isNotNull()).select(F.col(item_id).alias("i"), F.col(text).alias("t"))
    blocks = max(1, -(-items.count() // INDEX_ITEMS))
    parts = []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).orderBy("i", "t").collect()
        if rows:
            parts.append(([r["i"] for r in rows], [r["t"] for r in rows]))
    if len(parts) == 1:
        return [(parts[0][0], Index(parts[0][1]))]

    def words():
        for _, texts in parts:
            hashes, _, _, at = tokens(pa.array(texts, pa.string()), True, PLAIN)
            yield [hashes[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    known = statistics(words())
    return [(ids, Index(texts, *known)) for ids, texts in parts]


def hits_column(text, ids: list, index: Index, kind: str = "bigint"):
    """The items that a text column holds; kind: the type of their ids."""
    item = to_arrow_type(DataType.fromDDL(kind))

    def run(texts: pa.Array) -> pa.Array:
        names = ["item", "score", "question_overlap", "answer_overlap", "word_start"]
        rows = [[dict(zip(names, (ids[x[0]], *x[1:]), strict=True)) for x in hits] for hits in index.search(texts)]
        fields = [("item", item), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("word_start", pa.int64())]
        return pa.array(rows, pa.list_(pa.struct(fields)))

    return F.arrow_udf(run, _hits(kind)).asNondeterministic()(text)


def contaminated(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs with `hits`, the items that each text holds, which replaces a column of that name. Whole texts; no shuffle.

    Null and empty texts, and an empty table of items, give no hits. Items with
    equal texts are each reported.
    """
    ready_for_python(docs.sparkSession)
    kind = dict(items.dtypes)[item_id]
    out = docs.drop("hits").withColumn("hits", F.array().cast(_hits(kind)))
    for ids, index in indexes(docs.sparkSession, items, item_id, item_text):
        out = out.withColumn("hits", F.concat("hits", hits_column(F.col(text), ids, index, kind)))
    return out


def query(spark, sf_dir):
    """op10: every document and item that it holds; documents without any have no row."""
    found = contaminated(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("h")).select("doc_id", F.col("h.item").alias("item_id"), "h.score", "h.question_overlap", "h.answer_overlap", "h.word_start")
