"""Token counts with a whole-token shortcut.

Offline, each vocabulary string is run through the merges; those that come out
as one token are proved whole. Texts are cut into pre-tokens by the tokenizer's
own pattern; a pre-token that is proved whole counts 1, and only the rest is
merged, with the results kept. The cut is proved as well: for each character
met for the first time, the library must cut around it as the pattern does;
texts with other characters, or with special strings, go to the library.
"""

from __future__ import annotations

import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fragloom.llm.common import read, ready_for_python

#: Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens whose counts a worker keeps; beyond it, it begins anew.
KEPT = 600_000
#: Characters of the longest piece that is remembered, so that what a worker remembers is bounded in bytes too.
LONG = 64
LIMIT = 1024


def byte_characters() -> list[str]:
    """The printable character that byte-level BPE writes for each byte: itself for visible Latin-1, else the next of U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in visible else spare))
        spare += b not in visible
    return out


class Counter:
    """Counts tokens of texts as the tokenizers library does by default, without added special tokens."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        self.special = [x["content"] for x in settings.get("added_tokens", [])]
        cut = settings.get("pre_tokenizer") or {}
        self.shortcut = settings["model"]["type"] == "BPE" and not settings.get("normalizer") and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        self.chars = byte_characters()
        self.find = regex.compile(PATTERN).findall
        self.whole = self._prove(settings["model"]["vocab"]) if self.shortcut else {}
        self.known = dict(self.whole)
        self.proved: set[str] = set()
        self.refused: set[str] = set()

    def _prove(self, vocabulary: dict) -> dict[str, int]:
        byte_of, out = {c: b for b, c in enumerate(self.chars)}, {}
        for piece in vocabulary:
            if piece in self.special or any(c not in byte_of for c in piece):
                continue
            try:
                text = bytes(byte_of[c] for c in piece).decode()
            except UnicodeDecodeError:
                continue
            if len(self.model.tokenize(piece)) == 1:
                out[text] = 1
        return out

    def _merged(self, piece: str) -> int:
        return len(self.model.tokenize("".join([self.chars[b] for b in piece.encode()])))

    def _cut_alike(self, char: str) -> bool:
        """Does the library put this character into the same class as the pattern?"""
        for sample in (f"a{char}b", f"1{char}2", f"!{char}?", f" {char} {char}", f"a{char}"):
            ours = self.find(sample)
            if [x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(sample)] != ["".join(self.chars[b] for b in x.encode()) for x in ours]:
                return False
        return True

    def count(self, text: str) -> int:
        fresh = set(text) - self.proved
        for char in fresh - self.refused:
            (self.proved if self._cut_alike(char) else self.refused).add(char)
        if not self.shortcut or fresh & self.refused or any(x in text for x in self.special):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        pieces = self.find(text)
        counts = list(map(self.known.get, pieces))
        if None in counts:
            if len(self.known) > KEPT:
                self.known = dict(self.whole)
            for i, c in enumerate(counts):
                if c is None:
                    piece = pieces[i]
                    c = self.known.get(piece)
                    if c is None:
                        c = self._merged(piece)
                        if len(piece) <= LONG:
                            self.known[piece] = c
                    counts[i] = c
        return sum(counts)


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_count(text, path: str):
    """Tokens of a text column; null counts as empty. The vocabulary file must be at path on every worker."""

    def run(texts: pa.Array) -> pa.Array:
        count = counter(path).count
        return pa.array([count(x or "") for x in texts.to_pylist()], pa.int64())

    return F.arrow_udf(run, "bigint")(text)


def count_tokens(docs: DataFrame, path: str, *, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit, which replace columns of these names. Whole texts; no shuffle."""
    ready_for_python(docs.sparkSession)
    n_bytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    out = docs.withColumn("n_bytes", n_bytes).withColumn("n_tokens", token_count(F.col(text), path))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir):
    """op6: tokens of every text. An empty table gives an empty result."""
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")
