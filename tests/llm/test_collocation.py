"""Phrases against plain counting."""

import random
import re
from collections import Counter

import pytest

from fragloom.llm import collocation


def plain(rows, least, longest=5, contained=100):
    count = {}
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    count.setdefault(lang or "und", Counter())[tuple(w[i : i + k])] += 1
    out = {}
    for lang, f in count.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in good.items():
            inside = [q for q in good if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * good[q] >= contained * a for q in inside):
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                out[(lang, " ".join(p))] = (a, f[p[:k]], f[p[k:]], n, score)
    return out


def _texts():
    rnd = random.Random(8)
    words = ["the", "The", "of", "ring", "é", "É", "new", "york", "a\x00b", "new york city", "in order to", "日本", "x\x1f"]
    marks = [" ", " ", " ", "\t", "  ", ", ", "\n", ".", "\r\n", " \x0b", "! "]
    rows = [("".join(rnd.choice(words) + rnd.choice(marks) for _ in range(rnd.randrange(60))), rnd.choice(["en", "en", "de", None])) for _ in range(200)]
    rows += [(None, "en"), ("", None), (" \t.\n", "fr"), ("one", "xx"), (" ".join(["again"] * 3000), "en"), ("no space" * 2000, None)]
    return rows + rows[:20]


@pytest.mark.parametrize("chunk", [300, 8 << 20])
@pytest.mark.parametrize("contained", [100, 60])
def test_like_plain_counting(spark, monkeypatch, chunk, contained):
    """Nulls, empty and long texts, repeated rows, pieces, letters beyond ASCII; in many chunks and in one."""
    monkeypatch.setattr(collocation, "CHUNK", chunk)
    rows = _texts()
    found = collocation.collocations(spark.createDataFrame(rows, "text string, lang string").repartition(4), least=15, contained=contained).collect()
    got = {(r["lang"], r["phrase"]): (r["a"], r["l"], r["r"], r["n"], r["score"]) for r in found}
    assert len(got) == len(found) and got == plain(rows, 15, contained=contained) and len(got) > 20


def test_empty_table_and_clashing_names(spark):
    assert collocation.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    rows = [("a b c d", "en", "p", 5, "k")] * 4
    found = collocation.collocations(spark.createDataFrame(rows, "text string, lang string, phrase string, n long, _l string"), least=4).collect()
    assert [(r["phrase"], r["a"], r["words"]) for r in found] == [("a b c d", 4, 4)]


def test_scores_beyond_64_bits(spark):
    """The score's expression for counts whose products need more than 64 bits."""
    cases = [(10**12, 10**14, 10**12 + 7, 10**13), (999_999_999_999, 98_765_432_109_876, 999_999_999_999, 1_000_000_000_000), (100, 10**15, 100, 100)]
    df = spark.createDataFrame(cases, "a long, n long, l long, r long").selectExpr("*", f"{collocation.SCORE} AS score")
    assert [r["score"] for r in df.collect()] == [1000 * a * n // (left * r) for a, n, left, r in cases]


def test_map_has_every_frequent_phrase(spark):
    phrases = [("en", f"w{k} é") for k in range(5000)]
    bits = collocation.np.frombuffer(collocation.frequent_map(spark.createDataFrame(phrases, "lang string, phrase string")), collocation.np.uint8)
    assert len(bits) == 1 << (collocation.MAP_BITS - 3)
    assert collocation._is_frequent(b"en", [p.encode() for _, p in phrases], bits).all()
    assert not collocation._is_frequent(b"de", [p.encode() for _, p in phrases], bits)[:200].all()
