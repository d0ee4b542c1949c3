"""Joins against plain code: nearest in time, overlaps of fragments and their chains."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fragloom.kernels.wordwise import assemble_words
from fragloom.operators import enrich, overlap

T0 = datetime(2025, 3, 16, tzinfo=UTC)


def _nearest(left, right, within):
    out = []
    for i, k, t in left:
        near = [(abs(t - s).total_seconds(), n, s) for n, kk, s in right if k is not None and kk == k and t is not None and s is not None and (within is None or abs(t - s).total_seconds() <= within)]
        out.append((i, min(near)[1] if near else None, min(near)[0] if near else None, len(near)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("within", [3600, 40, 0, None])
@pytest.mark.parametrize("cell_rows", [5, 200_000])
def test_nearest_like_plain_code(spark, monkeypatch, within, cell_rows):
    """One key with most rows, equal times, rows at the very edge, null keys and times, repeated rows, cells dealt out."""
    monkeypatch.setattr(enrich, "CELL_ROWS", cell_rows)
    rnd = random.Random(2)
    time = lambda: T0 + timedelta(seconds=rnd.choice([rnd.randrange(40_000), rnd.randrange(0, 40_000, 3600), rnd.randrange(300) / 10]))
    key = lambda: rnd.choice(["hot"] * 6 + ["a", "b", None])
    left = [(i, key(), None if i % 50 == 7 else time()) for i in range(250)] + [(9000, "hot", T0)] * 3
    right = [(n, key(), None if n % 40 == 3 else time()) for n in range(200)]
    a = spark.createDataFrame(left, "row_id long, k string, t timestamp").withColumn("m", F.create_map(F.lit("x"), F.lit(1))).repartition(3)
    b = spark.createDataFrame(right, "n long, k string, s timestamp").repartition(2)
    got = enrich.nearest(a, b, ["k"], "t", "s", ["n"], within=within)
    assert got.columns == ["row_id", "k", "t", "m", "near_n", "near_s", "distance", "candidates"]
    assert sorted([(r["row_id"], r["near_n"], r["distance"], r["candidates"]) for r in got.collect()], key=repr) == _nearest(left, right, within)


def test_nearest_of_nothing(spark):
    a = spark.createDataFrame([(1, "x", T0)], "row_id long, k string, t timestamp")
    none = spark.createDataFrame([], "n long, k string, s timestamp")
    assert [tuple(r)[3:] for r in enrich.nearest(a, none, ["k"], "t", "s", ["n"]).collect()] == [(None, None, None, 0)]
    assert enrich.nearest(a.limit(0), none, ["k"], "t", "s", ["n"]).count() == 0


def test_nearest_forms_no_pairs(spark):
    """10,000 rows of each side under one key within the reach: no operator makes more rows than a few for each row."""
    a = spark.range(10_000).select(F.col("id").alias("row_id"), F.lit("k").alias("k"), F.timestamp_micros(F.col("id") * 1000).alias("t"))
    b = spark.range(10_000).select(F.col("id").alias("n"), F.lit("k").alias("k"), F.timestamp_micros(F.col("id") * 1000 + 300).alias("s"))
    plan = enrich.nearest(a, b, ["k"], "t", "s", ["n"])
    assert plan.agg(F.sum("candidates")).first()[0] == 10_000**2 and plan.where("near_n != row_id").count() == 0
    rows = [plan._jdf.queryExecution().executedPlan()]
    assert "CartesianProduct" not in rows[0].toString() and "NestedLoop" not in rows[0].toString()


def _fragments(words, width=5, every=1):
    n = len(words)
    return [(i * 10 // n * 10, i, " ".join(words[i : i + width])) for i in range(0, max(1, n - width + 1), every)]


def _plain_pairs(rows):
    """Every pair of fragments compared."""
    seen = {}
    for g, pos, no, text in rows:
        at = seen.setdefault((g, pos, text), no)
        seen[(g, pos, text)] = min(at, no)
    nodes = [(g, pos, no, text.split(" ")) for (g, pos, text), no in seen.items() if text is not None]
    out = set()
    for g, pos, no, w in nodes:
        best = []
        for h, p, n, v in nodes:
            if h == g and (p, n) > (pos, no):
                k = max((k for k in range(1, min(len(w), len(v)) + 1) if w[-k:] == v[:k]), default=0)
                if k:
                    best.append((-k, p, n))
        if best:
            k, p, n = min(best)
            out.add((g, pos, no, p, n, -k))
    return out


def _frame(spark, rows):
    return spark.createDataFrame([(f"u{g}", "d", "en", 1, pos, no, text) for g, pos, no, text in rows], "url string, date string, lang string, type smallint, pos smallint, line_no long, text string").repartition(3)


def test_pairs_like_comparing_all(spark):
    """Frequent words, repeated fragments, one word, equal texts at other positions, null and empty texts, clashing groups."""
    rnd = random.Random(6)
    rows = []
    for g in range(4):
        words = [rnd.choice(["a", "b", "a", "c", f"w{rnd.randrange(30)}"]) for _ in range(50)]
        rows += [(g, pos, no, text) for pos, no, text in _fragments(words, rnd.choice([1, 3, 6]))]
    rows += [(0, 0, 900, "a b a"), (0, 0, 901, "a b a"), (1, 90, 902, ""), (1, 90, 903, None), (1, 90, 904, "zz"), (5, 0, 0, "again again"), (5, 10, 1, "again again"), (5, 10, 2, "again again")]
    got = overlap.overlap_pairs(_frame(spark, rows)).collect()
    assert {(int(r["url"][1:]), r["pos"], r["line_no"], r["next_pos"], r["next_line"], r["overlap"]) for r in got} == _plain_pairs(rows) and len(got) == len(_plain_pairs(rows))
    assert overlap.overlap_pairs(_frame(spark, rows).limit(0)).count() == 0
    assert overlap.overlap_chains(_frame(spark, rows).limit(0)).count() == 0


def test_chains_are_the_kernel_s_texts_where_overlaps_are_unique(spark):
    rnd, rows, want = random.Random(9), [], {}
    for g, n in enumerate([1, 2, 7, 40, 150, 333]):
        words = [f"w{g}x{i}" for i in range(n)]
        own = _fragments(words, rnd.choice([4, 6]), rnd.choice([1, 2, 3]))
        rows += [(g, *f) for f in own] + [(g, *own[0])] * 2
        want[f"u{g}"] = assemble_words([(p, t) for p, _, t in sorted(own)]).text
    got = overlap.chain_texts(overlap.overlap_chains(_frame(spark, rows))).collect()
    assert {r["url"]: r["text"] for r in got} == want and len(got) == len(want)
    assert all(r["words"] == len(r["text"].split(" ")) for r in got) and sum(r["copies"] for r in got) == len(rows)


def test_chains_place_every_fragment_once(spark):
    """Where chains meet, each fragment is in exactly one, at the words that it has."""
    rnd = random.Random(3)
    words = [rnd.choice("abcdefgh") for _ in range(120)]
    rows = [(0, *f) for f in _fragments(words, 4)] + [(1, 0, 0, "x y"), (1, 0, 1, "q y"), (1, 10, 2, "y z")]
    chains = overlap.overlap_chains(_frame(spark, rows))
    placed = chains.collect()
    assert len({(r["url"], r["pos"], r["line_no"]) for r in placed}) == len(placed)
    texts = {(r["url"], r["chain_pos"], r["chain_line"]): r["text"].split(" ") for r in overlap.chain_texts(chains).collect()}
    for r in placed:
        w = r["text"].split(" ")
        assert texts[(r["url"], r["chain_pos"], r["chain_line"])][r["start"] : r["start"] + len(w)] == w
    assert sorted(" ".join(t) for (u, *_), t in texts.items() if u == "u1") == ["q y z", "x y"]


def test_uncontained_like_searching_every_body(spark):
    """Runs of words, fragments that begin within a word or cross a paragraph, repeated ones, graphemes, groups without body, nulls."""
    from fragloom.operators import audit

    rnd, bodies, rows = random.Random(5), [], []
    for g in range(6):
        paragraphs = [" ".join(rnd.choice(["aa", "ab", "b", "caa", "é"]) for _ in range(rnd.randrange(1, 30))) for _ in range(3)]
        kind = 1 if g % 3 else 2
        bodies.append((f"u{g}", "d", "en", kind, "\n\n".join(paragraphs)))
        whole = bodies[-1][4]
        for i in range(60):
            at = rnd.randrange(len(whole))
            text = whole[at : at + rnd.randrange(1, 25)] if i % 2 else " ".join(rnd.choice(["aa", "ab", "b", "caa", "é"]) for _ in range(rnd.randrange(1, 4)))
            rows += [(f"u{g}", "d", "en", kind, i, text)] * rnd.choice([1, 1, 3])
    rows += [("none", "d", "en", 1, 0, "aa"), (None, "d", "en", 1, 0, "aa"), ("u1", "d", "en", 1, 99, None), ("u1", "d", "en", 1, 98, "")]
    fragments = spark.createDataFrame(rows, "url string, date string, lang string, type smallint, line_no long, text string").repartition(3)
    observations = spark.createDataFrame(bodies, "url string, observed_at string, lang string, type smallint, text string")
    body = {(u, k): t for u, _, _, k, t in bodies}
    want = sorted([r for r in rows if r[5] is None or (r[0], r[3]) not in body or r[5] not in body[(r[0], r[3])]], key=repr)
    got = audit.uncontained(fragments, observations)
    assert got.columns == fragments.columns and sorted([tuple(r) for r in got.collect()], key=repr) == want and 20 < len(want) < len(rows)
    assert audit.uncontained(fragments, observations.limit(0)).count() == len(rows) and audit.uncontained(fragments.limit(0), observations).count() == 0


def test_fragments_meet_bodies_packed(spark):
    """Whatever is searched in tasks and what meets by runs: the same fragments are lost, also where two files have a body of one key, and no table of runs of words is made where the search is enough."""
    from fragloom.operators import audit

    rnd, rows, bodies = random.Random(8), [], []
    for g in range(5):
        words = [rnd.choice(["aa", "ab", "b", "caa", f"w{k}"]) for k in range(300)]
        rows += [(f"u{g}", "d", "en", 1, 0, i, " ".join(words[max(0, i - 7) : i + 8])) for i in range(300)] + [(f"u{g}", "d", "en", 1, 0, 999, f"no such {g}")] * g
        half = [" ".join(words[:160]), " ".join(words[145:])]
        bodies += [(f"u{g}", "d", "en", 1, t) for t in (half if g % 2 else ["\n\n".join(half[::-1])])]
    rows.append((None, "d", "en", 1, 0, 0, "aa"))
    fragments = spark.createDataFrame(rows, "url string, date string, lang string, type smallint, pos smallint, line_no long, text string").repartition(4)
    observations = spark.createDataFrame(bodies, "url string, observed_at string, lang string, type smallint, text string")
    want = sorted([r for r in rows if not any(r[0] == b[0] and r[6] in b[4] for b in bodies)], key=repr)
    for budget in (10**9, 2_500, 0):
        got = audit.uncontained(fragments, observations, budget)
        assert sorted([tuple(r) for r in got.collect()], key=repr) == want and len(want) == 11
    known = fragments.where("url = 'u0'")
    assert audit.uncontained(known, observations)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
