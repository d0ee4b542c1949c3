"""Each operator against a plain version, with nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import itertools
import math
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fragloom.llm import chat, decontam, fingerprint, language, mixing, neardup, sharding, tokens, toxicity, urls
from tests.llm.conftest import add_clashing

WORD = re.compile("[^\x20\x09-\x0d]+")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# --- 1 mixing


def plain_targets(sizes, weights=(1, 2, 3), most=3.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > most * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in free}
            break
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= full
    return target


def test_mixing_targets_copies_and_reruns(corpus):
    out = rows_of(mixing.assign_copies(add_clashing(corpus)))
    assert len(out) == corpus.count()
    sizes = collections.Counter()
    for r in out:
        assert r["size"] == len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] += r["size"]
    expected = plain_targets(dict(sizes))
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        rate = min(3.0, r["target"] / r["source_size"]) if r["source_size"] else 0
        assert int(rate) <= r["copies"] <= int(rate) + 1 and r["copies"] <= 3
    again = rows_of(mixing.assign_copies(add_clashing(corpus).repartition(3)))
    key = lambda r: (r["doc_id"] or -1, r["text"] or "", r["copies"])
    assert sorted(map(key, out)) == sorted(map(key, again))
    assert mixing.mix(corpus).count() == sum(r["copies"] for r in out)


def test_mixing_comes_near_targets_and_caps(spark):
    docs = spark.range(30000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.when(F.col("id") < 1000, "a").when(F.col("id") < 20000, "b").otherwise("c").alias("source"))
    got = {r["source"]: r for r in rows_of(mixing.assign_copies(docs).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("k"), F.sum("size").alias("n")))}
    assert got["a"]["t"] == 12000 == got["a"]["k"]  # capped at three times
    for s in "bc":
        assert got[s]["k"] == pytest.approx(got[s]["t"], rel=0.03)
    assert sum(r["t"] for r in got.values()) == pytest.approx(120000)


def test_mixing_nothing(empty, spark):
    assert mixing.assign_copies(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {r["copies"] for r in rows_of(mixing.assign_copies(blank))} == {0}


# --- 2 chat


def plain_paths(messages):
    by_tree = collections.defaultdict(dict)
    for tree, i, parent, *_ in messages:
        by_tree[tree][i] = parent
    out = set()
    for tree, parents in by_tree.items():
        has_child = {p for i, p in parents.items() if p in parents}
        for leaf in parents.keys() - has_child:
            path, at, seen = [], leaf, set()
            while at in parents and at not in seen:
                seen.add(at)
                path.append(at)
                at = parents[at]
            if at not in seen:
                out.add((tree, leaf, tuple(path[::-1])))
    return out


MESSAGES = [("t", 1, None), ("t", 2, 1), ("t", 3, 2), ("t", 4, 2), ("t", 5, 4), ("t", 6, 5), ("t", 7, 5), ("t", 8, 9), ("t", 9, 8), ("t", 10, 9), ("u", 1, 99), ("u", 2, 1), ("v", 1, None)] + [("w", i, i - 1 or None) for i in range(1, 41)]


def test_paths_match_a_walk(spark):
    df = spark.createDataFrame(MESSAGES, "tree string, id long, parent long")
    got = collections.defaultdict(list)
    for r in chat.paths(df).collect():
        got[r["tree"], r["leaf"]].append((-r["back"], r["id"]))
    found = {(t, leaf, tuple(i for _, i in sorted(p))) for (t, leaf), p in got.items()}
    assert found == plain_paths(MESSAGES)


NASTY = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\n", "\\", "\\\\<|im_end|>\\", "<\\|im_end|>", "a\\n", "", None, "é日\U0001f600", "<|im_start|", "<<SYS>>\n\\<</SYS>>", "x" * 5000 + "\\" * 3]


def test_format_reads_back_and_masks(spark):
    rows, score = [], 0.0
    for n, text in enumerate(NASTY):
        rows += [("c", 2 * n + 1, 2 * n or None, ["user", "us\ner", None, "<|im_start|>\\"][n % 4], text, score), ("c", 2 * n + 2, 2 * n + 1, "assistant", text, score)]
    df = spark.createDataFrame(rows, "tree string, id long, parent long, role string, text string, score double")
    (r,) = chat.format_trees(add_clashing(df)).select("*", chat.turns(F.col("formatted")).alias("back")).collect()
    assert [(t["role"], t["text"]) for t in r["back"]] == [(x[3] or "", x[4] or "") for x in rows]
    unescape = lambda s: re.sub(r"(?s)\\(.)", r"\1", s)
    assert [unescape(r["formatted"][s["start"] : s["end"]]) for s in r["loss_spans"]] == [t or "" for t in NASTY]
    assert r["formatted"].count(chat.START) == r["formatted"].count(chat.END) == len(rows) == r["n_messages"]


def test_branches_rank_by_score(spark):
    df = spark.createDataFrame([("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "bad", 1.0), ("t", 3, 1, "assistant", "good", 5.0), ("t", 4, 1, "assistant", "same", 5.0)], "tree string, id long, parent long, role string, text string, score double")
    assert [(r["leaf"], r["rank"]) for r in chat.format_trees(df).orderBy("rank").collect()] == [(3, 1), (4, 2), (2, 3)]
    assert [r["leaf"] for r in chat.format_trees(df, best=1).collect()] == [3]


def test_chat_nothing(spark):
    none = spark.createDataFrame([], "tree string, id long, parent long, role string, text string, score double")
    assert chat.format_trees(none).count() == 0
    turns = spark.createDataFrame([(None, None, None, None), (None, 1, "user", "a"), (1, 1, "b", "x"), (1, 1, "a", "y"), (1, 1, "a", "y")], "conv_id long, turn long, role string, text string")
    out = {r["tree"]["conv_id"]: r["formatted"] for r in chat.format_trees(chat.conversation_trees(turns)).collect()}
    assert out[None] == "<|im_start|>\n<|im_end|>\n<|im_start|>user\na<|im_end|>\n"
    assert out[1].count("y") == 2 and out[1].index("y") < out[1].index("x")


# --- 3 sharding


def check_shards(rows, n, shards):
    assert len(rows) == n
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards_are_even_gapless_and_shuffled(corpus):
    n = corpus.count()
    for options in ({}, {"bucket_bytes": 2000, "block_bytes": 500}, {"bucket_bytes": 1 << 30, "block_bytes": 3000}):
        rows = rows_of(sharding.assign_shards(add_clashing(corpus), 16, **options))
        check_shards(rows, n, 16)
        assert all(r["size"] == "own" for r in rows)
    place = {r["doc_id"]: r["slot"] * 16 + r["shard"] for r in rows if r["doc_id"] is not None}
    ids = sorted(place)
    assert abs(np.corrcoef(ids, [place[i] for i in ids])[0, 1]) < 0.25


def test_shards_hold_with_repeated_rows(spark):
    docs = spark.range(3000).select(F.when(F.col("id") < 1500, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("same text again").alias("text"))
    check_shards(rows_of(sharding.assign_shards(docs, 16, bucket_bytes=4000, block_bytes=2000)), 3000, 16)


def places(docs, conf):
    """Position of every row under session settings, which are put back."""
    spark = docs.sparkSession
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return sorted((r["row"], r["shard"], r["slot"]) for r in rows_of(sharding.assign_shards(docs, 16, bucket_bytes=3000, block_bytes=1000)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_shards_agree_whatever_partitions_and_settings(spark):
    """Rows of one id and text, told apart by another column, are among them; a task that is run again has the same input as one of another partitioning."""
    rows = [(i, i if i % 3 else 7, f"text {i % 40 if i % 3 else 0} " * 3) for i in range(2000)]
    docs = spark.createDataFrame(rows, "row long, doc_id long, text string")
    first = places(docs.repartition(3), {"spark.sql.shuffle.partitions": "4"})
    assert first == places(docs.repartition(9), {"spark.sql.shuffle.partitions": "7"})
    assert first == places(docs.orderBy(F.desc("row")), {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.enabled": "false"})
    assert first == places(docs, {"spark.sql.autoBroadcastJoinThreshold": "-1"})


def test_shards_nothing_and_written(empty, corpus, tmp_path):
    assert sharding.assign_shards(empty).count() == 0
    sharding.write_shards(corpus, str(tmp_path / "out"), shards=4)
    assert len(list((tmp_path / "out").glob("shard=*/*.parquet"))) == 4
    assert corpus.sparkSession.read.parquet(str(tmp_path / "out")).count() == corpus.count()


# --- 4 language


def test_language_learns_and_abstains(corpus):
    model = language.train(corpus)
    out = rows_of(language.identify(add_clashing(corpus), model))
    assert len(out) == corpus.count()
    right = [r["lang_pred"] == r["lang"] for r in out if r["lang"] and r["text"] and re.search("[a-z]", r["text"])]
    assert sum(right) / len(right) > 0.95
    for r in out:
        assert 0 <= r["score"] <= 1
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not lettered)
        assert r["lang_pred"] in {"en", "de", "fr", "und"}


def test_language_sums_match_plain_loops(monkeypatch):
    texts = pa.array(["Ab é", None, "", "x", "日本\U0001f600", "longer text with ABC"])
    table = np.random.RandomState(0).rand((1 << language.BITS) + 1, 3).astype(np.float32)
    table[-1] = 0
    char, at = language.characters(texts)
    whole, n = language.totals(char, at, table)
    for i, t in enumerate(texts.to_pylist()):
        c1, a1 = language.characters(pa.array([t], pa.string()))
        assert len(c1) == len(t or "")
        expected = sum((table[language.ngrams(c1, a1, o, 0, len(c1))].sum(0) for o in language.ORDERS), np.zeros(3)) if len(c1) else np.zeros(3)
        assert np.allclose(whole[i], expected, rtol=1e-4)
        assert n[i] == sum(max(0, len(t or "") - o + 1) for o in language.ORDERS)
    monkeypatch.setattr(language, "WINDOW", 3000)  # several windows
    long = pa.array(["word of text " * 900, "end"])
    char, at = language.characters(long)
    small = language.totals(char, at, table)[0]
    monkeypatch.setattr(language, "WINDOW", 1 << 22)
    assert np.allclose(small, language.totals(char, at, table)[0], rtol=1e-3)


def test_language_idf_counts_all_labelled_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "fit", lambda rows, labels, languages, *counts: seen.append((len(rows), *counts)))
    docs = spark.createDataFrame([(i, "ab" if i % 2 else "abc", "en") for i in range(200)], "doc_id long, text string, lang string").repartition(3)
    language.train(docs, bound=20)
    known = [r["text"] for r in docs.where(~language.held_out(F.col("doc_id"))).collect()]
    ((fitted, documents, total),) = seen
    assert fitted <= 20 < total == len(known)
    assert sorted(documents[documents > 0].tolist()) == sorted([len(known)] * 3 + [known.count("abc")] * 3)


def test_language_sample_is_bounded(spark, monkeypatch):
    """Rows of one id, alike or not, are bounded by language, and reruns take the same."""
    taken = []
    monkeypatch.setattr(language, "fit", lambda parts, labels, *rest: taken.append((len(parts), np.bincount(labels).tolist())))
    docs = spark.range(900).select(F.lit(1).alias("doc_id"), F.concat(F.lit("words and text "), F.col("id") % 300).alias("text"), F.when(F.col("id") % 300 < 200, "en").otherwise("fr").alias("lang"))
    language.train(docs, bound=20)
    language.train(docs.repartition(7), bound=1000)
    assert taken[0][0] <= 40 and max(taken[0][1]) <= 20 and taken[1] == (300, [200, 100])


def test_language_nothing(empty, spark):
    assert language.train(empty) is None
    assert language.identify(empty, None).count() == 0
    assert [r["lang_pred"] for r in language.identify(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), None).collect()] == ["und"]
    only = spark.createDataFrame([(i, "some words here", "en") for i in range(40)], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.identify(only, language.train(only)).collect()} == {"en"}


# --- 5 fingerprints


def test_next_rows_and_edits(corpus):
    docs = corpus.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    got = rows_of(fingerprint.with_next(docs, "doc_id", fingerprint.fingerprints))
    ordered = sorted(rows_of(docs), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"]))
    expected = collections.Counter((r["doc_id"], r["text"], ordered[(i + 1) % len(ordered)]["text"]) for i, r in enumerate(ordered))
    assert collections.Counter((r["doc_id"], r["text"], r["next"]["text"]) for r in got) == expected
    by_text = {}
    for r in got:
        assert by_text.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"]
        assert re.fullmatch("[0-9a-f]{130}", r["fingerprint"])


def test_fingerprint_values():
    counts = collections.Counter()
    data = "Ein längerer Text, der sich wiederholt. ".encode() * 3
    for a, b, c in zip(data, data[1:], data[2:], strict=False):
        h = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2**32
        counts[((h ^ (h >> 15)) * 0x2C1B3C6D) % 2**32 >> 24] += 1
    assert fingerprint._counts(np.frombuffer(data, np.uint8)).tolist() == [counts[i] for i in range(256)]
    a, b = (pa.array([fingerprint.digest(np.frombuffer(x, np.uint8)).hex()]) for x in (data, data[:90] + b"other things entirely, quite unlike"))
    assert fingerprint.likeness(a, a)[0].as_py() == 1.0 and 0 <= fingerprint.likeness(a, b)[0].as_py() < 1
    assert fingerprint.digest(np.zeros(0, np.uint8)) == bytes(65)


def test_next_rows_with_clashing_names(corpus, monkeypatch):
    monkeypatch.setattr(fingerprint, "RANGE_BYTES", 1000)
    docs = corpus.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"])
    derive = lambda d: fingerprint.fingerprints(d.withColumn("next", F.lit("own")))
    out = fingerprint.with_next(docs, "doc_id", derive)
    assert out.columns.count("next") == 1
    ids = sorted(r["doc_id"] for r in docs.collect())
    assert {r["doc_id"]: r["next"]["_key"] for r in out.collect()} == dict(zip(ids, ids[1:] + ids[:1], strict=True))
    with pytest.raises(ValueError, match="_head"):
        fingerprint.with_next(docs, "doc_id", lambda d: fingerprint.fingerprints(d).withColumn("_head", F.lit(1)))


def test_ranges_are_found_in_two_steps(spark):
    bounds = [1, 4, 5, 9, 20, 21, 22, 30, 31, 40, 50]
    rows = spark.range(-3, 60).select("id", fingerprint._range_of(F.col("id"), bounds).alias("n")).collect()
    assert all(r["n"] == sum(b <= r["id"] for b in bounds) for r in rows)


def test_fingerprints_nothing(empty, spark):
    assert fingerprint.with_next(empty.select("doc_id", "text"), "doc_id", fingerprint.fingerprints).count() == 0
    one = spark.createDataFrame([(4, "only")], "doc_id long, text string")
    assert rows_of(fingerprint.with_next(one, "doc_id", fingerprint.fingerprints))[0]["next"]["text"] == "only"


# --- 6 tokens


def path(name):
    return pytest.importorskip("public_tokenizers").path(name)



def test_token_counts_match_the_library(corpus):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    out = rows_of(tokens.count_tokens(add_clashing(corpus), path("byte_bpe_50k.json"), limit=100))
    for r in out:
        assert r["n_tokens"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        assert r["n_bytes"] == len((r["text"] or "").encode()) and r["over_limit"] == (r["n_tokens"] > 100)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts_of_odd_texts(name):
    count = tokens.Counter(path(name))
    odd = ["<|endoftext|>a<|endoftext|>", "<|startoftext|> x", "don't I'LL 'S's  ''re", " \n\n\t x  y ", "a\x1cb\x1f c\x85d\xa0e", "½ Ⅷ ٣ 12345", "日本語テキスト", "\U0001f468\u200d\U0001f469 e\u0301", "\u2028\u3000x", "A" * 3000, "ÀÉ ß ŉ ǆ", "\x00\x01\ufffd\ue000"]
    for t in odd:
        assert count.count(t) == len(count.library.encode(t, add_special_tokens=False).ids), t
    assert tokens.counter(path(name)) is tokens.counter(path(name))


def test_tokens_nothing(empty):
    assert tokens.count_tokens(empty, path("byte_bpe_50k.json")).count() == 0


# --- 7 toxicity


def toxic_corpus(spark, n=1500):
    rng = np.random.RandomState(1)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(plain, 8)) for _ in range(rng.randint(1, 12))]
        bad = bool(rng.rand() < 0.25)
        if bad:
            at = rng.randint(len(sentences))
            sentences[at] += " " + rng.choice(["vile", "Nasty,", "rotten"]) if rng.rand() < 0.5 else f" insult{rng.choice(plain)}"
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_toxicity_learns_words_and_locates_sentences(spark):
    docs, labels, truth = toxic_corpus(spark)
    model = toxicity.train(docs, labels)
    out = rows_of(toxicity.score_toxicity(add_clashing(docs), model))
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        for s in r["offending"]:
            assert re.search("(?i)vile|nasty|rotten|insult", r["text"].encode()[s["start"] : s["end"]].decode())


def test_toxicity_bags():
    texts = pa.array(["One two. three!\nFOUR", None, "", "...", "é xylophones"])
    features, sentence_at, text_at, begin, end = toxicity.bags(texts)
    assert np.diff(text_at).tolist() == [3, 0, 0, 0, 1] and np.diff(sentence_at).tolist() == [2, 1, 1, 2]
    raw = "".join(x or "" for x in texts.to_pylist()).encode()
    assert [raw[a:b].decode() for a, b in zip(begin, end, strict=True)] == ["One two", "three", "FOUR", "é xylophones"]
    # beginnings of 4 and 5 bytes belong to longer words only
    assert (features >= 0).tolist() == [[True, False, False], [True, False, False], [True, True, False], [True, False, False], [True, False, False], [True, True, True]]
    again, _, _, _, _ = toxicity.bags(pa.array(["XYLOPHONIC"]))
    assert again[0, 1:].tolist() == features[-1, 1:].tolist() and again[0, 0] != features[-1, 0]


def plain_bags(rng, texts=40, features=7):
    """Texts as lists of sentences, which are sets of features, and what the operator makes of them."""
    bags = [[sorted(set(rng.integers(0, features, rng.integers(0, 4)).tolist())) for _ in range(rng.integers(0, 5))] for _ in range(texts)]
    labels = np.array([float(any(0 in s for s in b)) for b in bags])
    text_of, sentence_of, feature, others = [], [], [], np.zeros(texts)
    for i, b in enumerate(bags):
        for s in b:
            if s:
                feature += s
                sentence_of += [len(text_of)] * len(s)
                text_of.append(i)
            else:
                others[i] += 1
    return bags, labels, toxicity.Bags(np.array(text_of, int), np.array(feature, int), np.array(sentence_of, int), others, labels, features)


def plain_loss(bags, labels, theta):
    total = 0.0
    for b, y in zip(bags, labels, strict=True):
        clean = 1.0
        for s in b:
            clean *= 1 - 1 / (1 + math.exp(-(theta[-1] + sum(theta[f] for f in s))))
        clean = min(clean, 1 - 1e-12)
        total -= math.log(1 - clean) if y else math.log(clean)
    return total / len(bags)


def test_toxicity_loss_and_gradient_match_plain_loops():
    rng = np.random.default_rng(3)
    bags, labels, made = plain_bags(rng)
    theta = rng.normal(size=8)
    loss, gradient = made.loss(theta)
    assert abs(loss - plain_loss(bags, labels, theta)) < 1e-9
    for i in range(8):
        step = np.zeros(8)
        step[i] = 1e-5
        slope = (plain_loss(bags, labels, theta + step) - plain_loss(bags, labels, theta - step)) / 2e-5
        assert abs(slope - gradient[i]) < 1e-6
    keep = rng.random(40) < 0.5
    part = [b for b, k in zip(bags, keep, strict=True) if k]
    assert abs(made.only(keep).loss(theta)[0] - plain_loss(part, labels[keep], theta)) < 1e-9


def test_toxicity_fit_descends_and_finds_the_cause():
    rng = np.random.default_rng(4)
    bags, labels, made = plain_bags(rng, 400)
    theta = toxicity.fit(made, 1e-4)
    start = np.zeros(8)
    start[-1] = -6.0
    assert plain_loss(bags, labels, theta) < 0.2 * plain_loss(bags, labels, start) and theta[0] > 3 and abs(theta[1:-1]).max() < theta[0]


def test_toxicity_scores_match_plain_noisy_or(spark):
    docs, labels, _ = toxic_corpus(spark, 300)
    buckets, weights, bias = model = toxicity.train(docs, labels)
    known = dict(zip(buckets.tolist(), weights.tolist(), strict=True))
    for r in rows_of(toxicity.score_toxicity(docs.limit(60), model)):
        clean = 1.0
        for sentence in re.split(r"[.!?\n]", r["text"]):
            if not re.search("[0-9A-Za-z]", sentence):
                continue
            features = toxicity.bags(pa.array([sentence]))[0]
            z = bias + sum(known.get(f, 0.0) for f in set(features.ravel().tolist()))
            clean *= 1 - 1 / (1 + math.exp(-z))
        assert abs(r["score"] - (1 - clean)) < 1e-9


def test_toxicity_sample_is_bounded_and_takes_repeated_rows_once(spark):
    docs = spark.range(2000).selectExpr("1L as doc_id", "concat('text ', id % 50) as text")
    labels = spark.createDataFrame([(1, 0), (1, 1)], "doc_id long, toxic int")
    found = rows_of(toxicity.sample(docs, labels, bound=10))
    assert len(found) == 10 and {r["_label"] for r in found} == {1} and len({r["_text"] for r in found}) == 10
    assert sorted(r["_key"] for r in rows_of(toxicity.sample(docs.repartition(7), labels, bound=10))) == sorted(r["_key"] for r in found)
    assert len(rows_of(toxicity.sample(docs, labels, bound=1000))) == 50


def test_toxicity_nothing(empty, corpus, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(corpus, labels) is None
    assert toxicity.score_toxicity(empty, None).count() == 0
    assert all(r["score"] < 0.01 for r in rows_of(toxicity.score_toxicity(corpus, None)))
    odd = spark.createDataFrame([(None, 1), (3, None), (5, 1), (5, 0)], "doc_id long, toxic int")
    toxicity.train(corpus, odd)


# --- 8 URLs

URLS = [None, "", "no scheme", "HTTP://Sub.Example.ORG/es/x", "http://example.org/en/1?x", "http://a.org", "http://a.org/", "https://x.com/fr/1#a", "https://x.com/de/", "http://com/fr/", "http://xcom/fr/", "x://y.net/%C3%A9é\U0001f600", "a://b://c/d", "http://example.org/en/2", "http://u@h.org:80/p?q#r"]


def plain_rule(url):
    host = path_ = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path_ = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, rule in urls.RULES:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path_.startswith("/" + tail) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    return host, path_, best


def test_url_rules(spark):
    pages = add_clashing(spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string"))
    for r in rows_of(urls.filter_urls(pages)):
        host, path_, best = plain_rule(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path_, best and best[1])
        assert r["verdict"] in ("allow", "block") and (not best or r["verdict"] == best[0])


def test_url_model_matches_plain_counts(spark):
    text = [(f"http://a{i}.org/page/{i}", "allow") for i in range(40)] + [(f"http://b.com/xx{i}?Q=é", "block") for i in range(40)] + [("", "block"), (None, "allow")]
    decided = spark.createDataFrame(text, "url string, verdict string")
    symbols = urls.BEGIN + urls.OTHER + urls.SYMBOLS
    fold = lambda u: "^^^" + "".join(c if c in urls.SYMBOLS else "~" for c in u.lower())
    plain = collections.Counter()
    for u, v in text:
        f = fold(u or "")
        plain.update((f[i : i + 4], v) for i in range(len(f) - 3) if u)
    got = {r["gram"]: r for r in urls.gram_counts(decided).collect()}
    assert {(g, v): n for (g, v), n in plain.items()} == {(g, v): r[k] for g, r in got.items() for v, k in (("allow", "accepted"), ("block", "rejected")) if r[k]}
    table = np.random.RandomState(0).rand(urls.SIZE**urls.ORDER).astype(np.float32)
    for r in decided.select("url", urls.score_column(F.col("url"), table).alias("s")).collect():
        f = fold(r["url"] or "")
        codes = [sum(symbols.index(c) * urls.SIZE ** (3 - k) for k, c in enumerate(f[i : i + 4])) for i in range(len(f) - 3)]
        assert r["s"] == pytest.approx(float(np.mean(table[codes])) if codes else 0.0, rel=1e-5)
    p = np.exp(urls.markov(urls.gram_codes([g for g in got]), np.array([r["accepted"] for r in got.values()]))).reshape(-1, urls.SIZE)
    assert np.allclose(p.sum(1), 1, atol=1e-3)


def test_threshold_is_within_a_run_of_minima():
    assert urls.threshold_bin(np.array([3, 1, 1, 2, 1, 1, 1, 4])) == 5 and urls.threshold_bin(np.array([1, 2, 1])) == 0


def test_urls_are_told_apart(spark):
    rng = np.random.RandomState(2)
    rows = [(i, f"http://{'good' if i % 2 else 'spamfarm'}{rng.randint(99)}.{'org' if i % 2 else 'com'}/{'x' if i % 2 else 'de'}/{rng.randint(999)}") for i in range(400)]
    rows += [(1000 + i, f"http://{'good' if i % 2 else 'spamfarm'}{i}.net/x/{i}") for i in range(100)]
    out = rows_of(urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).where("rule is null"))
    assert np.mean([(r["verdict"] == "allow") == bool(r["page_id"] % 2) for r in out]) > 0.9
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


# --- 9 near duplicates


def plain_components(rows, words):
    sets = {}
    for n, (_, text) in enumerate(rows):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[n] = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    root = {n: n for n in sets}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in sets:
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for n in sets:
        i = rows[n][0]
        if i is not None:
            least[find(n)] = min(i, least.get(find(n), i))
    return [(rows[n][0], len(sets[n]), least.get(find(n)) if sets[n] else rows[n][0]) for n in sets]


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_match_all_pairs(corpus, words):
    rows = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    out = rows_of(neardup.near_duplicates(add_clashing(corpus), words=words))
    key = lambda t: tuple((x is not None, x or 0) for x in t)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out), key=key) == sorted(plain_components(rows, words), key=key)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def prefix_components(texts, words, share=(80, 100)):
    """(set size, smallest number in reach) of each text, from all pairs that share one of their rarest shingles; exact, and of another kind than sketches."""
    values, at = neardup.shingle_sets(pa.array(texts, pa.string()), words)
    number, rank_of = np.unique(values, return_inverse=True)
    frequency = np.bincount(rank_of)
    place = np.empty(len(number), int)
    place[np.lexsort((np.arange(len(number)), frequency))] = np.arange(len(number))
    sets = [np.sort(place[rank_of[a:b]]) for a, b in zip(at[:-1], at[1:], strict=True)]
    members = [set(x.tolist()) for x in sets]
    parent, lists = list(range(len(sets))), collections.defaultdict(list)

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    alike = {}
    for i, x in enumerate(sets):
        key = x.tobytes()
        if len(x) and key in alike:
            parent[i] = alike[key]
            continue
        alike[key] = i
        seen = set()
        for v in x[: len(x) - -(-len(x) * share[0] // share[1]) + 1].tolist():
            seen.update(lists[v])
            lists[v].append(i)
        for j in seen:
            y = sets[j]
            if min(len(x), len(y)) * share[1] >= max(len(x), len(y)) * share[0] and root(i) != root(j):
                both = len(members[i] & members[j])
                if both * share[1] >= share[0] * (len(x) + len(y) - both):
                    low, high = sorted((root(i), root(j)))
                    parent[high] = low
    return [(len(x), root(i)) for i, x in enumerate(sets)]


def families(rng, count):
    """Mutated copies of boilerplate, boilerplate with much or little of its own, short texts and texts of one's own; all with a pair of words in common."""
    base = [f"b{i}" for i in range(120)]
    texts = []
    for i in range(count):
        kind = rng.randint(5)
        if kind == 0:
            words = list(base)
            for at in rng.choice(120, rng.randint(0, 14), replace=False):
                words[at] = f"v{rng.randint(60)}"
        elif kind == 1:
            words = base + [f"o{i}x{j}" for j in range(rng.randint(1, 60))]
        elif kind == 2:
            words = [f"s{x}" for x in rng.randint(0, 4, rng.randint(1, 9))]
        elif kind == 3:
            words = [f"m{x}" for x in rng.randint(0, 300, rng.randint(5, 80))]
        else:
            words = [f"u{i % 400}x{j}" for j in range(60)] + [f"z{rng.randint(10**6)}" for _ in range(rng.randint(0, 9))]
        texts.append(" ".join([*words, "very common"]))
    return texts


def test_near_duplicates_of_families_match_exact_prefixes(spark, monkeypatch):
    """5,000 texts of which all share a shingle, and a third of which share most; many lists are left out, heavy keys and long lists are dealt."""
    monkeypatch.setattr(neardup, "SHORT", 10)
    texts = families(np.random.RandomState(4), 5000)
    few = texts[:300]
    assert [(n, c) for _, n, c in sorted(plain_components(list(enumerate(few)), 2))] == prefix_components(few, 2)
    out = rows_of(neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8), words=2))
    assert [(r["n_shingles"], r["component_id"]) for r in sorted(out, key=lambda r: r["doc_id"])] == prefix_components(texts, 2)


def test_near_duplicates_of_common_phrases(spark, monkeypatch):
    """Texts over 60 words only: pairs of words are frequent, runs of two sketch values are not, and few classes are of the crowd."""
    monkeypatch.setattr(neardup, "SHORT", 10)
    rng, texts, crowds = np.random.RandomState(6), [], []
    for _ in range(400):
        base = [f"w{i}" for i in rng.randint(0, 60, rng.randint(130, 250))]
        near = [w if rng.rand() > rng.choice([0.01, 0.04, 0.07]) else f"w{rng.randint(60)}" for w in base]
        texts += [" ".join(base), " ".join(near)]
    prefixes = neardup._crowded
    monkeypatch.setattr(neardup, "_crowded", lambda crowd, *more: crowds.append(crowd.count()) or prefixes(crowd, *more))
    out = rows_of(neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), words=2))
    assert [(r["n_shingles"], r["component_id"]) for r in sorted(out, key=lambda r: r["doc_id"])] == prefix_components(texts, 2)
    assert sum(r["doc_id"] != r["component_id"] for r in out) > 100 and crowds[0] < 80


def test_near_duplicates_of_a_family_form_few_pairs(spark, monkeypatch):
    """Copies of one text that share their edits, and 60 a little less like it than the threshold: pairs beyond the leaders are far fewer than 60 times the copies."""
    monkeypatch.setattr(neardup, "SHORT", 10)
    rng, texts, crossed = np.random.RandomState(8), [], []
    for i in range(860):
        words = [f"b{j}" for j in range(150)]
        for at in rng.choice(75, rng.randint(9, 13) if i < 60 else rng.randint(1, 8), replace=False):
            words[2 * at] = f"v{i % 16}x{at}"
        texts.append(" ".join(words))
    written = neardup.materialize

    def materialize(df, name):
        out = written(df, name)
        crossed.extend([out.count()] if name == "crossed" else [])
        return out

    monkeypatch.setattr(neardup, "materialize", materialize)
    out = rows_of(neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), words=2))
    expected = prefix_components(texts, 2)
    assert [(r["n_shingles"], r["component_id"]) for r in sorted(out, key=lambda r: r["doc_id"])] == expected
    assert collections.Counter(c for _, c in expected).most_common(1)[0][1] >= 800 and crossed[0] < 3 * len(texts)


def test_near_duplicates_count_runs_without_a_row_each(spark, monkeypatch):
    """Lists of a family are chosen with one row a class; runs of two values are those of a plain count."""
    monkeypatch.setattr(neardup, "SHORT", 10)
    rng, written, rows = np.random.RandomState(9), neardup.materialize, []
    base = np.sort(rng.randint(1, 2**62, 64))
    sketches = [np.sort(np.where(rng.rand(64) < rng.choice([0, 0.1, 0.5]), rng.randint(1, 2**62, 64), base))[: rng.choice([1, 2, 40, 64])].tolist() for _ in range(300)]
    classes = spark.createDataFrame([(i, len(x), 0, 0, 0, 0, x) for i, x in enumerate(sketches)], "node long, n long, p0 long, p1 long, p2 long, p3 long, sketch array<bigint>").repartition(3)

    def materialize(df, name):
        out = written(df, name)
        rows.append(out.count())
        return out

    monkeypatch.setattr(neardup, "materialize", materialize)
    listed = {r["node"]: r for r in neardup._listed(classes)[0].collect()}
    assert max(rows) <= len(sketches)
    often = collections.Counter(v for x in sketches for v in x[:32])
    few = {i: x for i, x in enumerate(sketches) if (n := sum(often[v] <= 10 for v in x[:32])) < 14 or n < 20 / 32 * min(len(x), 32)}
    runs = collections.Counter(pair for x in few.values() for pair in itertools.pairwise(x))
    for i, x in enumerate(sketches):
        single = [v for v in x[:32] if often[v] <= 10][:16]
        seldom = [pair for pair in itertools.pairwise(x) if runs[pair] <= 10] if i in few else []
        assert listed[i]["_rare"][: len(single)] == single and len(listed[i]["_rare"]) == len(single) + len(seldom)
        assert listed[i]["_crowd"] == (i in few and len(seldom) < 50)
    assert 20 < sum(r["_crowd"] for r in listed.values()) < len(few) < len(sketches)


def test_near_duplicates_of_the_tables(spark):
    """All documents of the largest test table: no link is lost (recall 1 there; the docstring has what is expected elsewhere)."""
    folder = "/root/testdata/sf0.1"
    if not os.path.exists(folder):
        pytest.skip("no tables")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    expected = prefix_components([t for _, t in rows], 2)
    out = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(neardup.near_duplicates(docs, words=2)))
    assert out == [(i, n, rows[c][0]) for (i, _), (n, c) in zip(rows, expected, strict=True)]


def test_near_duplicates_without_ids(spark):
    """Rows without an id are told apart by their texts; rows of one id and text are many."""
    rows = [(None, f"a b c d e f g h i j k l{i % 3}") for i in range(30)] + [(5, "one two three four five six")] * 200 + [(6, "one two three four five six")]
    out = rows_of(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2))
    assert len(out) == 231 and {r["component_id"] for r in out if r["doc_id"] is None} == {None} and {r["component_id"] for r in out if r["doc_id"]} == {5}


def test_near_duplicates_of_the_crowd_and_outside(spark, monkeypatch):
    """Boilerplate, and a copy with words of its own that are many among its smallest hashes, but not most."""
    monkeypatch.setattr(neardup, "SHORT", 10)
    base = " ".join(f"b{i}" for i in range(100))
    rows = [(0, base), *[(100 + i, base + "".join(f" o{i}x{j}" for j in range(32))) for i in range(60)]]
    copies = [base + "".join(f" c{k}x{j}" for j in range(24)) for k in range(8000)]
    values, at = neardup.shingle_sets(pa.array([base, *copies]), 2)
    common = np.isin(values, values[at[0] : at[1]])
    own = [32 - int(common[a : a + 32].sum()) for a in at[1:-1]]
    rows += [(1 + n, copies[k]) for n, k in enumerate([k for k, x in enumerate(own) if 14 <= x < 20][:3])]
    assert len(rows) > 61
    out = rows_of(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == sorted(plain_components(rows, 2))


def test_near_duplicates_nothing(empty):
    assert neardup.near_duplicates(empty).count() == 0


def test_connected_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101)]
    got = {r["node"]: r["label"] for r in neardup.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[103] == got[101] == got[100] == 100


# --- 10 decontamination

ITEMS = ["The quick brown fox jumps over thirteen lazy dogs near riverbanks. What did jumping foxes find yesterday? Golden berries everywhere.", "Zebras graze quietly under distant acacia trees beside crocodile ponds today.", "", "short one"]


def test_decontamination_catches_items_only(spark, corpus):
    filler = " ".join(f"filler{i % 97} and the of" for i in range(400))
    texts = [f"{filler} {ITEMS[0].upper()} {filler}", f"{ITEMS[1]}", f"{filler} {ITEMS[0].split('?')[0]} {filler}", filler, None, "", f"say short, one again {filler}"]
    docs = add_clashing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    items = spark.createDataFrame([*enumerate(ITEMS), (9, None), (10, ITEMS[1])], "item_id long, text string")
    got = {r["doc_id"]: sorted(h["item"] for h in r["hits"]) for r in rows_of(decontam.contaminated(docs, items))}
    assert got == {0: [0], 1: [1, 10], 2: [], 3: [], 4: [], 5: [], 6: [3]}
    assert all(not r["hits"] for r in rows_of(decontam.contaminated(corpus, items)))


def test_decontamination_with_text_ids(spark):
    docs = spark.createDataFrame([(1, f"before {ITEMS[1]} after"), (2, "nothing")], "doc_id long, text string")
    items = spark.createDataFrame([("zebra/1", ITEMS[1]), (None, ITEMS[0])], "item_id string, text string")
    assert {r["doc_id"]: [h["item"] for h in r["hits"]] for r in rows_of(decontam.contaminated(docs, items))} == {1: ["zebra/1"], 2: []}


def test_decontamination_needs_no_last_sentence_without_a_question():
    body = " ".join(f"word{i} own{i}" for i in range(9)) + ". "
    long = " ".join(f"long{i}" for i in range(40)) + "? "
    index = decontam.Index([body + "Golden berries.", body.replace("o", "u")[:-2] + "? Silver cherries taste.", long + "Forty two."])
    near = [body + "Golden cherries.", body + "Other end.", body, body.replace("o", "u") + "Nothing of this.", long + "Forty three."]
    got = [sorted(h[0] for h in hits) for hits in index.search(pa.array(near))]
    assert got == [[0], [0], [0], [], [2]]


def test_wand_retrieves_what_scoring_all_does():
    rng = np.random.RandomState(3)
    vocabulary = [f"t{i}" for i in range(150)]
    texts = [" ".join(rng.choice(vocabulary, rng.randint(3, 25))) for _ in range(120)]
    index = decontam.Index(texts)
    for _ in range(150):
        source = texts[rng.randint(len(texts))].split()
        query = index.lookup(decontam.tokens(pa.array([" ".join([*source[: rng.randint(1, len(source) + 1)], *rng.choice(vocabulary, 5)])]), True, decontam.PLAIN)[0])
        query = np.unique(query[query >= 0])
        score = np.zeros(len(texts))
        for t in query:
            score[index.items[index.first[t] : index.first[t + 1]]] += index.weight[index.first[t] : index.first[t + 1]]
        for threshold in (0.2, 0.5, 0.9):
            got = index.retrieve(query, threshold)
            assert sorted(i for i, _ in got) == np.flatnonzero(score >= threshold - 1e-9).tolist()
            assert all(s == pytest.approx(score[i]) for i, s in got)


def test_decontamination_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "INDEX_ITEMS", 7)
    items = spark.createDataFrame([(i, f"item{i} has several words{i} of its own{i} to hold") for i in range(40)], "item_id long, text string")
    docs = items.select((F.col("item_id") + 100).alias("doc_id"), F.concat(F.lit("before that "), "text", F.lit(" and after")).alias("text"))
    got = {r["doc_id"]: [h["item"] for h in r["hits"]] for r in decontam.contaminated(docs, items).collect()}
    assert got == {i + 100: [i] for i in range(40)}


def test_decontamination_nothing(spark, empty, corpus):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(corpus, none).where(F.size("hits") > 0).count() == 0
    assert decontam.contaminated(empty, none).count() == 0


def test_shingle_hashes_are_those_of_the_words():
    from fragloom.llm import vectext

    texts = pa.array(["a b", "A\tB ", None, "ab", "a  b c", "x" * 3, "é  b"] + ["long " * 5000])
    h, at = vectext.word_hashes(texts)
    words = [w.lower() for t in texts.to_pylist() for w in (t or "").encode().split()]
    assert len(h) == len(words) and len(set(zip(words, h.tolist(), strict=True))) == len(set(words)) == len(set(h.tolist()))
    assert np.diff(at).tolist() == [len((t or "").encode().split()) for t in texts.to_pylist()]
    old = vectext.CHUNK
    try:
        vectext.CHUNK = 7
        assert (vectext.word_hashes(texts)[0] == h).all()
    finally:
        vectext.CHUNK = old


def test_texts_are_whole(spark):
    """What stands at the end of a very long text counts."""
    filler = "calm words in a row. " * 40000
    assert hashlib.sha256(filler.encode()).hexdigest()
    docs = spark.createDataFrame([(1, filler + ITEMS[1]), (2, filler)], "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEMS[1])], "item_id long, text string")
    assert {r["doc_id"]: len(r["hits"]) for r in decontam.contaminated(docs, items).collect()} == {1: 1, 2: 0}
