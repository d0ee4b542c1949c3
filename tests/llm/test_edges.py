"""Cases at the edges: numerals, columns with any name, ids that are no numbers; training against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fragloom.llm import fingerprint, language, mixing, toxicity, urls


def test_numerals_are_no_letters(corpus, spark):
    """½, ², Ⅷ and digits of any script are no letters; a single letter after many of them is one."""
    odd = ["½ 12", "² 3", "Ⅷ", "٣٤", "①②", "_ -", "12ª", "½½½½ é", "Ⅷ日", "", None]
    model = language.train(corpus)
    out = language.identify(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"), model).collect()
    for r in out:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not lettered) and (r["score"] > 0) == lettered, r["text"]
    assert sum(r["lang_pred"] == "und" for r in out) == 8


@pytest.mark.parametrize("names", [["_l", "_t", "_rule", "_source", "_key"], ["_L", "_T", "_RULE", "_SOURCE", "_source_"]])
def test_own_columns_are_kept_whatever_their_names(corpus, spark, names):
    docs = corpus.withColumns({n: F.lit(f"own {n}") for n in names})
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, None), (3, "http://b.com/de/y")], "page_id long, url string").withColumns({n: F.lit(f"own {n}") for n in names})
    labels = corpus.select("doc_id", F.lit(0).alias("toxic")).where("doc_id is not null").distinct()
    for out in (mixing.assign_copies(docs), language.identify(docs, language.train(docs)), toxicity.score_toxicity(docs, toxicity.train(docs, labels)), urls.filter_urls(pages)):
        rows = out.select(*names).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(f"own {n}" for n in names)]
        assert out.count() == (pages if "page_id" in out.columns else docs).count()


@pytest.mark.parametrize("kind", ["string", "double", "timestamp"])
def test_next_rows_refuse_keys_that_are_no_whole_numbers(spark, kind):
    rows = spark.range(5).select(F.col("id").cast(kind).alias("k"), F.lit("x").alias("text"))
    with pytest.raises(ValueError, match="not a whole number"):
        fingerprint.with_next(rows, "k", fingerprint.fingerprints)


def test_training_is_ftrl_with_elastic_net_and_the_best_temperature():
    """Weights by the textbook's update, one feature and class at a time; temperature by trying all."""
    rnd = random.Random(4)
    languages, rows, labels = ["de", "en", "fr"], [], []
    for _ in range(40):
        label = rnd.randrange(3)
        keys = sorted(rnd.sample(range(30), 6) + [100 + 7 * label])
        share = np.array([rnd.random() + 0.1 for _ in keys])
        rows.append((np.array(keys, np.int64), share / share.sum()))
        labels.append(label if rnd.random() < 0.9 else (label + 1) % 3)
    documents = np.zeros(1 << language.BITS)
    for keys, _ in rows:
        documents[keys] += 1
    model = language.fit(rows, np.array(labels), languages, documents, len(rows))

    z, n = {}, {}

    def weight(j, c):
        zz = z.get((j, c), 0.0)
        if abs(zz) <= language.L1:
            return 0.0
        return -(zz - math.copysign(language.L1, zz)) / ((language.BETA + math.sqrt(n.get((j, c), 0.0))) / language.ALPHA + language.L2)

    idf = lambda j: math.log((1 + len(rows)) / (1 + documents[j])) + 1
    features = [[*[(int(j), language.SCALE * float(s) * idf(j)) for j, s in zip(*row, strict=True)], ("bias", 1.0)] for row in rows]
    soft = lambda x, t=1.0: [math.exp(v / t) / sum(math.exp(u / t) for u in x) for v in x]
    logits = lambda f: [sum(x * weight(j, c) for j, x in f) for c in range(3)]
    for _ in range(language.EPOCHS):
        for i, f in enumerate(features):
            if i % 5 == 4:
                continue
            p = soft(logits(f))
            old = {(j, c): weight(j, c) for j, _ in f for c in range(3)}
            for j, x in f:
                for c in range(3):
                    g = x * (p[c] - (labels[i] == c))
                    sigma = (math.sqrt(n.get((j, c), 0.0) + g * g) - math.sqrt(n.get((j, c), 0.0))) / language.ALPHA
                    z[(j, c)] = z.get((j, c), 0.0) + g - sigma * old[(j, c)]
                    n[(j, c)] = n.get((j, c), 0.0) + g * g
    for j in {*range(30), 100, 107, 114}:
        assert model.table[j] == pytest.approx([weight(j, c) * idf(j) for c in range(3)], rel=1e-4, abs=1e-5)
    assert model.bias == pytest.approx([weight("bias", c) for c in range(3)])
    apart = [i for i in range(40) if i % 5 == 4]
    sure = (len(apart) + 1) / (len(apart) + 2)
    loss = lambda t: -sum((sure if labels[i] == c else (1 - sure) / 2) * math.log(max(1e-12, soft(logits(features[i]), t)[c])) for i in apart for c in range(3)) / len(apart)
    best = min(np.geomspace(0.02, 20, 161), key=lambda t: loss(float(t)) if t > 0.15 else 9e9)
    assert model.temperature == pytest.approx(float(best))
