import random

import pytest
from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus(spark):
    """Small documents with nulls in every column, empty and long texts, ties, repeated rows and near copies."""
    rnd = random.Random(5)
    vocabulary = {"en": ["the", "of", "shadow", "ring", "house", "Think", "water,", "and"], "de": ["der", "schön", "Haus", "über", "nicht", "Wasser.", "und"], "fr": ["le", "où", "maison", "être", "eau,", "dans", "et"]}
    rows, n = [], 0
    for lang, words in vocabulary.items():
        for k in range(60):
            text = " ".join(rnd.choice(words) + (str(rnd.randrange(40)) if rnd.random() < 0.5 else "") for _ in range(rnd.randrange(1, 90)))
            rows.append((n, text, lang, f"s{k % 4}", len(text)))
            n += 1
    for base in (3, 70, 130):  # near copies and exact ones
        words = rows[base][1].split(" ")
        for k in range(4):
            copy = list(words)
            copy[k % len(copy)] = f"changed{k}"
            rows.append((n, " ".join(copy), rows[base][2], "s0", 0))
            n += 1
        rows.append((n, rows[base][1], rows[base][2], None, 0))
        n += 1
    rows += [
        (n, None, "en", "s1", 0), (n + 1, "", "en", None, 0), (n + 2, "  \n\t ", None, "s2", 0), (n + 3, "12 34 !!", "fr", "s3", None), (n + 4, "word", None, None, None),
        (n + 5, " ".join(f"w{i}" for i in range(30000)), "en", "s1", None), (n + 6, "日本語 テキスト \U0001f600 é", None, "日", None), (None, "no id here", "en", "s1", None),
        (n + 7, rows[5][1], "en", "s1", 1), (n + 7, rows[5][1], "en", "s1", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def add_clashing(df):
    """Columns whose names clash with what operators add."""
    from pyspark.sql import functions as F

    names = ["size", "source_size", "target", "copies", "copy", "position", "shard", "slot", "score", "lang_pred", "hits", "fingerprint", "n_tokens", "over_limit", "n_bytes", "predicted", "offending", "verdict", "rule", "host", "path"]
    return df.select("*", *[F.lit("own").alias(n) for n in names if n not in df.columns])


__all__ = ["T"]
