"""Fields of metadata and URLs against Python's own functions."""

import html
import random
import re
from urllib.parse import parse_qsl, urlencode, urlsplit

from pyspark.sql import functions as F

from fragloom.functions import metadata, urls
from fragloom.functions.shipping import ship
from fragloom.sources import metadata as sources


def test_queries_are_decoded_sorted_and_encoded_again(spark):
    """%7Ea and ~a, %41 and A are one; broken escapes, repeated names, empty values, spaces and letters of any script."""
    rnd = random.Random(1)
    pieces = ["a", "B", "%41", "%7Ea", "~a", "*", "%2a", "+", "%20", "%", "%zz", "é", "%C3%A9", "=", "==", "&", "&&", "/", "?x", ".", "-", "_", "日", "utm_", "UTM_x=1", "fbclid=2", "gclid", "%26", "%3D"]
    queries = ["%7Ea=%41", "b=2&a=1&a=0", "q"] + ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(1, 9))) for _ in range(400)]
    rows = spark.createDataFrame([(i, f"HTTP://X.org?{q}#f") for i, q in enumerate(queries)], "i int, u string")
    got = {r["i"]: r["c"] for r in rows.select("i", urls.canonical_url(F.col("u")).alias("c")).collect()}
    for i, q in enumerate(queries):
        kept = sorted((k, v) for k, v in parse_qsl(q, keep_blank_values=True) if not k.lower().startswith("utm_") and k.lower() not in ("fbclid", "gclid"))
        assert got[i] == "http://x.org/" + ("?" + urlencode(kept) if kept else ""), q
        assert urlsplit(got[i]).netloc == "x.org"


def test_languages_are_in_title_case(spark):
    odd = ["haitian-creole", "o'neil_x", "old norse", "ÉCOLE d'été", "a1b2c", "x--y", "ЮЖНЫЙ язык", "zz", "日本go", "o’x"]
    got = spark.createDataFrame(list(enumerate(odd)), "i int, l string").select("i", metadata.normalize_language(F.col("l")).alias("n")).collect()
    assert [r["n"] for r in sorted(got)] == [x.replace("_", " ").title() for x in odd]


def _record(**fields):
    f = [""] * 27
    f[0], f[1], f[2], f[4] = "id", "20250316001500", "1", "https://x.org/"
    for k, v in fields.items():
        f[int(k[1:])] = v
    return "\t".join(f)


def test_items_of_arrays_resolve_all_entities(spark):
    ship(spark)
    text = "caf&eacute; &nbsp;x &amp;amp; &#x41;&#39; &unknown; &lt"
    said = text.replace("&#x41;&#39;", "")  # a number sign parts quotations
    clean = lambda x: re.sub(r"\s+", " ", html.unescape(x)).strip()
    lines = [_record(f6="plain", f23="Plain Name,1;Other,2;Plain  Name,3"), _record(f6=f"x {text}", f16=text.replace(";", ""), f22=f"1|2|said {said}|quoted {said}#1|2|v| #1|2|v", f23="A &amp B,5;A & B,7;C,1", f24="3,big &amp dogs,12;x,bad,1;4,plain,2")]
    rows = spark.createDataFrame([("s", x, False) for x in lines], "source string, value string, replaced boolean")
    one, two = sorted(sources.graph_records(rows, F.create_map(F.lit("FR"), F.lit("FR"))).collect(), key=lambda r: r["counts"] != ["plain"])
    assert (one["counts"], one["all_names"], one["quotations"], one["amounts"]) == (["plain"], ["Plain Name", "Other"], [], [])
    assert two["counts"] == [clean(x)[:400] for x in f"x {text}".split(";") if x]
    assert two["date_mentions"] == [clean(text.replace(";", ""))] and two["all_names"] == ["A & B", "C"]
    assert [(q["verb"], q["text"]) for q in two["quotations"]] == [(clean(f"said {said}")[:40], clean(f"quoted {said}")[:400])]
    assert [(a["value"], a["object"]) for a in two["amounts"]] == [(3.0, "big & dogs"), (4.0, "plain")]


def test_rows_without_a_time_are_malformed(spark):
    ship(spark)
    rows = spark.createDataFrame([("s", x, False) for x in [_record(), _record(f1="soon"), _record(f1="soon", f2="2"), "a\tb"]], "source string, value string, replaced boolean")
    found = sources.graph_records(rows, F.create_map(F.lit("FR"), F.lit("FR")))
    (stats,) = sources.dataset_stats(rows, found).collect()
    assert (stats["rows"], stats["malformed_rows"], stats["matched_rows"]) == (4, 2, 1)


def test_unescaping_keeps_null_and_empty_arrays(spark):
    ship(spark)
    rows = spark.createDataFrame([(0, None), (1, []), (2, ["&amp;", None]), (3, ["x"]), (4, ["&eacute;", "&lt;b", ""])], "i int, a array<string>")
    got = {r["i"]: r["u"] for r in rows.select("i", metadata.unescaped(F.col("a")).alias("u")).collect()}
    assert got == {0: None, 1: [], 2: ["&", None], 3: ["x"], 4: ["é", "<b", ""]}
