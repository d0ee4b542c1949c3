"""What keeps queries within memory, disk and time as tables grow."""

from pyspark.sql import functions as F

from fragloom.operators import assemble
from fragloom.settings import Settings

ROWS = "url string, date string, lang string, type int, pos int, line_no int, text string"


def _windows(url, words, kind=1, n=7):
    return [(url, "d", "en", kind, i * 10 // len(words) * 10, i, " ".join(words[max(0, i - n) : i + n + 1])) for i in range(len(words))]


def test_packed_runs_hold_all_fragments_in_little_room(spark):
    """Rows of groups that take turns, a key without a value, and texts that repeat each other."""
    rows = [r for pair in zip(_windows("a", [f"w{i}" for i in range(400)]), _windows(None, [f"v{i}" for i in range(400)]), strict=True) for r in pair]
    groups = assemble.packed_groups(spark.createDataFrame(rows, ROWS).coalesce(1), assemble.KEY, 400).collect()
    assert {g["url"]: g["inputs"] for g in groups} == {"a": 400, None: 400}
    for g in groups:
        assert sorted(f[1:] for f in assemble.unpacked(g["runs"])) == sorted(r[5:] for r in rows if r[0] == g["url"])
        assert sum(map(len, g["runs"])) * 4 < sum(len(r[6]) for r in rows if r[0] == g["url"])


def test_kernels_take_one_group_at_a_time(spark):
    """Rows are handed on by few, whatever Arrow's batches hold."""
    seen = spark.createDataFrame([r for k in range(200) for r in _windows(f"u{k}", ["x", "y", str(k)])], ROWS).coalesce(1)
    sizes = assemble.articles(seen, Settings(types=(1,))).mapInArrow(lambda bs: (b.select(["merged"]) for b in bs), "merged long")
    assert sizes.agg(F.sum("merged")).first()[0] == 600
    assert assemble.grouped(seen, assemble.KEY).where("size(fragments) = 3 AND fragments[0].line_no = 0").count() == 200


def test_words_are_split_at_white_space_of_unicode_only():
    from fragloom.kernels import graphs

    for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000)]):
        assert graphs.words(f"a{c}b") == [w for w in graphs._SPACE.split(f"a{c}b") if w]


def test_word_assembly_builds_few_runs(monkeypatch):
    """Runs are indexed when they are asked for: a few for each fragment, not one for each of its lengths at either end."""
    from fragloom.kernels import wordwise

    made, add = [], wordwise.RunIndex._add
    monkeypatch.setattr(wordwise.RunIndex, "_add", lambda self, out, side, k, of: (made.append(len(of or ())), add(self, out, side, k, of))[1])
    rows = [(r[4], r[6]) for r in _windows("u", [f"w{i}" for i in range(3000)])]
    found = wordwise.assemble_words(rows)
    assert found.merged == 3000 and sum(made) < 8 * 3000


def test_an_anchor_is_told_apart_once(monkeypatch):
    """Many runs that share their first words ask for their chain once, not each."""
    from fragloom.kernels import wordwise

    made, add = [], wordwise.RunIndex._add
    monkeypatch.setattr(wordwise.RunIndex, "_add", lambda self, out, side, k, of: (made.append(len(of or ())), add(self, out, side, k, of))[1])
    words = [w for k in range(300) for w in ["a", "b", "c", "d", "e", "f", "g", "h", f"x{k}", f"y{k}", f"z{k}"]]
    assert wordwise.assemble_words([(r[4], r[6]) for r in _windows("u", words)]).merged == len(words)
    assert sum(made) < 30 * len(words)


def test_overlaps_in_tasks_are_those_of_joins(spark):
    """Both ways on the same groups, of which one is larger than a task; groups in tasks make no rows for their runs of words."""
    import random

    from fragloom.operators import overlap

    rnd, rows = random.Random(4), []
    for g in range(5):
        rows += _windows(f"u{g}", [rnd.choice(["a", "b", "c", "", f"w{rnd.randrange(40)}"]) for _ in range(30 * g + 1)], n=rnd.choice([1, 3, 7]))
    frame = spark.createDataFrame(rows + rows[::3] + [("u1", "d", "en", 1, 90, 999, None), (None, "d", "en", 1, 0, 0, "x y"), (None, "d", "en", 1, 0, 1, "y")], ROWS)
    for find in (overlap.overlap_pairs, overlap.overlap_chains):
        for least in (1, 3):
            told = [sorted(map(repr, map(tuple, find(frame, least=least, in_task=n).collect()))) for n in (10**6, 80)]
            assert told[0] == told[1]
            if least == 1:
                assert len(told[0]) > 250
    plan = overlap.overlap_pairs(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan


def test_a_minute_is_written_by_many_tasks(spark, tmp_path):
    """Rows of one source minute, which one task wrote before."""
    from fragloom.operators import publish

    rows = spark.range(4000).select(F.lit("d").alias("date"), F.sha2(F.col("id").cast("string"), 256).alias("observation_id"), F.struct(F.lit("20250316000100").alias("source_minute")).alias("metadata"))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        publish.write_compact(rows, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    files = spark.read.parquet(str(tmp_path / "out")).groupBy(F.input_file_name()).count().collect()
    assert len(files) > 4 and max(r["count"] for r in files) < 2000 and sum(r["count"] for r in files) == 4000


def test_rows_of_windows_carry_few_words(spark, tmp_path):
    """Windows at and around the cuts are those of the whole document, and no row carries more of it than its part."""
    from fragloom.plans import fixtures

    words = [f"w{i}" for i in range(3 * fixtures.CHUNK + 1)]
    docs = spark.createDataFrame([(1, " ".join(words), "en", "s"), (2, "", "en", "s"), (3, "one", "en", "s")], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["url"][-1], r["line_no"]): (r["pre"], r["ngram"], r["post"]) for r in fixtures.records(spark, str(tmp_path)).collect()}
    assert got == {("1", i): (" ".join(words[max(0, i - 7) : i]), w, " ".join(words[i + 1 : i + 8])) for i, w in enumerate(words)} | {("3", 0): ("", "one", "")}
    wide = fixtures._windows(docs.select(F.lit("u").alias("url"), "lang", F.split("text", " ").alias("w")), "w", 7, 1)
    assert wide.agg(F.max(F.size("w"))).first()[0] <= fixtures.CHUNK + 14


def test_cluster_steps_that_are_plain_need_no_search(monkeypatch):
    """Windows of a text, in which one fragment follows another, are not looked up one by one."""
    from fragloom.kernels import clusterwise

    looked, found = [], clusterwise._Assembler._found
    monkeypatch.setattr(clusterwise._Assembler, "_found", lambda self, s, side: (looked.append(side), found(self, s, side))[1])
    text = "".join(chr(0x4E00 + k) if k % 3 else f"{k}" for k in range(3000))
    r = clusterwise.assemble_clusters([(i * 10 // len(text) * 10, text[max(0, i - 6) : i + 7]) for i in range(len(text))])
    assert r.text == text and r.merged == len(text) and len(looked) < 100


def test_plain_steps_are_those_of_the_search(monkeypatch):
    import random

    from fragloom.kernels import clusterwise

    rnd, cases = random.Random(7), []
    for _ in range(300):
        text = "".join(rnd.choice(rnd.choice(["ab", "abc ", "abcdefgh "])) for _ in range(rnd.randrange(1, 60))) * rnd.choice([1, 1, 3])
        rows = [(i * 10 // len(text) * 10, text[max(0, i - 3) : i + 4]) for i in range(len(text)) if rnd.random() > 0.1]
        options = clusterwise.Options(rnd.choice([1, 2, 4, 6]), rnd.choice([0, 10, 20]), rnd.choice([0, 20, 500]), True)
        cases.append((rows + rows[: rnd.choice([0, len(rows) // 2])], options))
    plain = [clusterwise.assemble_clusters(*c) for c in cases]
    monkeypatch.setattr(clusterwise._Assembler, "glide", lambda self, s, most=None: 0)
    assert plain == [clusterwise.assemble_clusters(*c) for c in cases]


def test_grapheme_windows(spark, tmp_path):
    """Cut at and around parts, with clusters of more than one character, and from no text."""
    from fragloom.kernels.graphs import graphemes
    from fragloom.plans import fixtures

    texts = ["", None, "x", "e\u0301a\r\nb" * 5, "abcdefghij" * (fixtures.PART // 10) + "end"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")}).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(int(r["url"].rsplit("/", 1)[1]), r["line_no"]): (r["pos"], r["text"]) for r in fixtures.cluster_fragments(spark, str(tmp_path)).collect()}
    units = {k: graphemes(t or "") for k, t in enumerate(texts)}
    assert got == {(k, i): (i * 10 // len(g) * 10, "".join(g[max(0, i - 6) : i + 7])) for k, g in units.items() for i in range(len(g))}


def test_evidence_that_is_out_of_order_is_found():
    from fragloom.kernels.evidence import held

    assert held(["bc", "yz", "ab", "", "z"], "abc" + "-" * 500 + "yz") and not held(["bc", "cb"], "abc")


def test_beginning_is_looked_at_once(monkeypatch):
    """While a text grows at its end, what stands before its beginning is not looked for again."""
    from fragloom.kernels import wordwise

    asked, chains = [0, 0], wordwise.RunIndex.chains

    def counted(self, side, k, run):
        asked[side] += 1
        return chains(self, side, k, run)

    monkeypatch.setattr(wordwise.RunIndex, "chains", counted)
    assert wordwise.assemble_words([(r[4], r[6]) for r in _windows("u", [f"w{i}" for i in range(3000)])]).merged == 3000
    assert asked[1] < 200 < asked[0]


def test_bodies_are_made_where_the_kernel_runs(spark):
    """The same bodies as from articles that carry what did not join, which stays in its task."""
    from fragloom.operators import export

    words = [f"w{i}" for i in range(200)]
    rows = [r for k in range(20) for r in _windows(f"u{k}", words) if k % 2 == 0 or r[5] % 40 > 25]
    frame = spark.createDataFrame(rows + [("t", "d", "en", 2, 0, 0, "abcdef")], ROWS)
    both = Settings(type2_best_effort=True)
    carried, own = assemble.articles(frame, both), assemble.articles(frame, both, bodies=True)
    assert own.where("type = 1 AND (unmerged IS NOT NULL OR body IS NULL)").count() == 0
    told = [sorted(map(repr, export.bodies(a).drop("_row").collect())) for a in (carried, own)]
    assert told[0] == told[1] and len(told[0]) == 21 and export.bodies(own).where("left_over > 0").count() == 10


def test_objects_are_walked_once(spark):
    """Of a line, one lookup that names a path, whatever its fields; odd lines are refused as before."""
    import json

    from fragloom.sources import minutes

    good = {"date": "d", "url": "u", "lang": "en", "type": 1, "pos": 0, "pre": "", "ngram": "b", "post": "c"}
    odd = [{**good, "lang": None}, {**good, "type": 1.5}, {**good, "pos": 2**70}, {**good, "pre": ["a"]}, {**good, "ngram": {"x": 1}}, {k: v for k, v in good.items() if k != "post"}, {**good, "pos": True}]
    lines = [json.dumps(x) for x in ([good], 7, None, *odd)] + ["", "[", "{}", f"{json.dumps(good)},", f"{json.dumps(good)},7", f"{json.dumps(good)}]", f"{json.dumps(good)}] {{}}", f'{json.dumps(good)},{{"pos":1}}] x', f"{json.dumps(good)},{json.dumps(good)}"]
    frame = spark.createDataFrame([(x,) for x in [json.dumps({**good, "more": [1, {"date": 2}]}), *lines, None]], "value string")
    parsed = minutes.parse_records(frame)
    assert [r["record"] is not None for r in parsed.collect()] == [True] + [False] * (len(lines) + 1)
    assert parsed.where("record IS NOT NULL").select("record.*").first().asDict() == good
    assert "$[0]" not in parsed._jdf.queryExecution().executedPlan().toString()


def test_a_line_is_parsed_once(spark):
    """Filters on what was parsed repeat neither the parser nor the cutting of a fragment's words."""
    from fragloom.operators import classify
    from fragloom.streaming import batch

    kept = Settings(types=(1,), quarantine_invalid_metadata=True)
    lines = spark.createDataFrame([("f", 1, '{"date":"d","url":"u","lang":"en","type":1,"pos":0,"pre":"menu / a","ngram":"b","post":"c"}'), ("f", 2, " ")], "file string, line_no long, value string").repartition(2)
    rows = batch.classified(lines, kept)
    fragments = classify.fragments(rows.where("status = 'selected'"), kept)
    plan = fragments._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1 and plan.count("split(") == 2
    assert [r["text"] for r in fragments.collect()] == ["a b c"] and sorted(r["status"] for r in rows.collect()) == ["blank", "selected"]
