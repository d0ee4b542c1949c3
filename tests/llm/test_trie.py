"""The prefix trie against plain code."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from fragloom.llm import trie
from fragloom.llm.common import materialize

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """All nodes by building every prefix."""
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    built = {c: own.get(c - c % 100, [])[: (h := zlib.crc32(str(c).encode()) % 6)] + t[h:] for c, t in own.items()}
    members = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(tuple(t[:d]), []).append(c)
    out = {}
    for path, who in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in who if len(built[c]) == len(path))
        out[(min(who), len(path))] = (
            min(members[path[:-1]]) if path else None, len(who), sum(len(p) == len(path) + 1 for p in below), sum(not any(q[:-1] == p for q in members if q) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return out


def run(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    turns = materialize(trie.ordered_turns(df.repartition(3)), "test-turns")
    found = trie.prefix_trie(*trie.shared_heads(turns)).collect()
    out = {(r["conv_id"], r["depth"]): tuple(r)[2:] for r in found}
    assert len(out) == len(found)
    return out


def test_nodes_like_plain_code(spark):
    """Shared beginnings, equal conversations, null roles, texts and turns, ties, repeated rows, rows without conversation, a long one, blocks without their first one."""
    rnd = random.Random(3)
    rows = [(None, 0, "user", "no conversation"), (7, None, "user", None), (7, None, None, "b"), (7, 1, "user", "a"), (7, 1, "user", "a"), (7, 1, "assistant", "é\U0001f600")]
    for c in [*range(100, 130), *range(305, 312), 1000]:
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"{'s' * (t + 1)}{rnd.randrange(2)}") for t in range(rnd.randrange(1, 8))]
    rows += [(400 + k, t, "user", f"same{t}") for k in range(9) for t in range(7)]
    rows += [(512, t, "user", "long" + "x" * (t % 5)) for t in range(60)]
    rnd.shuffle(rows)
    assert run(spark, rows) == plain(rows)


def test_empty_and_clashing(spark):
    """No conversation: no node. Columns named like the trie's own are dropped."""
    assert run(spark, []) == {}
    assert run(spark, [(None, 1, "user", "x")]) == {}
    rows = [(5, 0, "user", "a", "x", "y", 1), (6, 0, "user", "a", "x", "y", 2)]
    assert run(spark, rows, SCHEMA + ", part string, node string, depth long") == plain([r[:4] for r in rows])


def test_subtree_totals_of_any_shape(spark):
    """A chain, a caterpillar, a star and a random tree at once; a few rounds do for the chain."""
    rnd, parents = random.Random(1), {}
    for k in range(70):
        parents[f"chain{k}"] = f"chain{k - 1}" if k else None
        parents[f"spine{k}"] = f"spine{k - 1}" if k else None
        parents[f"leg{k}"] = f"spine{k}"
        parents[f"star{k}"] = "star0" if k else None
        parents[f"tree{k}"] = f"tree{rnd.randrange(k)}" if k else None
    own = {n: rnd.randrange(9) for n in parents}
    want = {n: [0, 0] for n in parents}
    inner = set(parents.values())
    for n in parents:
        at = n
        while at:
            want[at][0] += n not in inner
            want[at][1] += own[n]
            at = parents[at]
    count = {n: 0 for n in parents}
    for p in parents.values():
        if p:
            count[p] += 1
    nodes = spark.createDataFrame([(n, p, count[n], own[n]) for n, p in parents.items()], "node string, parent string, remaining long, saved long")
    got = {r["node"]: [r["leaves"], r["saved"]] for r in trie.subtree_totals(nodes).collect()}
    assert got == want


def test_running_sums_over_parts(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.floor(F.col("id") / 90).alias("p"), F.col("id").alias("o"), F.lit(1).cast("long").alias("v"))
    got = trie.running(rows, "k", "p", "o", ["v"])
    assert got.where(F.col("v_sum") != F.floor(F.col("o") / 3) + 1).count() == 0 and got.count() == 1000


def test_ids_are_hashed_in_order(spark):
    ids = [*range(-5000, 9000, 3), 10**15, -(10**15)]
    ended = spark.createDataFrame([("a", i) for i in ids] + [("b", 4)], "node string, conv_id long").repartition(7)
    got = {r["node"]: r["ends_sha256"] for r in trie.ends_hashed(ended).collect()}
    assert got == {"a": hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), "b": hashlib.sha256(b"4").hexdigest()}
