"""Prefix trie of conversations, its subtree totals found by leaf peeling.

A node is a distinct sequence of first turns. Nodes hold counters of the
children that have not reported yet; a node whose counter is 0 is finished and
sends its subtree's totals to its parent, round after round, until only the
root is left to finish. Where most open nodes wait for one child only, a round
contracts these chains by pointer doubling instead, so a conversation of many
turns takes a logarithm of them in rounds.

Sequences are told apart by the sums, over their turns, of the eight 32-bit
words of the SHA-256 of position, role and text: sums run in ranges, so even
one conversation with a third of all turns is dealt to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fragloom.llm.common import heavy_keys, join_spread, materialize, read, ready_for_python

ROOT = "root"
_LANES = [f"_w{k}" for k in range(8)]
#: Conversation ids whose quotient by this number is equal are put into one string before ids are hashed.
ID_CHUNK = 4096


def running(rows: DataFrame, key: str, part: str, order: str, values: list[str]) -> DataFrame:
    """rows with inclusive running sums `value_sum` by key, in the order of (part, order).

    Each part of a key is summed apart; what comes before it is added up from
    one row a key and part. Parts must follow each other in the order.
    """
    inner = Window.partitionBy(key, part).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outer = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(key, part).agg(*[F.sum(v).alias(v) for v in values])
    before = totals.select(key, part, *[F.coalesce(F.sum(v).over(outer), F.lit(0)).alias(f"_b_{v}") for v in values])
    within = rows.withColumns({f"_i_{v}": F.sum(v).over(inner) for v in values})
    return within.join(before, [key, part]).withColumns({f"{v}_sum": F.col(f"_i_{v}") + F.col(f"_b_{v}") for v in values}).drop(*[f"_{x}_{v}" for x in "ib" for v in values])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, part, pos (1 and on), turn_hash, chars: turns in order of turn (null first), role, text.

    Turns are dealt to ranges of conversation and order, which are written and
    then numbered, so a long conversation is no task of its own. Null role and
    text count as empty; rows without conv_id belong to no conversation.
    """
    rows = conversations.where("conv_id is not null").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("_row")]
    said = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    ranged = rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*order)
    # monotonic ids follow the order within a task, as it is sorted
    ranged = materialize(ranged.select("conv_id", "part", F.monotonically_increasing_id().alias("at"), said.alias("turn_hash"), F.char_length("text").cast("long").alias("chars"), F.lit(1).cast("long").alias("pos")), "trie-turns")
    return running(ranged, "conv_id", "part", "at", ["pos"]).select("conv_id", "part", F.col("pos_sum").alias("pos"), "turn_hash", "chars")


def shared_heads(turns: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: turns (conv_id, part, d, turn_hash, chars, ends) and one row each (conv_id, length).

    Conversation c becomes the first h turns of c - c % block, then its own
    turns after its first h; h is the unsigned crc32 of its decimal id % most.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    own = own.select("conv_id", "n", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    lent = own.select(F.col("conv_id").alias("base"), F.col("n").alias("_n"))
    lent = F.least(F.col("h"), F.coalesce("_n", F.lit(0))), own.join(lent, "base", "left")
    convs = materialize(lent[1].withColumn("lent", lent[0]).select("conv_id", "h", "base", "lent", (F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-convs")
    heads = turns.where(F.col("pos") < most).select(F.col("conv_id").alias("base"), F.col("pos").alias("d"), "turn_hash", "chars")
    heads = heads.join(convs, "base").where("d <= h").select("conv_id", F.lit(-1).alias("part"), "d", "turn_hash", "chars", "length")
    rest = join_spread(turns, convs, "conv_id", heavy_keys(turns, "conv_id"), ["pos"]).where("pos > h")
    rest = rest.select("conv_id", "part", (F.col("pos") - F.col("h") + F.col("lent")).alias("d"), "turn_hash", "chars", "length")
    return heads.unionByName(rest).withColumn("ends", F.col("d") == F.col("length")).drop("length"), convs.select("conv_id", "length")


def _ids_hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's id strings joined by commas; rows come sorted by node and chunk, and no more than a batch is held."""
    import hashlib

    node = digest = None
    for batch in batches:
        out: tuple[list, list] = ([], [])
        for n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if n == node:
                digest.update(b"," + ids.encode())
                continue
            if digest:
                out[0].append(node), out[1].append(digest.hexdigest())
            node, digest = n, hashlib.sha256(ids.encode())
        yield pa.record_batch([pa.array(out[0], pa.string()), pa.array(out[1], pa.string())], ["node", "ends_sha256"])
    if digest:
        yield pa.record_batch([[node], [digest.hexdigest()]], ["node", "ends_sha256"])


def ends_hashed(ended: DataFrame) -> DataFrame:
    """node, ends_sha256 of ended (node, conv_id): the hash of the node's ids, ascending and joined by commas.

    Ids come as strings of neighbouring ones, at most ID_CHUNK of them, and the
    strings of a node stream through one hash, as SHA-256 must take them in order.
    """
    ready_for_python(ended.sparkSession)
    chunks = ended.groupBy("node", F.floor(F.col("conv_id") / ID_CHUNK).alias("chunk")).agg(F.array_sort(F.collect_set("conv_id")).alias("ids"))
    chunks = chunks.select("node", "chunk", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    return chunks.repartition("node").sortWithinPartitions("node", "chunk").select("node", "ids").mapInArrow(_ids_hashed, "node string, ends_sha256 string")


def build(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, parent, depth, conv_id, n_convs, chars), chars being those of the last turn, and ended (node, conv_id).

    turns: conv_id, part, d (1 and on), turn_hash, chars, ends. convs: conv_id, length; those without turns end at the root.
    """
    lane = lambda k: F.conv(F.substring("_sha", 8 * k + 1, 8), 16, 10).cast("long")
    hashed = turns.withColumn("_sha", F.sha2(F.concat_ws(":", "d", "turn_hash"), 256)).select("conv_id", "part", "d", "chars", "ends", *[lane(k).alias(w) for k, w in enumerate(_LANES)])
    sums = running(materialize(hashed, "trie-lanes"), "conv_id", "part", "d", _LANES)
    node = lambda d, words: F.sha2(F.concat_ws(",", d, *words), 256)
    above = [F.col(f"{w}_sum") - F.col(w) for w in _LANES]
    at = materialize(sums.select(
        "conv_id", "d", "chars", "ends", node(F.col("d"), [f"{w}_sum" for w in _LANES]).alias("node"),
        F.when(F.col("d") > 1, node(F.col("d") - 1, above)).otherwise(ROOT).alias("parent"),
    ), "trie-paths")
    nodes = at.groupBy("node").agg(F.first("parent").alias("parent"), F.first("d").alias("depth"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"))
    ended = at.where("ends").select("node", "conv_id").unionByName(convs.where("length = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    return materialize(nodes.unionByName(root), "trie-nodes"), ended


def _sum(value: str, more: str) -> Column:
    return F.col(value) + F.coalesce(more, F.lit(0))


def _contracted(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """live without the nodes that wait for one child only, and these: node, at (the node whose totals they need), and what is added to its totals."""
    child = F.struct(F.col("node").alias("at"), "up_leaves", "up_saved", (F.col("remaining") != 1).alias("done"))
    only = live.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("_n"), F.first(child).alias("_c")).where("_n = 1")
    chain = live.where("remaining = 1").join(only, "node")
    first = materialize(chain.select("node", F.col("_c.at").alias("at"), (F.col("leaves") + F.col("_c.up_leaves")).alias("leaves"), (F.col("saved") + F.col("_c.up_saved")).alias("saved"), F.col("_c.done").alias("done")), "trie-chains")
    current, open_ = first, first.where("not done").count()
    while open_:
        there = current.select(F.col("node").alias("at"), F.col("at").alias("_at"), F.col("leaves").alias("_leaves"), F.col("saved").alias("_saved"), F.col("done").alias("_done"))
        step = current.where("not done").join(there, "at").select("node", F.col("_at").alias("at"), _sum("leaves", "_leaves").alias("leaves"), _sum("saved", "_saved").alias("saved"), F.col("_done").alias("done"))
        current = materialize(current.where("done").unionByName(step), "trie-chains")
        open_ = current.where("not done").count()
    tops = live.select("node", "parent", "up_leaves", "up_saved").join(first.where("not done").select(F.col("at").alias("node")), "node", "left_anti").join(current, "node")
    links = tops.select(F.col("at").alias("node"), F.col("parent").alias("_p"), _sum("up_leaves", "leaves").alias("_l"), _sum("up_saved", "saved").alias("_s"), F.lit(True).alias("_linked"))
    kept = live.where("remaining != 1").join(links, "node", "left").select("node", F.when(F.col("_linked"), F.col("_p")).otherwise(F.col("parent")).alias("parent"), "remaining", "leaves", "saved", F.coalesce("_l", "up_leaves").alias("up_leaves"), F.coalesce("_s", "up_saved").alias("up_saved"))
    return materialize(kept, "trie-live"), current.drop("done")


def _peeled(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """live after its finished nodes have reported to their parents, and the finished ones' totals."""
    finished = live.where("remaining = 0")
    told = finished.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("_n"), F.sum(F.col("leaves") + F.col("up_leaves")).alias("_l"), F.sum(F.col("saved") + F.col("up_saved")).alias("_s"))
    kept = live.where("remaining > 0").join(told, "node", "left").select("node", "parent", (F.col("remaining") - F.coalesce("_n", F.lit(0))).alias("remaining"), _sum("leaves", "_l").alias("leaves"), _sum("saved", "_s").alias("saved"), "up_leaves", "up_saved")
    return materialize(kept, "trie-live"), finished.select("node", "leaves", "saved")


def subtree_totals(nodes: DataFrame) -> DataFrame:
    """node, leaves, saved: childless nodes and the sum of `saved` in each node's subtree, itself included.

    nodes: node, parent (null: the root), remaining (its number of children),
    saved (its own). A round peels the finished nodes or, if more nodes wait for
    just one child, contracts these, so at least a third of the open nodes goes
    in each round, whatever the shape.
    """
    live = materialize(nodes.select("node", "parent", "remaining", (F.col("remaining") == 0).cast("long").alias("leaves"), "saved", F.lit(0).cast("long").alias("up_leaves"), F.lit(0).cast("long").alias("up_saved")), "trie-live")
    found, waiting = [], []
    while True:
        ready, single, left = live.agg(F.count_if(F.col("remaining") == 0), F.count_if(F.col("remaining") == 1), F.count("*")).first()
        if not left:
            break
        if not ready:
            raise ValueError("nodes form no tree: none is childless")
        if single > ready:
            live, chains = _contracted(live)
            waiting.append(chains)
        else:
            live, totals = _peeled(live)
            found.append(totals)
    if not found:
        return live.select("node", "leaves", "saved")
    totals = reduce(DataFrame.unionByName, found)
    for chains in reversed(waiting):  # the nodes they lean on were settled later
        settled = totals.select(F.col("node").alias("at"), F.col("leaves").alias("_leaves"), F.col("saved").alias("_saved"))
        joined = join_spread(chains, settled, "at", heavy_keys(chains, "at"), ["node"])
        totals = materialize(totals.unionByName(joined.select("node", _sum("leaves", "_leaves").alias("leaves"), _sum("saved", "_saved").alias("saved"))), "trie-totals")
    return totals


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns and convs as build takes them. saved_tokens sums (n_convs - 1) times
    the code points of the last text over a node's subtree. Without
    conversations there is no node, not even a root.
    """
    nodes, ended = build(turns, convs)
    children = materialize(nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children")), "trie-children")
    nodes = materialize(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-counted")
    totals = subtree_totals(nodes.select("node", "parent", F.col("n_children").alias("remaining"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")))
    below = nodes.where("parent is not null")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    named = join_spread(below, parents, "parent", heavy_keys(below, "parent"), ["node"]).unionByName(nodes.where("parent is null"), allowMissingColumns=True)
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return named.join(totals, "node").join(ends_hashed(ended), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )


def query(spark, sf_dir):
    """op11: all conversations, each rebuilt with the first turns of its hundred's first one."""
    turns = materialize(ordered_turns(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")), "trie-ordered")
    return prefix_trie(*shared_heads(turns))


_CRC = "xor(4294967295, list_reduce(flatten(list_prepend([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END))"
SQL = f"""WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, count(*) AS len, c - c % 100 AS base, {_CRC} % 6 AS h FROM t GROUP BY c),
b AS (SELECT k.c, k.base, k.h, coalesce(least(o.len, k.h), 0) AS lent, coalesce(least(o.len, k.h), 0) + greatest(k.len - k.h, 0) AS total FROM k LEFT JOIN k o ON o.c = k.base),
m AS (SELECT b.c, t.pos AS d, r, x, total FROM b JOIN t ON t.c = b.base AND t.pos <= b.h UNION ALL SELECT b.c, t.pos - h + lent, r, x, total FROM b JOIN t ON t.c = b.c AND t.pos > h),
q AS (SELECT c, d, x, total, list([r, x]) OVER (PARTITION BY c ORDER BY d) AS path FROM m UNION ALL SELECT c, 0, '', total, [] FROM b),
n AS (SELECT path, d, min(c) AS c, count(*) AS n_convs, any_value(length(x)) AS chars, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = total), '') AS ends FROM q GROUP BY path, d),
e AS (SELECT *, path[1:d - 1] AS up FROM n),
g AS (SELECT up, count(*) AS n_children FROM e WHERE d > 0 GROUP BY up),
w AS (SELECT e.*, coalesce(n_children, 0) AS n_children FROM e LEFT JOIN g ON g.up = e.path),
s AS (SELECT a.path, count_if(z.n_children = 0)::BIGINT AS n_leaves, sum((z.n_convs - 1) * z.chars)::BIGINT AS saved_tokens FROM w a JOIN w z ON z.d >= a.d AND z.path[1:a.d] = a.path GROUP BY a.path)
SELECT w.c AS conv_id, w.d AS depth, p.c AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, sha256(w.ends) AS ends_sha256
FROM w JOIN s ON s.path = w.path LEFT JOIN n p ON w.d > 0 AND p.path = w.up"""
