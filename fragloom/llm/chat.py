"""Chat formatting of reply trees, in DataFrame operations only.

Unary runs of a tree are compressed first (pointer doubling: self-joins, a
logarithm of the longest run in number), so the iterative self-join that walks
from leaves to roots takes as many rounds as a path has branchings, not
messages. Paths are ranked by mean message score, and each chosen path becomes
one conversation string with the spans of its loss mask.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fragloom.llm.common import discard, materialize

#: The template's marks, and further control strings that common chat templates use.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = [START, END, "<|endoftext|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

def _quoted(control: str) -> str:
    return rf"\Q{control[0]}\E(?=\Q{control[1:]}\E)"


#: The first character of a control string, where the rest follows.
_BREAK = "(" + "|".join(_quoted(c) for c in CONTROL) + ")"


def escape(text: Column) -> Column:
    """Backslashes doubled, then one put after the first character of each control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _BREAK, r"$1\\")


def unescape(text: Column) -> Column:
    """Drops the backslash before each escaped character: the exact inverse of escape and escape_role."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def _followed(pointers: DataFrame) -> DataFrame:
    """Pointers (tree, id, at, steps, done) followed to where they are done, by doubling. Those that run in circles never are."""
    current = materialize(pointers, "chat-pointers")
    before = current.where("not done").count()
    while before:
        there = current.select("tree", F.col("id").alias("at"), F.col("at").alias("_at"), F.col("steps").alias("_steps"), F.col("done").alias("_done"))
        stepped = current.where("not done").join(there, ["tree", "at"]).select("tree", "id", F.col("_at").alias("at"), (F.col("steps") + F.col("_steps")).alias("steps"), F.col("_done").alias("done"))
        after = materialize(current.where("done").unionByName(stepped), "chat-pointers")
        left = after.where("not done").count()
        discard(current)
        current = after
        if left == before:  # every round brings those nearest to an end there, so the rest runs in circles
            break
        before = left
    return current


def compressed(messages: DataFrame) -> DataFrame:
    """tree, id -> head (first message of its unary run), steps (messages from the head), top (head's parent or null).

    messages: tree, id, parent (null or absent in the tree: a root).
    """
    known = messages.select("tree", F.col("id").alias("parent"), F.lit(True).alias("_known"))
    linked = messages.join(known, ["tree", "parent"], "left").withColumn("parent", F.when(F.col("_known"), F.col("parent"))).drop("_known")
    fanout = linked.where("parent is not null").groupBy("tree", F.col("parent").alias("id")).agg(F.count("*").alias("_children"))
    only = fanout.where("_children = 1").select("tree", F.col("id").alias("parent"), F.lit(True).alias("_only"))
    state = linked.join(only, ["tree", "parent"], "left").select(
        "tree", "id", "parent", F.coalesce("_only", F.lit(False)).alias("_inner"),
        F.when(F.col("_only"), F.col("parent")).alias("jump"), F.when(F.col("_only"), 1).otherwise(0).cast("long").alias("steps"),
    )
    state = materialize(state, "chat-runs")
    heads = state.select("tree", "id", F.coalesce("jump", "id").alias("at"), "steps", F.col("jump").isNull().alias("done"))
    current = _followed(heads)
    tops = state.select("tree", F.col("id").alias("head"), F.col("parent").alias("top"))
    return current.where("done").select("tree", "id", F.col("at").alias("head"), "steps").join(tops, ["tree", "head"])


def paths(messages: DataFrame) -> DataFrame:
    """tree, leaf, id, back: every message of every root-to-leaf path; back counts from the leaf, 0.

    messages: tree, id (unique within the tree), parent. Messages on or below
    a circle of replies have no root and are on no path.
    """
    runs = materialize(compressed(messages), "chat-compressed")
    heads = materialize(runs.where("steps = 0").select("tree", "head", "top"), "chat-run-heads")
    above = runs.select("tree", F.col("id").alias("top"), F.col("head").alias("_above"))
    climbs = heads.join(above, ["tree", "top"], "left").select("tree", F.col("head").alias("id"), F.coalesce("_above", "head").alias("at"), F.lit(1).cast("long").alias("steps"), F.col("top").isNull().alias("done"))
    rooted = _followed(climbs).where("done").select("tree", F.col("id").alias("head"))
    parents = messages.select("tree", F.col("parent").alias("id")).where("id is not null").distinct()
    leaves = runs.join(parents, ["tree", "id"], "left_anti").join(rooted, ["tree", "head"], "left_semi")
    # frontier: the lowest message of each run on the way from the leaf to the root
    frontier = materialize(leaves.select("tree", F.col("id").alias("leaf"), F.col("id").alias("low"), "head", "steps", "top", F.lit(0).cast("long").alias("below")), "chat-frontier")
    found = []
    while frontier.take(1):
        found.append(frontier)
        above = runs.select("tree", F.col("id").alias("top"), F.col("head").alias("_head"), F.col("steps").alias("_steps"))
        tops = heads.select("tree", F.col("head").alias("_head"), F.col("top").alias("_top"))
        step = frontier.where("top is not null").join(above, ["tree", "top"]).join(tops, ["tree", "_head"])
        frontier = materialize(step.select("tree", "leaf", F.col("top").alias("low"), F.col("_head").alias("head"), F.col("_steps").alias("steps"), F.col("_top").alias("top"), (F.col("below") + F.col("steps") + 1).alias("below")), "chat-frontier")
    segments = found[0] if found else frontier
    for more in found[1:]:
        segments = segments.unionByName(more)
    members = runs.select("tree", "head", "id", F.col("steps").alias("_steps"))
    on = segments.join(members, ["tree", "head"]).where("_steps <= steps")
    return on.select("tree", "leaf", "id", (F.col("below") + F.col("steps") - F.col("_steps")).alias("back"))


def format_trees(messages: DataFrame, *, best: int | None = None, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row a chosen path: tree, leaf, rank, score, formatted, loss_spans, n_messages.

    messages: tree, id, parent, role, text, score. Null role and text count as
    empty, null score as 0. Paths of a tree rank by mean score, ties by leaf;
    best keeps so many a tree (None: all). loss_spans holds start and end, in
    code points of formatted, of the escaped texts of trained roles. Further
    columns of messages are dropped. Empty input gives an empty result.
    """
    base = messages.select("tree", "id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    walked = paths(messages.select("tree", "id", "parent")).join(base, ["tree", "id"])
    ranks = walked.groupBy("tree", "leaf").agg(F.avg("score").alias("score"))
    ranks = ranks.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))
    if best is not None:
        ranks = ranks.where(F.col("rank") <= best)
    chosen = walked.drop("score").join(ranks, ["tree", "leaf"])
    head, body, tail = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")), escape(F.col("text")), F.lit(END + "\n")
    turn = chosen.withColumns({"_head": head, "_body": body}).withColumn("_turn", F.concat("_head", "_body", tail))
    before = F.sum(F.char_length("_turn")).over(Window.partitionBy("tree", "leaf").orderBy(F.desc("back")).rowsBetween(Window.unboundedPreceding, -1))
    start = (F.coalesce(before, F.lit(0)) + F.char_length("_head")).cast("long")
    turn = turn.withColumn("_start", start).withColumn("_end", F.col("_start") + F.char_length("_body"))
    item = F.struct((-F.col("back")).alias("at"), F.col("_turn").alias("turn"), F.col("role").isin(*trained).alias("trained"), F.col("_start").alias("start"), F.col("_end").alias("end"))
    grouped = turn.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(item)).alias("_items"), F.first("rank").alias("rank"), F.first("score").alias("score"))
    return grouped.select(
        "tree", "leaf", "rank", "score",
        F.array_join(F.transform("_items", lambda x: x["turn"]), "").alias("formatted"),
        F.transform(F.filter("_items", lambda x: x["trained"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("loss_spans"),
        F.size("_items").cast("long").alias("n_messages"),
    )


def turns(formatted: Column) -> Column:
    """Read a formatted conversation back: array of role and text."""
    pieces = F.filter(F.split(formatted, r"\Q" + END + "\n" + r"\E"), lambda x: x != "")
    role = lambda x: F.regexp_extract(x, r"(?s)^\Q" + START + r"\E([^\\\n]*+(?:\\.[^\\\n]*+)*+)" + "\n", 1)
    return F.transform(pieces, lambda x: F.struct(unescape(role(x)).alias("role"), unescape(F.substring(x, F.char_length(role(x)) + len(START) + 2, F.char_length(x))).alias("text")))


def conversation_trees(conversations: DataFrame) -> DataFrame:
    """Conversations of numbered turns as trees of one path: each turn replies to the one before.

    Rows with equal conv_id and turn follow each other by role, then text. Rows
    with null conv_id form one conversation, and null turns come first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    at = conversations.withColumn("id", F.row_number().over(order).cast("long"))
    return at.select(F.struct("conv_id").alias("tree"), "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def query(spark, sf_dir):
    """op2: digests of all conversations, read back from the formatted strings."""
    from fragloom.llm.common import read

    own = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    table = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    out = format_trees(materialize(conversation_trees(table), "chat-turns"))
    back = out.select("*", turns(F.col("formatted")).alias("_turns"), F.array_join(F.transform("loss_spans", lambda x: unescape(F.substring(F.col("formatted"), (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int")))), "").alias("_loss"))
    said = F.array_join(F.transform("_turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree.conv_id").alias("conv_id"), F.size("_turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"), F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
