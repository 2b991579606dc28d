"""Chat formatting of reply trees, in DataFrame functions only.

Messages point to a parent message.  Ancestors at distances 1, 2, 4, ... come
from joining the ancestor table with itself until none is left, so a chain of n
replies takes about log2(n) joins.  The same tables, from the farthest jump to
the nearest, list every ancestor of every leaf once: the root-to-leaf paths.
Paths are ranked by the sum of their messages' scores (ties: the smaller leaf)
and each chosen path becomes one conversation.

Template: ``<s>role[/INST]text</s>`` per turn.  Inside roles and texts a
backslash, ``<`` and ``[`` are written ``\\0``, ``\\1`` and ``\\2``, so no control string
can appear in them and reading back restores every character.

A null text or role is empty.  A parent that is not there makes a root; messages
that lead into a cycle are left out.  Messages that repeat a tree and node count
once (the least parent, role and text).  Extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cdcflow.llm.store import stage

# The template's fixed strings.
OPEN, SPLIT, CLOSE = "<s>", "[/INST]", "</s>"
LEARNT = "assistant"     # the role whose texts the loss covers


def escape(c: Column) -> Column:
    for plain, code in (("\\", "\\0"), ("<", "\\1"), ("[", "\\2")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in (("[", "\\2"), ("<", "\\1"), ("\\", "\\0")):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """``tree, leaf, score, rank, node, depth`` of the ``best`` (all, if ``None``) root-to-leaf paths of
    every tree.  ``messages`` has ``tree, node, parent, score``, one row per ``(tree, node)``."""
    nodes = messages.select("tree", "node")
    here = nodes.withColumnRenamed("node", "parent")
    link = stage(messages.where("parent IS NOT NULL").select("tree", "node", "parent").join(here, ["tree", "parent"], "left_semi"), "links")
    jumps = [link.select("tree", "node", F.col("parent").alias("up"))]
    limit = max(1, messages.count()).bit_length() + 1
    while len(jumps) <= limit:
        far = jumps[-1].select("tree", F.col("node").alias("up"), F.col("up").alias("above"))
        more = stage(jumps[-1].join(far, ["tree", "up"]).select("tree", "node", F.col("above").alias("up")), "jumps")
        if more.isEmpty():
            break
        jumps.append(more)
    leaves = nodes.join(link.select("tree", F.col("parent").alias("node")).distinct(), ["tree", "node"], "left_anti")
    if len(jumps) > limit:  # a path longer than there are messages runs in a circle
        leaves = leaves.join(jumps.pop().select("tree", "node"), ["tree", "node"], "left_anti")
    steps = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"))
    for k in range(len(jumps) - 1, -1, -1):
        up = steps.join(jumps[k], ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above"))
        steps = stage(steps.union(up), "steps") if k % 4 == 3 else steps.union(up)
    steps = stage(steps, "steps")
    scored = steps.join(messages.select("tree", "node", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")), ["tree", "node"])
    ends = scored.groupBy("tree", "leaf").agg(F.sum("score").alias("score"), F.max("above").alias("top"))
    rank = F.row_number().over(W.partitionBy("tree").orderBy(F.desc("score"), "leaf")).alias("rank")
    chosen = ends.select("tree", "leaf", "score", "top", rank)
    chosen = chosen if best is None else chosen.where(F.col("rank") <= best)
    return steps.join(chosen, ["tree", "leaf"]).select("tree", "leaf", "score", "rank", "node", (F.col("top") - F.col("above")).alias("depth"))


def conversations(messages: DataFrame, best: int | None = 1) -> DataFrame:
    """``tree, leaf, rank, score, n_turns, formatted, loss`` per chosen path; ``loss`` lists the
    start (from 0) and length, in code points of ``formatted``, of every assistant text.

    ``messages`` has ``tree, node, parent, role, text, score``.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    one = messages.where("tree IS NOT NULL AND node IS NOT NULL").groupBy("tree", "node").agg(
        F.min(F.struct("parent", role.alias("role"), text.alias("text"), F.col("score").cast("double").alias("score"))).alias("m"))
    one = stage(one.select("tree", "node", "m.*"), "messages")
    turn = paths(one, best).join(one.select("tree", "node", "role", "text"), ["tree", "node"])
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SPLIT))
    turn = turn.withColumn("head", F.length(head)).withColumn("body", escape(F.col("text"))).withColumn("piece", F.concat(head, "body", F.lit(CLOSE)))
    before = W.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    turn = turn.withColumn("start", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.col("head"))
    span = F.when(F.col("role") == LEARNT, F.struct("start", F.length("body").alias("length")))
    joined = turn.groupBy("tree", "leaf", "rank", "score").agg(F.array_sort(F.collect_list(F.struct("depth", "piece"))).alias("p"), F.array_sort(F.collect_list(span)).alias("loss"))
    return joined.select("tree", "leaf", "rank", "score", F.size("p").cast("long").alias("n_turns"), F.array_join(F.col("p").getField("piece"), "").alias("formatted"), "loss")


def turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` read back from a formatted conversation."""
    parts = F.split(formatted, CLOSE)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(p: Column) -> Column:
        at = F.instr(p, SPLIT)
        return F.struct(unescape(F.substring(p, F.lit(len(OPEN) + 1), at - (len(OPEN) + 1))).alias("role"),
                        unescape(F.substring(p, at + len(SPLIT), F.length(p))).alias("text"))

    return F.transform(parts, turn)


def learnt(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def chain(rows: DataFrame, tree: Column, order: list[Column]) -> DataFrame:
    """Messages of plain conversations: every row replies to the one before it."""
    w = W.partitionBy("tree").orderBy(*order)
    at = rows.withColumn("tree", tree).withColumn("node", F.row_number().over(w).cast("long"))
    return at.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))
