"""Chat formatting of reply trees.

Messages point to the message they reply to. Self-joins enumerate paths by pointer
doubling: after round k every message knows its 2^k-th ancestor and the score of the
way there, so a tree of depth d takes log2(d) joins. Leaves are ranked per tree by the
score of their whole path; the chosen ones walk up again through the same tables, and
each path becomes one conversation with a mask of the text a model is to learn.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` per turn. Inside roles and texts
``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so no control string can appear there,
and reading back undoes it. DataFrame functions only.

Defined results: NULL role or text is empty, NULL score 0. A NULL tree or node id is an
id like another. Of rows with one tree and node id the least (parent, score, role, text)
stays. A parent that is missing makes its reply a root; messages whose replies form a
ring have no root and give no conversation. Equal scores: the smaller node id first.
Columns beyond those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import let, stage

START, SEP, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def tidy(messages: DataFrame) -> DataFrame:
    """(tree, node, parent, score, role, text), ids never NULL and unique."""
    ids = [F.coalesce(F.col(c).cast("string"), F.lit("\0")).alias(n) for c, n in (("tree_id", "tree"), ("node_id", "node"))]
    rest = F.struct(F.col("parent_id").cast("string").alias("parent"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return messages.select(*ids, rest.alias("rest")).groupBy("tree", "node").agg(F.min("rest").alias("rest")).select("tree", "node", "rest.*")


def ancestors(nodes: DataFrame) -> list[DataFrame]:
    """Tables (tree, node, jump, total): the 2^k-th ancestor, NULL above the root, and the
    score from the node up to just below it. A ring never ends; it is given up when the
    hops exceed the number of messages."""
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("_there"))
    state = nodes.join(known, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("_there"), F.col("parent")).alias("jump"), F.col("score").alias("total"))
    levels, hops, limit = [stage(state, "ancestors")], 1, nodes.count()
    while hops <= limit and not levels[-1].where("jump IS NOT NULL").isEmpty():
        now = levels[-1]
        above = now.select("tree", F.col("node").alias("jump"), F.col("jump").alias("_jump"), F.col("total").alias("_total"))
        moved = now.where("jump IS NOT NULL").join(above, ["tree", "jump"]).select("tree", "node", F.col("_jump").alias("jump"), (F.col("total") + F.col("_total")).alias("total"))
        levels.append(stage(now.where("jump IS NULL").unionByName(moved), "ancestors"))
        hops *= 2
    return levels


def paths(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, leaf, node, above): the messages of each tree's ``per_tree`` best paths, by
    their distance from the leaf."""
    levels = ancestors(nodes)
    parents = nodes.where("parent IS NOT NULL").select("tree", F.col("parent").alias("node"))
    leaves = levels[-1].where("jump IS NULL").join(parents, ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= per_tree)
    found = stage(chosen.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"), "rank", F.col("total").alias("path_score")), "paths")
    for k, level in enumerate(levels[:-1]):
        up = found.join(level.where("jump IS NOT NULL").select("tree", "node", "jump"), ["tree", "node"])
        up = up.select("tree", "leaf", F.col("jump").alias("node"), (F.col("above") + (1 << k)).alias("above"), "rank", "path_score")
        found = stage(found.unionByName(up), "paths")
    return found


def conversations(messages: DataFrame, per_tree: int = 1, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row a chosen path: tree, leaf, rank, path_score, ``formatted`` and ``mask``, spans
    (start from 0, length in code points) of ``formatted`` to learn from."""
    nodes = stage(tidy(messages), "messages")
    told = paths(nodes, per_tree).join(nodes.select("tree", "node", "role", "text"), ["tree", "node"])
    turn = F.struct((-F.col("above")).alias("at"), F.col("role").isin(*learn).alias("learn"), F.concat(F.lit(START), escaped(F.col("role")), F.lit(SEP)).alias("head"), escaped(F.col("text")).alias("body"))
    rows = told.groupBy("tree", "leaf", "rank", "path_score").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    formatted = F.concat_ws("", F.transform("turns", lambda t: F.concat(t.head, t.body, F.lit(STOP))))

    def add(done: Column, t: Column) -> Column:
        begin = done.at + F.length(t.head)
        span = F.array(F.struct(begin.alias("start"), F.length(t.body).alias("length")))
        return F.struct((begin + F.length(t.body) + len(STOP)).alias("at"), F.concat(done.spans, F.when(t.learn, span).otherwise(F.array().cast("array<struct<start:int,length:int>>"))).alias("spans"))

    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    mask = F.aggregate("turns", nothing, add, lambda done: done.spans)
    return rows.select("tree", "leaf", "rank", "path_score", formatted.alias("formatted"), mask.alias("mask"))


def turns(formatted: Column) -> Column:
    """Read back: array of (role, text) of a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>"), lambda p: p != "")
    return F.transform(parts, lambda p: let(F.split(F.substring(p, F.lit(len(START) + 1), F.length(p)), r"<\|im_sep\|>"), lambda s: F.struct(unescaped(F.get(s, F.lit(0))).alias("role"), unescaped(F.get(s, F.lit(1))).alias("text"))))


def learned_text(formatted: Column, mask: Column) -> Column:
    """Read back: the unescaped text under the mask, in order, nothing between."""
    return F.concat_ws("", F.transform(mask, lambda s: unescaped(F.substring(formatted, s.start + 1, s.length))))


def as_chains(rows: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees: each turn replies to
    the one before it; turns of one number follow by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select(F.col("conv_id").alias("tree_id"), F.row_number().over(order).alias("node_id"), "role", "text")
    return numbered.select("tree_id", "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), F.lit(0.0).alias("score"), "role", "text")
