"""The prefix trie of conversations, by digests of fixed-length blocks of turns.

Every turn carries the digest of the conversation up to it: the exclusive or of the hashes
of (position, role, text) so far, two 64-bit words. The digest at the end of a block of
``BLOCK`` turns stands for the whole prefix. Conversations are first grouped by block: equal
(block, digest before, digest after) are one, and counted. A block without siblings (all that
reach its beginning also reach its end) is a chain, whose turns are nodes as they stand. Only
where siblings diverge are turn boundaries refined: the turns of the distinct siblings are
grouped by their own digests.

Sums over subtrees take log2(depth) rounds: each node hands what lies less than 2^t below it
to its ancestor 2^t above, which is found on the path of the node's own smallest member. Only
nodes with two or more members take part; below the others every subtree has one leaf and
saves nothing.

Defined results: rows without a conv_id belong to no conversation and are left out. NULL roles
and texts are empty. Turns are ordered by turn (NULL first), then role and text, so equal rows
in any order give one result. An empty table has no nodes. A conversation of any length is
rows, never one array. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import running_total, stage

BLOCK = 4  # turns
NODE = ("depth", "p1", "p2")
TURNS_A_CELL = 1024


def numbered(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text): turns by position from 0, whatever their numbers."""
    told = rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.lit(1).cast("long").alias("one"),
    )
    cell = F.coalesce(F.floor(F.col("turn") / TURNS_A_CELL), F.lit(-(1 << 62)))
    return running_total(told, ["conv_id"], ["turn", "role", "text"], cell, "one", "pos").select("conv_id", "pos", "role", "text")


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, q1, q2, chars): the digest up to each turn and before it."""
    told = turns.select(
        "conv_id", (F.col("pos") + 1).alias("depth"), F.length("text").cast("long").alias("chars"),
        F.xxhash64("pos", "role", "text").alias("d1"), F.xxhash64(F.lit("second"), "text", "role", "pos").alias("d2"),
    )
    so_far = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    told = told.select("conv_id", "depth", "chars", "d1", "d2", F.bit_xor("d1").over(so_far).alias("p1"), F.bit_xor("d2").over(so_far).alias("p2"))
    return told.select("conv_id", "depth", "p1", "p2", F.col("p1").bitwiseXOR(F.col("d1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("d2")).alias("q2"), "chars")


def turn_nodes(path: DataFrame) -> DataFrame:
    """(depth, p1, p2, q1, q2, conv_id, n_convs, chars): the nodes below the root."""
    turn = F.struct("depth", "p1", "p2", "q1", "q2", "chars")
    one = path.groupBy("conv_id", F.floor((F.col("depth") - 1) / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    first, last = F.element_at("turns", 1), F.element_at("turns", -1)
    ends = [first["q1"].alias("s1"), first["q2"].alias("s2"), last["p1"].alias("e1"), last["p2"].alias("e2")]
    key = ["block", "s1", "s2", "e1", "e2"]
    blocks = one.select("conv_id", "block", *ends, "turns").groupBy(*key)
    blocks = stage(blocks.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.any_value("turns").alias("turns")), "blocks")
    alone = blocks.groupBy("block", "s1", "s2").agg(F.count(F.lit(1)).alias("n"), F.min("e1").alias("e1"), F.min("e2").alias("e2"))
    # Joined on the whole key, which is unique: a place with many siblings is no hot key.
    alone = alone.where("n = 1").drop("n")
    as_turns = lambda rows: rows.select("conv_id", "n_convs", F.inline("turns"))
    chains = as_turns(blocks.join(alone, key, "left_semi")).select(*NODE, "q1", "q2", "conv_id", "n_convs", "chars")
    diverging = as_turns(blocks.join(alone, key, "left_anti")).groupBy(*NODE, "q1", "q2")
    refined = diverging.agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("chars").alias("chars"))
    return chains.unionByName(refined)


def ids_digest(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): the ids that end at a node, ascending, comma-joined, digested as
    a stream over sorted rows: no list of them is ever held."""
    schema = "depth long, p1 long, p2 long, ends_sha256 string"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, now, state = [*NODE, "ends_sha256"], None, None
        for batch in batches:
            done = []
            for *node, conv in zip(*[batch.column(c).to_pylist() for c in (*NODE, "conv_id")], strict=True):
                if node != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string() if k == 3 else pa.int64()) for k in range(4)], names=names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.string() if k == 3 else pa.int64()) for k, v in enumerate((*now, state.hexdigest()))], names=names)

    return ends.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id").mapInArrow(digest, schema)


def subtree_sums(shared: DataFrame, path: DataFrame, amounts: list[str]) -> DataFrame:
    """(node, amounts): for nodes (depth, p1, p2, q1, q2, conv_id, amounts) the sums of the
    amounts over their subtrees. ``q1, q2`` are replaced by farther ancestors as rounds pass."""
    state = shared.select(*NODE, "conv_id", "q1", "q2", *amounts)
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    step = 1
    while step <= deepest:
        up = state.where(F.col("depth") >= step).groupBy((F.col("depth") - step).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
        up = up.agg(*[F.sum(a).alias(f"_{a}") for a in amounts])
        state = state.join(up, list(NODE), "left").select(*NODE, "conv_id", "q1", "q2", *[(F.col(a) + F.coalesce(f"_{a}", F.lit(0))).alias(a) for a in amounts])
        step *= 2
        if step <= deepest:
            above = path.select("conv_id", (F.col("depth") + step).alias("depth"), F.col("p1").alias("a1"), F.col("p2").alias("a2"))
            state = state.join(above, ["conv_id", "depth"], "left").select(*NODE, "conv_id", F.coalesce("a1", F.lit(0)).alias("q1"), F.coalesce("a2", F.lit(0)).alias("q2"), *amounts)
        state = stage(state, "sums")
    return state.select(*NODE, *amounts)


def with_parents(nodes: DataFrame, kids: DataFrame) -> DataFrame:
    """Add the parent's conv_id. Parents of over a thousandth of all nodes are fewer than a
    thousand: those are broadcast, the others joined on their digest."""
    total = nodes.count()
    parents = kids.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    link = ["depth", "q1", "q2"]
    hot = F.broadcast(parents.where(F.col("n_children") * 1000 > total).drop("n_children"))
    busy = nodes.join(hot, link)
    rest = nodes.join(hot, link, "left_anti").join(parents.where(F.col("n_children") * 1000 <= total).drop("n_children"), link, "left")
    return busy.unionByName(rest)


def trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos from 0 without gaps, role, text)
    for the conversations ``ids`` (conv_id, distinct; those without turns end at the root):
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    path = stage(paths(turns), "paths")
    zero = F.lit(0).cast("long")
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in (*NODE, "q1", "q2")], "conv_id", "n_convs", zero.alias("chars"))
    nodes = stage(turn_nodes(path).unionByName(root), "nodes")

    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    kids = below.agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("lone"))
    nodes = nodes.join(kids, list(NODE), "left").na.fill(0, ["n_children", "lone"])
    nodes = stage(nodes, "nodes_with_children")
    leaves = F.col("lone") + F.when(F.col("n_children") == 0, 1).otherwise(0)
    shared = nodes.where("n_convs > 1").withColumns({"n_leaves": leaves, "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")})
    sums = subtree_sums(shared, path, ["n_leaves", "saved_tokens"])

    last = path.groupBy("conv_id").agg(F.max(F.struct(*NODE)).alias("last"))
    ends = ids.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(F.col("last")[c], zero).alias(c) for c in NODE])
    whole = with_parents(nodes, nodes.where("n_children > 0")).join(sums, list(NODE), "left").join(ids_digest(ends), list(NODE), "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def spliced(turns: DataFrame, ids: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """(conv_id, pos, role, text): each conversation's first ``heads`` turns (at most ``most``)
    replaced by as many of conversation ``base`` (all if it has fewer, none if it is absent)."""
    plan = ids.select("conv_id", base.alias("base"), heads.cast("long").alias("heads"))
    lengths = turns.groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).alias("n_base"))
    plan = plan.join(lengths, "base", "left").withColumn("taken", F.least("heads", F.coalesce("n_base", F.lit(0))))
    front = turns.where(F.col("pos") < most).withColumnRenamed("conv_id", "base").join(plan, "base").where("pos < taken")
    own = turns.join(plan, "conv_id").where("pos >= heads").withColumn("pos", F.col("pos") - F.col("heads") + F.col("taken"))
    columns = ["conv_id", "pos", "role", "text"]
    return front.select(*columns).unionByName(own.select(*columns))
