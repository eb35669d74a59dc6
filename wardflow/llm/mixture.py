"""Mixing sources to target weights by hierarchical budgeting.

The tree is domain - language - source; a leaf's supply is the tokens of its documents
times ``max_epochs``. A budget goes down from the root: siblings share what their
parent got in proportion to their weights, none gets more than its subtree supplies,
and what one cannot take goes to its siblings. Only what a whole subtree cannot take
has gone to the siblings of an ancestor, because subtrees are filled top down.

A leaf then takes the token prefix of its seeded epochs: every epoch orders the leaf's
documents anew by a seeded hash; whole epochs first, then documents of the next one
while their tokens fit in what is left. The document that crosses the end is taken if at
least half of it fits, so a leaf is within half a document of its budget. Running totals are kept in two levels, so a leaf
with a third of all documents is not one task's work. DataFrame functions only.

Defined results: NULL keys are groups of their own; a key without a weight has weight
``default_weight``; NULL text has no tokens and is chosen with the tokens before it
(it costs nothing); an empty table gives no rows. Rows that share doc_id and place in the
tree stand or fall together, with the sum of their tokens. Other columns are not read, so
clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.common import running_total, stage, words

LEVELS = ("domain", "language", "origin")
PREFIX_CELLS = 4096  # cells of a leaf's seeded order


def share_out(children: DataFrame, parents: list[str]) -> DataFrame:
    """Water level of each set of siblings: ``children`` has the parents' columns, the
    parent's ``budget``, own ``weight`` and ``supply``; adds ``granted``.

    Sorted by supply over weight, siblings that run short come first; the level is what
    is left for the others over their weights. Doubles; a set's rows are tree nodes,
    not documents."""
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ordered = siblings.orderBy(F.col("supply") / F.col("weight"), "weight", *[F.col(c) for c in children.columns if c in LEVELS])
    short = ordered.rowsBetween(Window.unboundedPreceding, -1)
    onward = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("supply").over(short), F.lit(0.0))) / F.sum("weight").over(onward)
    # The first sibling whose own ratio reaches its level fixes the level of all later ones.
    children = children.withColumn("_level", level).withColumn("_met", F.col("_level") <= F.col("supply") / F.col("weight"))
    met = F.first(F.when(F.col("_met"), F.col("_level")), ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return children.withColumn("granted", F.least(F.col("supply"), F.coalesce(met * F.col("weight"), F.col("supply")))).drop("_level", "_met", "budget")


def budgets(supply: DataFrame, weights: Mapping[str, Mapping[str, float]], budget: Column, max_epochs: int, default_weight: float = 1.0) -> DataFrame:
    """Leaves (domain, language, origin, tokens) plus ``granted`` tokens. ``weights`` maps a
    level's name to weights by key; they hold wherever the key stands in the tree."""
    leaves = supply.withColumn("supply", F.col("tokens").cast("double") * max_epochs)
    whole = leaves.agg(F.least(F.sum("supply"), budget.cast("double"))).first()[0] or 0.0
    granted = None
    for depth in range(1, len(LEVELS) + 1):
        keys = list(LEVELS[:depth])
        nodes = leaves.groupBy(*keys).agg(F.sum("supply").alias("supply"))
        known = weights.get(keys[-1], {})
        weight = F.lit(None).cast("double")
        for key, value in known.items():
            weight = F.when(F.col(keys[-1]) == key, F.lit(float(value))).otherwise(weight)
        nodes = nodes.withColumn("weight", F.coalesce(weight, F.lit(float(default_weight))))
        if depth == 1:
            nodes = nodes.withColumn("budget", F.lit(float(whole)))
        else:
            up = keys[:-1]
            on = [F.col(f"n.{k}").eqNullSafe(F.col(f"p.{k}")) for k in up]
            nodes = nodes.alias("n").join(granted.alias("p"), on).select("n.*", F.col("p.granted").alias("budget"))
        granted = share_out(nodes.where("weight > 0"), keys[:-1])
    return granted.select(*LEVELS, "supply", "granted")


def seeded(seed: int, epoch: Column, doc_id: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch.cast("long"), doc_id.cast("string"))


def mix(
    docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, float]], share: float = 0.5, max_epochs: int = 2, seed: int = 42
) -> DataFrame:
    """Chosen documents: doc_id, domain, language, origin, tokens, order key, ``copies``
    (in how many epochs each was taken). The budget is ``share`` of the corpus' tokens."""
    keys = [domain.cast("string").alias("domain"), F.col("lang").cast("string").alias("language"), F.col("source").cast("string").alias("origin")]
    keyed = docs.select("doc_id", *keys, F.size(words(F.col("text"))).cast("long").alias("tokens"))
    keyed = keyed.groupBy("doc_id", *LEVELS).agg(F.sum("tokens").alias("tokens"))
    keyed = stage(keyed, "mix_documents")
    supply = keyed.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents"))
    total = keyed.agg(F.sum("tokens")).first()[0] or 0
    leaves = budgets(supply, weights, F.lit(float(total * share)), max_epochs)
    leaves = leaves.withColumn("tokens_once", F.col("supply") / max_epochs)
    leaves = leaves.withColumn("whole", F.when(F.col("tokens_once") > 0, F.floor(F.col("granted") / F.col("tokens_once") + 1e-9)).otherwise(F.lit(max_epochs)).cast("long"))
    leaves = leaves.withColumn("rest", F.greatest(F.lit(0.0), F.floor(F.col("granted") - F.col("whole") * F.col("tokens_once") + 1e-6)).cast("long"))
    leaves = stage(leaves.select(*LEVELS, "whole", "rest"), "mix_leaves")
    on = [F.col(f"d.{k}").eqNullSafe(F.col(f"l.{k}")) for k in LEVELS]
    joined = keyed.alias("d").join(leaves.alias("l"), on).select("d.*", "l.whole", "l.rest")
    joined = joined.withColumn("_order", seeded(seed, F.col("whole"), F.col("doc_id")))
    cell = F.floor((F.col("_order") / F.lit(2.0**63) + 1) * (PREFIX_CELLS / 2))
    placed = running_total(joined, list(LEVELS), ["_order", "doc_id", "tokens"], cell, "tokens", "_before")
    taken = 2 * F.col("_before") + F.col("tokens") <= 2 * F.col("rest")
    # Texts without tokens fit in any rest, so they too stop at the last epoch.
    copies = F.least(F.col("whole") + F.when(taken, 1).otherwise(0), F.lit(max_epochs)).cast("long")
    return placed.withColumn("copies", copies).where("copies > 0").select("doc_id", *LEVELS, "tokens", "copies")


def mixed_rows(docs: DataFrame, domain: Column, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``mix`` chose, once each whatever their ``copies``."""
    tree = dict(zip(LEVELS, (domain, F.col("lang"), F.col("source")), strict=True))
    # All given columns are one, so none clashes with the tree's.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, *[c.cast("string").alias(k) for k, c in tree.items()])
    on = [F.col("d.row.doc_id").eqNullSafe(F.col("c.doc_id")), *[F.col(f"d.{k}").eqNullSafe(F.col(f"c.{k}")) for k in LEVELS]]
    chosen_rows = keyed.alias("d").join(chosen.alias("c"), on, "left_semi")
    return chosen_rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
