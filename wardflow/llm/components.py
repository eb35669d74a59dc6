"""Connected components by repeated contraction, on tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: longs); the component is its
    smallest node. Each round every component joins its smallest neighbour, and pointer
    doubling flattens the trees that makes; what is left are edges between components. The
    result is a table of ``scratch``, replaced by the next call."""
    edges = scratch.put(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = nodes.select("node", F.col("node").alias("component"))
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        joins = both.groupBy("a").agg(F.min("b").alias("to")).select(F.col("a").alias("component"), F.least("a", "to").alias("to"))
        joins = flattened(scratch.put(joins, "joins"), scratch)
        labels = scratch.put(labels.join(joins, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")
        ends = [joins.select(F.col("component").alias(c), F.col("to").alias(f"_{c}")) for c in ("a", "b")]
        edges = edges.join(ends[0], "a").join(ends[1], "b").where("_a <> _b")
        edges = scratch.put(edges.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "edges")
    return labels


def flattened(joins: DataFrame, scratch: Scratch) -> DataFrame:
    """Follow ``to`` to the end of every chain."""
    while True:
        further = joins.select(F.col("component").alias("to"), F.col("to").alias("_to"))
        now = scratch.put(joins.join(further, "to", "left").select("component", F.coalesce("_to", "to").alias("to"), (F.coalesce("_to", "to") != F.col("to")).alias("_moved")), "joins")
        joins = now.select("component", "to")
        if now.where("_moved").isEmpty():
            return joins
