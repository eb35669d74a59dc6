"""Integrity audits and the failure summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(table: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return table.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(child: DataFrame, column: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """References without a parent, and the number of rows holding each.

    Rows are counted per reference before the join, so a hot reference is a
    single row by the time it is shuffled to its parent.
    """
    references = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("orphan_rows"))
    )
    keys = parents.select(F.col(parent_key).alias(column))
    return references.join(keys, column, "left_anti")


def failure_summary(exceptions: DataFrame) -> DataFrame:
    """Failures per source table and error type, most frequent first."""
    return (
        exceptions.groupBy("source_table", "error_type")
        .agg(F.count(F.lit(1)).alias("failures"))
        .orderBy(F.desc("failures"), "source_table", "error_type")
    )
