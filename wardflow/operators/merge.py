"""Keyed merge of deduplicated source rows into a target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


UPDATE = "_update"


def merge_changes(
    target: DataFrame, source: DataFrame, key: str, update_columns: Sequence[str]
) -> DataFrame:
    """Only the rows a merge writes: full new images of inserted and updated keys,
    told apart by the boolean ``_update``.

    A matched row keeps its target values except ``update_columns``, which take
    the source's, NULL included. Without ``update_columns`` a matched row is
    left alone, so the result holds the inserts only and just the target's key
    column is used. The result is as long as the source, never the target.
    """
    if not update_columns:
        return source.join(target.select(key), key, "left_anti").withColumn(UPDATE, F.lit(False))
    kept = [c for c in source.columns if c != key and c not in update_columns]
    old = target.select(key, F.lit(True).alias("_matched"), *[F.col(c).alias(f"_old_{c}") for c in kept])
    joined = source.join(old, key, "left")
    matched = F.coalesce("_matched", F.lit(False))
    images = [
        F.when(matched, F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in kept else F.col(c)
        for c in source.columns
    ]
    return joined.select(*images, matched.alias(UPDATE))


def merge(target: DataFrame, source: DataFrame, key: str, update_columns: Sequence[str]) -> DataFrame:
    """The whole target after the merge."""
    columns = target.columns
    if not update_columns:
        return target.unionByName(merge_changes(target, source, key, ()).select(*columns))
    old = target.select(F.lit(True).alias("_in_target"), *[F.col(c).alias(f"_old_{c}") for c in columns])
    new = source.select(F.lit(True).alias("_in_source"), *columns)
    joined = old.join(new, F.col(f"_old_{key}") == F.col(key), "full_outer")

    def pick(column: str):
        from_source = F.col("_in_source") if column in update_columns else F.col("_in_target").isNull()
        return F.when(from_source, F.col(column)).otherwise(F.col(f"_old_{column}")).alias(column)

    return joined.select(*[pick(c) for c in columns])
