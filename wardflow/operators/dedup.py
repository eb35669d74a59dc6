"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.domains import LOAD_TIME


def latest_per_key(
    rows: DataFrame, key: str, order: Sequence[Column] | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    """Keep the newest row of every ``key``.

    Default order: ``load_time``, then the ``ties`` columns, then every other
    column, all descending, so the pick never depends on how rows were spread.
    Spark keeps one row per key and task before the shuffle, so a key holding a
    third of all rows sends at most one row per task.
    """
    if order is None:
        rest = [c for c in rows.columns if c not in (key, LOAD_TIME, *ties)]
        order = [F.col(c).desc_nulls_last() for c in (LOAD_TIME, *ties, *rest)]
    newest = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
