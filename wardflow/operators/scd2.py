"""Slowly changing dimensions, type 2: close the current version, open a new one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, FLAG = "effective_start_date", "effective_end_date", "current_flag"
CURRENT, CLOSED = "Y", "N"


def _as_of(as_of: dt.date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col(FLAG) == CURRENT)


def history(dim: DataFrame, key: str, value: int) -> DataFrame:
    """All versions of one key, oldest first."""
    return dim.where(F.col(key) == value).orderBy(START)


def open_versions(silver: DataFrame, attributes: list[str], as_of: dt.date | None) -> DataFrame:
    """Every silver row as a new current version."""
    return silver.select(
        *attributes,
        _as_of(as_of).alias(START),
        F.lit(None).cast("date").alias(END),
        F.lit(CURRENT).alias(FLAG),
    )


def close_matched(
    current_rows: DataFrame, silver: DataFrame, key: str, as_of: dt.date | None
) -> DataFrame:
    """Current versions, those whose key is in ``silver`` closed as of the day before."""
    keys = silver.select(F.col(key).alias("_key")).distinct().withColumn("_hit", F.lit(True))
    joined = current_rows.join(keys, F.col(key) == F.col("_key"), "left")
    hit = F.col("_hit")
    columns = []
    for c in current_rows.columns:
        value = F.col(c)
        if c == END:
            value = F.when(hit, F.date_sub(_as_of(as_of), 1)).otherwise(value)
        elif c == FLAG:
            value = F.when(hit, CLOSED).otherwise(value)
        columns.append(value.alias(c))
    return joined.select(*columns)


def expire(dim: DataFrame, silver: DataFrame, key: str, as_of: dt.date | None = None) -> DataFrame:
    """The whole dimension after the closing step. Closed history is passed
    through: only current rows take part in the join."""
    closed_before = dim.where(~F.col(FLAG).eqNullSafe(CURRENT))
    return closed_before.unionByName(close_matched(current(dim), silver, key, as_of))


def changed_only(
    silver: DataFrame, current_rows: DataFrame, key: str, attributes: list[str]
) -> DataFrame:
    """Silver rows that are new or differ, NULL-safe, from their current version."""
    old = current_rows.select(F.struct(*attributes).alias("_old"), F.col(key).alias("_key"))
    joined = silver.join(old, F.col(key) == F.col("_key"), "left")
    same = F.col("_old").isNotNull() & F.struct(*attributes).eqNullSafe(F.col("_old"))
    return joined.where(~same).select(*silver.columns)


def refresh(
    dim: DataFrame,
    silver: DataFrame,
    key: str,
    as_of: dt.date | None = None,
    *,
    only_changed: bool = False,
) -> DataFrame:
    """Close and reopen. By default every silver row gets a new version, changed
    or not; ``only_changed`` limits this to real changes."""
    attributes = [c for c in dim.columns if c not in (START, END, FLAG)]
    if only_changed:
        silver = changed_only(silver, current(dim), key, attributes)
    return expire(dim, silver, key, as_of).unionByName(open_versions(silver, attributes, as_of))
