"""Role-based masking of personal columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.domains import ADMIN_ROLES, MASK_TEXT


def mask(value: Column, role: Column) -> Column:
    """The value for an administrator role, the mask text, also for NULL, otherwise."""
    return F.when(role.isin(*ADMIN_ROLES), value).otherwise(MASK_TEXT)


def masked(df: DataFrame, columns: Sequence[str], role: str) -> DataFrame:
    return df.withColumns({c: mask(F.col(c), F.lit(role)).alias(c) for c in columns})
