"""Division that yields NULL on a zero denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` in DOUBLE; NULL when the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
