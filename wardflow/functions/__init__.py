"""Column expressions and small plan helpers, all built from Spark functions."""

from wardflow.functions.casts import silver_value, try_amount, try_date, try_key, try_number, try_time
from wardflow.functions.ratios import ratio
from wardflow.functions.temporal import hours_between, minutes_between

__all__ = [
    "hours_between",
    "minutes_between",
    "ratio",
    "silver_value",
    "try_amount",
    "try_date",
    "try_key",
    "try_number",
    "try_time",
]
