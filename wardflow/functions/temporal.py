"""Differences of two times counted in unit boundaries crossed.

10:59 to 11:01 is one hour (the clock passed 11:00) although only two minutes
went by. The arithmetic is on calendar fields, so it is exact, stays inside
generated code and does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _days(start: Column, end: Column) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    return _days(start, end) * 24 + (F.hour(end) - F.hour(start))


def minutes_between(start: Column, end: Column) -> Column:
    return hours_between(start, end) * 60 + (F.minute(end) - F.minute(start))
