"""Text to typed values. A value that does not parse becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_number(text: Column) -> Column:
    """Whole number of a text, rounded: ``'12.5'`` is 13, ``'1e3'`` is 1000, ``''`` is NULL."""
    return text.try_cast("decimal(38,0)")


def whole_number(value: Column) -> Column:
    """A number in the type of keys."""
    return value.cast("decimal(38,0)")


def try_key(text: Column) -> Column:
    """A text as a key: a whole number of up to 38 digits."""
    return try_number(text)


def try_date(text: Column) -> Column:
    return F.try_to_date(text)


def try_time(text: Column) -> Column:
    """Wall-clock time; a date without a time is midnight."""
    return text.try_cast("timestamp_ntz")


def try_amount(text: Column) -> Column:
    """Money as DOUBLE. Text such as ``NaN`` that is no decimal number is NULL."""
    return F.when(try_number(text).isNotNull(), text.try_cast("double"))


_BY_KIND = {
    "key": try_key,
    "int": try_key,
    "date": try_date,
    "timestamp": try_time,
    "double": try_amount,
    "string": lambda text: text,
}


def silver_value(text: Column, kind: str) -> Column:
    """The typed form of a landing column of the given kind."""
    return _BY_KIND[kind](text)
