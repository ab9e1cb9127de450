"""Typing of text cells. A value that does not fit its declared type becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400

# Declared type name for columns that arrive as epoch seconds and leave as dates.
EPOCH_DATE = "epoch_date"
WHOLE = ("tinyint", "smallint", "int", "integer", "bigint", "long")


def epoch_to_date(seconds: Column) -> Column:
    """UTC calendar day of an epoch-seconds value.

    Works on day numbers, so the session time zone plays no part. Days are floored, so instants
    before 1970 fall on their own day. The double division is exact enough for every day number
    that fits an int; anything beyond becomes null.
    """
    days = F.floor(whole_number(seconds, "bigint") / F.lit(SECONDS_PER_DAY))
    return F.date_from_unix_date(days.try_cast("int"))


def whole_number(cell: Column, type_name: str) -> Column:
    """A whole number in any spelling, such as ``75``, ``75.0`` or ``1.7E9``; null if it is none.

    A fraction is told by its digits, however many there are. With an exponent, digits beyond the 18th place
    after the point of the number so written don't count.
    """
    text = cell.cast("string")
    number = cell.try_cast("decimal(38,18)")
    fraction = text.rlike(r"\.0*[1-9]\d*\s*$")
    whole = F.when((number == F.floor(number)) & ~fraction, number.try_cast(type_name))
    return F.coalesce(cell.try_cast(type_name), whole)


def typed(cell: Column, type_name: str) -> Column:
    """A text cell as its declared type; ``epoch_date`` or any Spark type name."""
    if type_name == EPOCH_DATE:
        return epoch_to_date(cell)
    if type_name in WHOLE:
        return whole_number(cell, type_name)
    return cell if type_name == "string" else cell.try_cast(type_name)
