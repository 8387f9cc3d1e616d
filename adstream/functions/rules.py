"""Column expressions of the fraud rules.

All follow SQL's three-valued logic: an unknown input gives an unknown flag.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def over_limit(value: Column, limit: int) -> Column:
    """Strictly above the limit."""
    return value > F.lit(limit)


def instant_click(delay_ms: Column, limit_ms: int) -> Column:
    """The click came sooner than a person could have reacted."""
    return delay_ms < F.lit(limit_ms)


def any_flag(*flags: Column) -> Column:
    """TRUE if one flag is TRUE, else NULL if one is NULL, else FALSE."""
    return reduce(or_, flags)


def flag_count(flag: Column) -> Column:
    """How many rows of a group carry the flag; NULL if all of them are NULL."""
    return F.sum(flag.cast("int"))


def share(part: Column, whole: Column, digits: int) -> Column:
    """Rounded ratio, NULL instead of an error when the whole is zero."""
    return F.round(F.try_divide(part, whole), digits)


def percentage(part: Column, whole: Column, digits: int = 1) -> Column:
    """Rounded percentage, NULL when the whole is zero."""
    return F.round(F.try_divide(part, whole) * 100, digits)
