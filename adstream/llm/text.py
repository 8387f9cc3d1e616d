"""Words as column expressions: runs of anything but ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ASCII white space characters.
SPACES = " \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
WORD_CHARACTER = r"[^\x20\x09-\x0D]"


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words in order; an empty array for NULL or a text without words."""
    return F.filter(F.split(whole(text), SPACE_PATTERN, -1), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, without holding them on to."""
    trimmed = F.regexp_replace(whole(text), rf"^{SPACE_PATTERN}|{SPACE_PATTERN}$", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_PATTERN, -1))).cast("long")
