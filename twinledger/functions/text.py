"""Text predicates used by cleansing and validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from twinledger.schema import WHITESPACE


def strip_ws(c: Column) -> Column:
    """Strip all whitespace from both ends (Spark's one-argument ``trim`` strips spaces only).

    A text that begins and ends with a visible ASCII character has nothing to strip. Comparing
    tells that far sooner than trimming, which looks every character up in the list.
    """
    begins = (c >= F.lit("!")) & (c < F.lit("\x7f"))
    ends = F.substring(c, -1, 1).between("!", "~")
    return F.when(begins & ends, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def is_blank(c: Column) -> Column:
    """True for NULL, empty and whitespace-only text.

    A text that begins with a visible ASCII character is told by comparing; only others are searched.
    """
    begins = (c >= F.lit("!")) & (c < F.lit("\x7f"))
    return c.isNull() | ~(begins | c.rlike(f"[^{WHITESPACE}]"))


def contains_ignore_case(c: Column, term: str) -> Column:
    """Case-insensitive substring test with a trimmed term; an empty term matches everything."""
    wanted = (term or "").upper().strip()
    return F.upper(c).contains(wanted) if wanted else F.lit(True)


def time_of_day(c: Column) -> Column:
    """The part after ``T``, or the whole text when there is none."""
    return F.coalesce(F.nullif(F.get(F.split(c, "T"), F.lit(1)), F.lit("")), c)
