"""NULL-only missing values and safe parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stand for a missing value in packed text fields.
MISSING_WORDS = ("nan", "none", "<na>")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """True only for a number that is neither NULL, NaN nor infinite."""
    c = col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def finite_or_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(finite(c), c)


def number_or_null(c: Column | str) -> Column:
    """Text or number to a finite double; anything unreadable becomes NULL (never an ANSI error)."""
    return finite_or_null(col(c).try_cast("double"))


def parse_id(c: Column | str) -> Column:
    """The last run of digits of an id string as a 64-bit integer.

    A leading catalogue name such as ``Gaia DR3`` is no number of the record itself; a string with
    nothing else, without digits, or beyond 64 bits is unreadable and gives NULL."""
    bare = F.regexp_replace(col(c).cast("string"), r"(?i)^\s*gaia\s*e?dr\s*[0-9]+(?![0-9])", "")
    return F.regexp_extract(bare, r"([0-9]+)[^0-9]*$", 1).try_cast("bigint")


def plain_word(c: Column | str) -> Column:
    """A code word without outer blanks and in lower case."""
    return F.lower(F.trim(F.regexp_replace(col(c), r"^\s+|\s+$", "")))

