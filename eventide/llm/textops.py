"""Word and line columns shared by the text operators; built-in functions only.

A word is a maximal run of characters other than U+0020 and U+0009 to U+000D.
Null texts behave as empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters between words besides the space, and the word pattern as a regular expression.
OTHER_SPACES = "\t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]"


def whole(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def spaced_parts(text: Column) -> Column:
    """The text cut at every separator: n separators give n + 1 parts, empty ones included."""
    for c in OTHER_SPACES:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.split(text, " ", -1)


def words(text: Column) -> Column:
    return F.array_remove(spaced_parts(text), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, inside one expression."""
    return F.transform(F.array(value), body)[0]
