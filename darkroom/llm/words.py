"""Column expressions for words, shared by the native operators.

A word is a longest run of characters other than space and U+0009..U+000D.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"


def flat_text(text: Column) -> Column:
    """The text with every white-space character as a plain space; null as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES[1:]:
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for null and for white space only.

    A split at one plain character and `array_remove` avoid regular expressions."""
    return F.array_remove(F.split(flat_text(text), " "), "")


def word_count(text: Column) -> Column:
    """Number of words, as a long."""
    return F.size(words_of(text)).cast("long")
