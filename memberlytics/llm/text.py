"""Column expressions on text that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else.

    On pure ASCII text the built-in ``lower`` does the same and is faster.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """Words of lower-cased text: runs of digits, letters a-z and characters beyond ASCII.  Null has no words."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), WORD_BREAK, -1), "")
