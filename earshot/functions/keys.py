"""Content-derived keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key format: what stands for null, and what ends the length before a text.
NULL_MARK = "n"
LENGTH_END = ":"


def surrogate_key(*columns: str) -> Column:
    """md5 over the named columns as text, in the order given.

    Each text stands behind its length, and null is a mark that no length begins with, so different rows
    never hash the same input; two rows that are null in the same places share a key.
    """

    def part(name: str) -> Column:
        text = F.col(name).cast("string")
        coded = F.concat(F.char_length(text).cast("string"), F.lit(LENGTH_END), text)
        return F.coalesce(coded, F.lit(NULL_MARK))

    return F.md5(F.concat(*[part(c) for c in columns]))
