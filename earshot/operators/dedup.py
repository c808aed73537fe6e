"""Exact duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per distinct content, optionally with the number of copies.

    A hash aggregate on the columns themselves: copies merge before the shuffle, so a row repeated a
    billion times sends one row per map task, and later filters on the columns move below it into the
    scan. A row number over a hash would sort everything and keep filters above the window.
    """
    if copies is None:
        return df.distinct()
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))


def one_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key, any of them: for rows that are equal wherever the key is."""
    return df.dropDuplicates(list(keys))
