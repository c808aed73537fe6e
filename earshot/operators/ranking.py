"""Ordered reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rank_by(df: DataFrame, metric: str, *tie_break: str) -> DataFrame:
    """Highest metric first, missing last; the tie-break columns make the order total."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break])


def top(df: DataFrame, n: int, metric: str, *tie_break: str) -> DataFrame:
    """The n highest: each task keeps its own n, so nothing is sorted globally."""
    return rank_by(df, metric, *tie_break).limit(n)


def best_per_group(df: DataFrame, group: str, metric: str, *tie_break: str) -> DataFrame:
    """The row with the highest metric of each group, lowest tie-break first among equals, and the
    group's total as `total_<metric>`.

    An aggregate and not a row number: rows merge in the map tasks, so a group of any size reaches
    the shuffle as one row per task. Spark sorts a task's rows by group for it, as a minimum of structs
    has no fixed width, but never the rows of a group among themselves. The tie-break columns have to make the
    order total, or the choice among equals is open.
    """
    others = [c for c in df.columns if c not in (group, metric, *tie_break)]
    # The smallest of (-metric, tie-break...) is the best; what it holds is unpacked again.
    ranked = F.struct((-F.col(metric)).alias("_rank"), *tie_break, *others)
    best = df.groupBy(group).agg(F.min(ranked).alias("_best"), F.sum(metric).alias(f"total_{metric}"))
    kept = [F.col(f"_best.{c}").alias(c) for c in (*tie_break, *others)]
    return best.select(group, *kept, (-F.col("_best._rank")).alias(metric), f"total_{metric}")


#: Steps in which `running_sums` cuts each doubling of the column that it goes along.
STEPS = 8


def running_sums(df: DataFrame, along: str, columns: list[str]) -> DataFrame:
    """`df` with, for each of `columns`, `<column>_through`: its sum over the rows whose `along` is as large or
    larger, and `all_<column>`: its sum over all rows. `along` is a whole number from 1.

    Rows are ordered within ranges of `along`, an eighth of a doubling each, so there are some five hundred ranges
    at most whatever the table; what comes before a range follows from the sums of the ranges. No task
    holds all rows, as with a window without partitions.
    """
    ranged = df.withColumn("_range", F.floor(F.log2(F.col(along).cast("double")) * STEPS))
    totals = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_{c}") for c in columns])
    # Each range is added to all ranges that a long can be in, five hundred times five hundred rows at most.
    every = F.sequence(F.lit(0).cast("long"), F.lit(63 * STEPS).cast("long"))
    met = totals.withColumnRenamed("_range", "_other").withColumn("_range", F.explode(every))
    above = F.col("_other") > F.col("_range")
    offsets = met.groupBy("_range").agg(
        *[F.coalesce(F.sum(F.when(above, F.col(f"_{c}"))), F.lit(0)).alias(f"_above_{c}") for c in columns],
        *[F.sum(f"_{c}").alias(f"all_{c}") for c in columns],
    )
    down = Window.partitionBy("_range").orderBy(F.col(along).desc())
    within = ranged.withColumns({f"{c}_through": F.sum(c).over(down) for c in columns})
    placed = within.join(F.broadcast(offsets), "_range")
    return placed.withColumns({f"{c}_through": F.col(f"{c}_through") + F.col(f"_above_{c}") for c in columns}).drop(
        "_range", *[f"_above_{c}" for c in columns]
    )
