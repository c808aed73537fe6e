"""History of a dimension: one row per version of a key, from successive snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.operators.lookup import BROADCAST_LIMIT, lookup_join

VALIDITY = ("valid_from", "valid_to", "is_current")


def open_history(snapshot: DataFrame, as_of: Column) -> DataFrame:
    """The first snapshot: every row is current."""
    return snapshot.withColumns(
        {"valid_from": as_of.cast("date"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)}
    )


def apply_snapshot(history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: Column) -> DataFrame:
    """History after one more snapshot, taken at `as_of`.

    A key with a changed tracked column gets its current row closed and a new one opened; a new key is
    opened; an unchanged key, or one the snapshot does not have, stays as it is. Applying the same
    snapshot again changes nothing.

    A snapshot older than a key's current row leaves that row alone.

    Everything comes from one join on key and currency: closed rows meet nothing and pass through, the
    others are one row per key on both sides. `history` is read once, so plans grow by a join a snapshot.
    """
    columns = snapshot.columns
    as_of = as_of.cast("date")
    known = history.select(F.col(key), "is_current", F.struct(*columns, "valid_from", "valid_to").alias("old"))
    latest = snapshot.select(F.col(key), F.lit(True).alias("is_current"), F.struct(*columns).alias("new"))
    both = known.join(latest, [key, "is_current"], "full")
    changed = reduce(or_, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in tracked])

    def version(row: str, valid_from: Column, valid_to: Column) -> Column:
        return F.struct(
            *[F.col(f"{row}.{c}").alias(c) for c in columns],
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
            valid_to.isNull().alias("is_current"),
        )

    still_open = F.lit(None).cast("date")
    kept = version("old", F.col("old.valid_from"), F.col("old.valid_to"))
    closed = version("old", F.col("old.valid_from"), as_of)
    opened = version("new", as_of, still_open)
    versions = (
        F.when(F.col("old").isNull(), F.array(opened))
        .when(F.col("new").isNull() | ~changed | (as_of < F.col("old.valid_from")), F.array(kept))
        .otherwise(F.array(closed, opened))
    )
    return both.select(F.inline(versions))


def in_force(
    rows: DataFrame,
    history: DataFrame,
    key: str,
    day: str,
    attributes: Sequence[str],
    spread_on: list[str],
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """`rows` with the `attributes` that `key` had on `day`: those of the version with valid_from <= day <
    valid_to, null where there was none yet, or where key or day is null. No row is lost or repeated.

    The versions of a key, as many as it had snapshots with a change, become one row with a list, so this is
    a lookup by key: broadcast where the history is measured to be small, and hot keys cut into pieces by a
    hash of `spread_on` where it is not. The day picks from the list; there is no range condition between
    tables, and no sorting of all rows of a key.
    """
    version = F.struct("valid_from", "valid_to", *attributes)
    versions = history.groupBy(key).agg(F.collect_list(version).alias("_versions"))
    found = lookup_join(rows, versions, key, spread_on=spread_on, profile=rows, limit=limit)

    def covers(v: Column) -> Column:
        return (v["valid_from"] <= F.col(day)) & (v["valid_to"].isNull() | (F.col(day) < v["valid_to"]))

    # Versions of a key do not overlap; were two to, the later one would count.
    then = F.array_max(F.filter("_versions", covers))
    return found.withColumn("_then", then).select("*", *[F.col(f"_then.{a}").alias(a) for a in attributes]).drop(
        "_versions", "_then"
    )
