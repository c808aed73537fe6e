"""Data-quality checks. Each gives rows (check, target, failing_rows): a pass is a row with 0.

Checks on single rows of one table are fused into one aggregate over it; keys are counted per map
task before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ("check", "target", "failing_rows")


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def report(check: str, target: str, one_number: DataFrame) -> DataFrame:
    """One row of a report, from a frame of one number."""
    return one_number.select(
        F.lit(check).alias("check"),
        F.lit(target).alias("target"),
        F.coalesce(F.col(one_number.columns[0]), F.lit(0)).cast("long").alias("failing_rows"),
    )


def check_rows(df: DataFrame, failing: list[tuple[str, str, Column]]) -> DataFrame:
    """Any number of (check, target, failing condition) over one table in one pass."""
    names = [f"{check}{i}" for i, (check, _, _) in enumerate(failing)]
    totals = df.agg(*[F.count_if(bad).alias(name) for name, (_, _, bad) in zip(names, failing)])
    return _unpivot(totals, {name: target for name, (_, target, _) in zip(names, failing)})


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_not_among(column: str, values: Iterable[str]) -> Column:
    """Null passes: being present is another check's business."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their count; keys with a null are left out."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def check_unique(df: DataFrame, target: str, *keys: str, check: str = "unique") -> DataFrame:
    return report(check, target, duplicate_keys(df, *keys).agg(F.count(F.lit(1))))


def check_key(df: DataFrame, target: str, key: str) -> DataFrame:
    """unique and not_null of one key from one grouping."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    totals = counted.agg(
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("unique"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("not_null"),
    )
    return _unpivot(totals, {"unique": target, "not_null": target})


def check_split(
    whole: tuple[str, DataFrame], parts: dict[str, DataFrame], key: str
) -> DataFrame:
    """Everything that must hold when the rows of `whole` are divided among `parts`, from one grouping
    by key: the key is unique and not null in each table, no key is in two parts, no row is lost."""
    name, frame = whole
    tables = {name: frame, **parts}
    rows = union_all(df.select(key, F.lit(i).alias("source")) for i, df in enumerate(tables.values()))
    sources = range(len(tables))
    counted = rows.groupBy(key).agg(*[F.count_if(F.col("source") == i).alias(f"n{i}") for i in sources])
    known = F.col(key).isNotNull()
    in_parts = sum((F.col(f"n{i}") > 0).cast("int") for i in sources[1:])
    per_table = [
        count
        for i in sources
        for count in (
            F.count_if(known & (F.col(f"n{i}") > 1)).alias(f"unique{i}"),
            F.coalesce(F.sum(F.when(~known, F.col(f"n{i}"))), F.lit(0)).alias(f"not_null{i}"),
        )
    ]
    lost = F.sum(F.col("n0") - sum(F.col(f"n{i}") for i in sources[1:]))
    totals = counted.agg(
        *per_table,
        F.count_if(known & (in_parts > 1)).alias("exclusive_split"),
        (F.coalesce(lost, F.lit(0)) != 0).cast("long").alias("reconciliation"),
    )
    targets = {f"{check}{i}": f"{t}.{key}" for i, t in enumerate(tables) for check in ("unique", "not_null")}
    return _unpivot(totals, {**targets, "exclusive_split": ", ".join(parts), "reconciliation": name})


def _unpivot(totals: DataFrame, targets: dict[str, str]) -> DataFrame:
    """One report row per total; a total is named after its check, with a number where it is one of several."""
    rows = [
        F.struct(
            F.lit(column.rstrip("0123456789")).alias("check"),
            F.lit(target).alias("target"),
            F.col(column).cast("long").alias("failing_rows"),
        )
        for column, target in targets.items()
    ]
    return totals.select(F.inline(F.array(*rows)))


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows; a null key is no reference.

    The child is counted per key first, so the join sees each key once however hot it is.
    """
    used = child.where(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(key).alias(foreign_key))
    return used.join(known, foreign_key, "left_anti")


def check_references(
    child: DataFrame, target: str, foreign_key: str, parent: DataFrame, key: str
) -> DataFrame:
    return report("relationships", target, orphans(child, foreign_key, parent, key).agg(F.sum("rows")))


def check_disjoint(left: DataFrame, right: DataFrame, key: str, target: str) -> DataFrame:
    """Keys present on both sides."""
    both = left.select(key).intersect(right.select(key))
    return report("exclusive_split", target, both.agg(F.count(F.lit(1))))


def check_parts_sum(whole: DataFrame, parts: list[DataFrame], target: str) -> DataFrame:
    """1 when the row counts of the parts do not add up to the whole, else 0."""
    counts = [whole.agg(F.count(F.lit(1)).alias("n"))]
    counts += [part.agg((-F.count(F.lit(1))).alias("n")) for part in parts]
    return report("reconciliation", target, union_all(counts).agg((F.sum("n") != 0).cast("long")))
