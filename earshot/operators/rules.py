"""Row-level validity rules: flags, a count, a readable summary, and the valid / rejected split."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag_columns(rules: Mapping[str, Column]) -> list[str]:
    return [f"is_{reason}" for reason in rules]


def flag_rules(df: DataFrame, rules: Mapping[str, Column], version: str | None = None) -> DataFrame:
    """Add one boolean `is_<reason>` per rule, then `is_rejected`, `rejection_reason_count` and
    `rejection_reason_summary`, all three read off the flags so that they cannot disagree with them.

    A rule that is unknown (null) for a row does not fire. Adding a rule is adding one entry. With
    `version`, every row also says which rule set it was checked against.
    """
    flags = flag_columns(rules)
    flagged = df.withColumns(
        {flag: F.coalesce(rule, F.lit(False)) for flag, rule in zip(flags, rules.values())}
    )
    fired = [F.col(flag) for flag in flags]
    labels = [F.when(flag, reason) for flag, reason in zip(fired, rules)]
    out = flagged.withColumns(
        {
            "is_rejected": reduce(or_, fired),
            "rejection_reason_count": sum((flag.cast("long") for flag in fired), F.lit(0).cast("long")),
            "rejection_reason_summary": F.concat_ws(", ", *labels),
        }
    )
    if version is not None:
        out = out.withColumn("rejection_ruleset_version", F.lit(version))
    return out


def split_quarantine(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): two filters on one frame, so no row is lost and none is in both."""
    return flagged.where(~F.col("is_rejected")), flagged.where("is_rejected")
