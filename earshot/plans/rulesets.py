"""Versions of the rules, and stored events judged again under a later one.

Whether a rule can be told for an event that was stored before the rule existed depends on what was kept
of the event. Where it cannot, its flag is null: "not checked" is not "checked and passed".
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import listening as ls
from earshot.operators.rules import flag_columns, flag_rules
from earshot.plans import staging
from earshot.plans.star import EVENT_COLUMNS, RULESET, StoredStar, rewrite


@dataclass(frozen=True)
class Rule:
    """A reason, the columns of a stored event that it looks at, and the condition under which the event is
    unusable: null where that cannot be told of a row."""

    reason: str
    needs: tuple[str, ...]
    fails: Callable[[], Column]


def _first_rules() -> tuple[Rule, ...]:
    def rule(reason: str) -> Rule:
        # As when the event was staged: an unknown condition does not fire.
        return Rule(reason, staging.RAW_COLUMNS, lambda: F.coalesce(staging.event_rules()[reason], F.lit(False)))

    return tuple(map(rule, staging.REASONS))


#: A listen longer than this many times its episode is taken for a fault of the player.
OVERLONG = 3


def _overlong() -> Column:
    """Cannot be told of a listen whose episode is not known."""
    measured = ls.is_listen(F.col("event_type")) & F.col("duration").isNotNull()
    return F.when(F.coalesce(measured, F.lit(False)), F.col("duration") > OVERLONG * F.col("episode_duration_seconds")).otherwise(
        F.lit(False)
    )


RULESETS: dict[str, tuple[Rule, ...]] = {
    "1": _first_rules(),
    "2": (*_first_rules(), Rule("overlong_duration", ("event_type", "duration", "episode_duration_seconds"), _overlong)),
}


def recheck(events: DataFrame, rules: tuple[Rule, ...], version: str) -> DataFrame:
    """`events` (columns of the stored events) judged under `rules`: a flag for each, null where the columns it
    needs were not kept or the row does not tell; is_rejected, count and summary follow from the flags that
    are true. A row of which every rule could be told says `version`, others what they said before.

    A line that could not be read was never an event and stays what it is.
    """
    known = set(events.columns)
    flags = {r.reason: r.fails() if set(r.needs) <= known else F.lit(None).cast("boolean") for r in rules}
    names = flag_columns(flags)
    # Taken from the row as it was stored, before its judgement is written over.
    unread = (F.col("rejection_reason_summary") == staging.DAMAGED_LINE).alias("_unread")
    told = events.select("*", unread, *[c.alias(f"_{name}") for name, c in zip(names, flags.values())])
    judged = flag_rules(told, {reason: F.col(f"_{name}") for reason, name in zip(flags, names)})
    every = reduce(and_, [F.col(f"_{name}").isNotNull() for name in names])
    unread = F.col("_unread")
    columns = {
        **{name: F.when(unread, F.lit(False)).otherwise(F.col(f"_{name}")) for name in names},
        "is_rejected": unread | F.col("is_rejected"),
        "rejection_reason_count": F.when(unread, F.lit(1).cast("long")).otherwise(F.col("rejection_reason_count")),
        "rejection_reason_summary": F.when(unread, staging.DAMAGED_LINE).otherwise(F.col("rejection_reason_summary")),
        RULESET: F.when(every, F.lit(version)).otherwise(F.col(RULESET)),
    }
    return judged.withColumns(columns).drop("_unread", *[f"_{name}" for name in names])


def coverage(judged: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(rejection_ruleset_version, reason, events, failed, not_checked) of events that `recheck` gave."""
    flags = flag_columns(dict.fromkeys(r.reason for r in rules))
    entries = [F.struct(F.lit(r.reason).alias("reason"), F.col(f).alias("flag")) for r, f in zip(rules, flags)]
    long = judged.select(RULESET, F.inline(F.array(*entries)))
    return long.groupBy(RULESET, "reason").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("flag").alias("failed"),
        F.count_if(F.col("flag").isNull()).alias("not_checked"),
    )


def apply_ruleset(stored: StoredStar, version: str) -> StoredStar:
    """Judge all stored events again, so that they move between fact and quarantine, and show them in one step.
    Daily activity and mart follow, as after any load."""
    rules = RULESETS[version]
    return rewrite(stored, recheck(stored.classified, rules, version).select(*EVENT_COLUMNS))
