"""Typed inputs, and the log cleaned: one row per distinct raw event, keyed, parsed and flagged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions.calendar import parse_timestamp
from earshot.functions.keys import surrogate_key
from earshot.functions.listening import is_listen
from earshot.operators.dedup import distinct_rows
from earshot.operators.rules import flag_columns, flag_rules
from earshot.sources.inputs import DAMAGED

# The raw columns in the order in which they enter the key, and the reasons in the
# order in which they are listed in a summary.
RAW_COLUMNS = ("event_type", "user_id", "episode_id", "event_timestamp_raw", "duration")
REASONS = (
    "missing_event_type",
    "missing_user_id",
    "missing_episode_id",
    "missing_timestamp",
    "malformed_timestamp",
    "missing_duration",
)
RULESET_VERSION = "1"
# The only reason of a line that could not be read; it has no flag of its own.
DAMAGED_LINE = "damaged_line"


def stage_users(users: DataFrame) -> DataFrame:
    return users.select("user_id", F.col("signup_date").cast("date"), "country")


def stage_episodes(episodes: DataFrame) -> DataFrame:
    return episodes.select(
        "episode_id", "podcast_id", "title", F.col("release_date").cast("date"), "duration_seconds"
    )


def raw_events(event_logs: DataFrame) -> DataFrame:
    marked = [DAMAGED] if DAMAGED in event_logs.columns else []
    return event_logs.withColumnRenamed("timestamp", "event_timestamp_raw").select(*RAW_COLUMNS, *marked)


def event_rules() -> dict[str, Column]:
    """Reason -> condition under which a raw event is unusable."""
    stamp = F.col("event_timestamp_raw")
    conditions = (
        F.col("event_type").isNull(),
        F.col("user_id").isNull(),
        F.col("episode_id").isNull(),
        stamp.isNull(),
        stamp.isNotNull() & parse_timestamp(stamp).isNull(),
        is_listen(F.col("event_type")) & F.col("duration").isNull(),
    )
    return dict(zip(REASONS, conditions, strict=True))


def flag_events(raw: DataFrame, version: str | None = None) -> DataFrame:
    """Key, parsed timestamp and validity flags; looks at each row alone, so it streams as well.

    A row that stands for a damaged line is rejected for that alone, and its key is that of the line.
    """
    key, rules, damaged = surrogate_key(*RAW_COLUMNS), event_rules(), F.lit(False)
    if DAMAGED in raw.columns:
        damaged = F.coalesce(DAMAGED, F.lit(False))
        key = F.when(damaged, surrogate_key(DAMAGED, "event_timestamp_raw")).otherwise(key)
        rules = {**{reason: ~damaged & rule for reason, rule in rules.items()}, DAMAGED_LINE: damaged}
    keyed = raw.select(
        key.alias("event_id"),
        *RAW_COLUMNS[:4],
        F.when(~damaged, parse_timestamp(F.col("event_timestamp_raw"))).alias("event_datetime"),
        *RAW_COLUMNS[4:],
        *[c for c in raw.columns if c not in RAW_COLUMNS],
    )
    # The mark has the name of the flag that its rule gives, and goes with it.
    return flag_rules(keyed, rules, version).drop(*flag_columns({DAMAGED_LINE: damaged}))


def stage_events(event_logs: DataFrame, copies: str | None = None, version: str | None = None) -> DataFrame:
    """The key is a function of exactly the raw columns, so equal rows merge before it is computed:
    the shuffle carries the five columns and nothing derived from them."""
    return flag_events(distinct_rows(raw_events(event_logs), copies), version)
