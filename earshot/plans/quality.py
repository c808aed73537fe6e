"""The data-quality checks of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions.listening import EVENT_TYPES, LENGTH_BUCKETS
from earshot.operators import checks as c
from earshot.plans.star import Star, StoredStar


def keyed_tables(star: Star) -> dict[str, tuple[DataFrame, str]]:
    """Table -> (frame, its key): each key has to be unique and present."""
    return {
        "stg_users": (star.stg_users, "user_id"),
        "stg_episodes": (star.stg_episodes, "episode_id"),
        "stg_event_logs": (star.staged, "event_id"),
        "dim_users": (star.dim_users, "user_id"),
        "dim_episodes": (star.dim_episodes, "episode_id"),
        "fct_listening_events": (star.events, "event_id"),
        "rejected_event_logs": (star.rejected, "event_id"),
        "mart_user_engagement": (star.engagement, "user_id"),
    }


def check_unique(star: Star) -> DataFrame:
    return c.union_all(
        c.check_unique(df, f"{table}.{key}", key) for table, (df, key) in keyed_tables(star).items()
    )


def check_not_null(star: Star) -> DataFrame:
    return c.union_all(
        c.check_rows(df, [("not_null", f"{table}.{key}", c.is_missing(key))])
        for table, (df, key) in keyed_tables(star).items()
    )


def check_accepted_values(star: Star) -> DataFrame:
    in_fact = c.check_rows(star.valid, [_known_event_type()])
    return in_fact.unionByName(c.check_rows(star.dim_episodes, [_known_bucket()]))


def _known_bucket():
    unknown = c.is_not_among("episode_length_bucket", LENGTH_BUCKETS)
    return "accepted_values", "dim_episodes.episode_length_bucket", unknown


def _known_event_type():
    return (
        "accepted_values",
        "fct_listening_events.event_type",
        c.is_not_among("event_type", EVENT_TYPES),
    )


def check_relationships(star: Star) -> DataFrame:
    """The ids of the fact are those of the valid events; no episode has to be looked up for them."""
    fact, events = "fct_listening_events", star.valid
    users = c.check_references(events, f"{fact}.user_id", "user_id", star.dim_users, "user_id")
    episodes = c.check_references(
        events, f"{fact}.episode_id", "episode_id", star.dim_episodes, "episode_id"
    )
    return users.unionByName(episodes)


def check_unique_combination(star: Star) -> DataFrame:
    target = "int_user_daily_activity(user_id, event_date)"
    return c.check_unique(star.daily_activity, target, "user_id", "event_date", check="unique_combination")


def _capped_null_rule():
    differs = F.col("is_listen_event") == F.col("duration_capped_seconds").isNull()
    return "capped_null_rule", "fct_listening_events", differs


def check_capped_le_length(star: Star) -> DataFrame:
    """Events longer than the dimension says their episode is now. Events are counted by episode and
    capped duration first, so a hot episode meets the join as a few rows."""
    capped = F.col("duration_capped_seconds")
    events = star.events.where(capped.isNotNull()).groupBy("episode_id", capped.alias("capped"))
    lengths = star.dim_episodes.select("episode_id", "duration_seconds")
    over = events.agg(F.count(F.lit(1)).alias("n")).join(lengths, "episode_id").where("capped > duration_seconds")
    return c.report("capped_le_length", "fct_listening_events", over.agg(F.sum("n")))


def check_capped_null_rule(star: Star) -> DataFrame:
    return c.check_rows(star.events, [_capped_null_rule()])


def check_exclusive_split(star: Star) -> DataFrame:
    return c.check_disjoint(
        star.events, star.rejected, "event_id", "fct_listening_events, rejected_event_logs"
    )


def check_rejected_has_reason(star: Star) -> DataFrame:
    return c.check_rows(star.rejected, [_has_reason()])


def _has_reason():
    return "rejected_has_reason", "rejected_event_logs", F.col("rejection_reason_count") == 0


def check_reconciliation(star: Star) -> DataFrame:
    return c.check_parts_sum(star.cleaned_log, [star.events, star.rejected], "stg_event_logs")


def check_derived_tables(star: Star) -> DataFrame:
    """Listens per day in the fact and in the daily activity, events per user in the fact and in the
    mart: rows that differ. Meant for a stored star, where a table may be older than the events."""
    listens = star.events.where("is_listen_event").groupBy("event_date").agg(F.count(F.lit(1)).alias("a"))
    daily = star.daily_activity.groupBy("event_date").agg(F.sum("total_listen_events").alias("b"))
    by_day = listens.withColumnRenamed("event_date", "_day").join(
        daily, F.col("_day").eqNullSafe(F.col("event_date")), "full"
    )
    events = star.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("a"))
    mart = star.engagement.select("user_id", F.col("total_valid_events").alias("b"))
    by_user = mart.join(events, "user_id", "left")
    return c.union_all(
        c.report("derived_table", target, joined.where("NOT a <=> b").agg(F.count(F.lit(1))))
        for target, joined in (("int_user_daily_activity", by_day), ("mart_user_engagement", by_user))
    )


CHECKS = {
    "check_unique": check_unique,
    "check_not_null": check_not_null,
    "check_accepted_values": check_accepted_values,
    "check_relationships": check_relationships,
    "check_unique_combination": check_unique_combination,
    "check_capped_le_length": check_capped_le_length,
    "check_capped_null_rule": check_capped_null_rule,
    "check_exclusive_split": check_exclusive_split,
    "check_rejected_has_reason": check_rejected_has_reason,
    "check_reconciliation": check_reconciliation,
}


class ChecksFailed(Exception):
    """Raised with the failing rows of the report."""


def check_report(star: Star) -> DataFrame:
    """All 26 checks, one row each, with those that look at the same rows worked out together.

    Meant for a written star (`Star.write`): there the fact and the quarantine are narrow scans of the
    columns in question, and only the staged events are cleaned again, from the raw log, so that a row
    lost on the way to the tables shows.
    """
    tables = keyed_tables(star)
    staged, parts = ("stg_event_logs", star.cleaned_log), ("fct_listening_events", "rejected_event_logs")
    split = c.check_split(staged, {name: tables[name][0] for name in parts}, "event_id")
    dimensions = [t for t in tables if t not in (staged[0], *parts)]
    keys = [c.check_key(tables[t][0], f"{t}.{tables[t][1]}", tables[t][1]) for t in dimensions]
    fact_rows = c.check_rows(star.events, [_known_event_type(), _capped_null_rule()])
    return c.union_all(
        [
            split,
            *keys,
            fact_rows,
            check_capped_le_length(star),
            c.check_rows(star.dim_episodes, [_known_bucket()]),
            check_relationships(star),
            check_unique_combination(star),
            check_rejected_has_reason(star),
        ]
    )


#: (check, target) -> the totals that count its failing rows; a table whose rows are those of another one,
#: with further columns, has that one's.
RECORDED = {
    ("not_null", "stg_users.user_id"): ["users_without_id"],
    ("not_null", "dim_users.user_id"): ["users_without_id"],
    ("not_null", "mart_user_engagement.user_id"): ["users_without_id"],
    ("not_null", "stg_episodes.episode_id"): ["episodes_without_id"],
    ("not_null", "dim_episodes.episode_id"): ["episodes_without_id"],
    ("not_null", "stg_event_logs.event_id"): ["fact_without_id", "quarantine_without_id"],
    ("not_null", "fct_listening_events.event_id"): ["fact_without_id"],
    ("not_null", "rejected_event_logs.event_id"): ["quarantine_without_id"],
    ("accepted_values", "fct_listening_events.event_type"): ["fact_unknown_type"],
    ("accepted_values", "dim_episodes.episode_length_bucket"): ["episodes_unknown_bucket"],
    ("capped_null_rule", "fct_listening_events"): ["fact_capped_null_rule"],
    ("rejected_has_reason", "rejected_event_logs"): ["quarantine_without_reason"],
}


def recorded_report(stored: StoredStar) -> DataFrame:
    """The 13 checks that look at rows one by one, from what was counted while the tables were written: nothing
    is cleaned or scanned again.

    Reconciliation fails if the rows that the files hold now, by their footers, are not those that were
    written, or if the raw rows of a first write are not all among the copies of its events. (What a
    later load may have lost is told by `increment.lost_events`.) Keys that repeat, references and
    lengths need the rows themselves: see `check_report`.
    """
    totals = stored.state.totals
    failing = {name: sum(totals[t] for t in parts) for name, parts in RECORDED.items()}
    lost = stored.rows_now() != (totals["fact"], totals["quarantine"])
    if stored.state.version == 1:
        lost |= totals.get("raw", totals["copies"]) != totals["copies"]
    failing["reconciliation", "stg_event_logs"] = int(lost)
    rows = [(check, target, n) for (check, target), n in failing.items()]
    return stored.spark.createDataFrame(rows, "check string, target string, failing_rows long")


def require_clean(report: DataFrame) -> None:
    """Stop the job when a check fails. The report has one row per check."""
    failed = report.where("failing_rows > 0").collect()
    if failed:
        raise ChecksFailed("; ".join(f"{r['check']} on {r['target']}: {r['failing_rows']}" for r in failed))
