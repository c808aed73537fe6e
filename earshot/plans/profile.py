"""Profile of the raw log as it arrives: duplicates still in, listens that lack a user or a time too."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import listening as ls
from earshot.operators.rules import flag_rules
from earshot.plans import staging
from earshot.plans.star import Star


def _profiled(star: Star) -> DataFrame:
    raw = flag_rules(staging.raw_events(star.inputs.event_logs), staging.event_rules())
    events = star.look_up_episodes(raw)
    seconds, length = F.col("duration"), F.col("episode_duration_seconds")
    listen = (
        ls.is_listen(F.col("event_type")) & seconds.isNotNull() & F.col("episode_id").isNotNull()
    )
    return events.withColumns(
        {
            "listen": F.coalesce(listen, F.lit(False)),
            "overrun": F.coalesce(listen & (seconds > length), F.lit(False)),
            "rate": F.when(listen, ls.ratio(ls.capped(seconds, length), length)),
        }
    )


def raw_log_profile(star: Star) -> DataFrame:
    """Totals and shares over the raw log, in one scan without a shuffle of rows."""
    counted = _profiled(star).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if("is_rejected").alias("rejected"),
        F.count_if("listen").alias("listens"),
        F.count_if("overrun").alias("duration_overruns"),
        F.avg("rate").alias("avg_listen_through"),
    )
    return counted.select(
        "events",
        "rejected",
        ls.ratio(F.col("rejected"), F.col("events")).alias("rejected_share"),
        "listens",
        "duration_overruns",
        ls.ratio(F.col("duration_overruns"), F.col("listens")).alias("overrun_share"),
        "avg_listen_through",
    )


def raw_log_profile_by_bucket(star: Star) -> DataFrame:
    return (
        _profiled(star)
        .where(F.col("listen") & F.col("is_known_episode"))
        .groupBy("episode_length_bucket")
        .agg(F.avg("rate").alias("avg_listen_through"), F.count(F.lit(1)).alias("listens"))
        .orderBy(ls.bucket_rank(F.col("episode_length_bucket")).asc_nulls_last())
    )
