"""The mergeable roll-up behind daily activity and user mart: one row per user, episode and day and load.

Rows of one key are merged by adding counts and sums, so a load adds its own rows and reads none of the
others; a day that is measured again is taken back as a whole, because its older rows stop counting.
Distinct counts and first and last days follow from the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import calendar as cal

ROLLUP = "user_episode_day"


def roll_up(fact: DataFrame) -> DataFrame:
    """Rows of the fact, which carry their podcast, by user, episode and day."""
    listen = F.col("is_listen_event")
    return fact.groupBy("user_id", "episode_id", "podcast_id", "event_date").agg(
        F.count(F.lit(1)).alias("valid_events"),
        F.count_if(listen).alias("listen_events"),
        F.sum(F.when(listen, F.col("duration_capped_seconds"))).alias("capped_listen_seconds"),
        F.sum("listen_through_rate").alias("rate_sum"),
        F.count("listen_through_rate").alias("rate_count"),
    )


def merged(rollup: DataFrame) -> DataFrame:
    """One row per key; what `roll_up` gives for the events of all loads together."""
    sums = ("valid_events", "listen_events", "capped_listen_seconds", "rate_sum", "rate_count")
    keys = ("user_id", "episode_id", "podcast_id", "event_date")
    return rollup.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def daily_activity(rollup: DataFrame, refreshed: str) -> DataFrame:
    """One row per user and day with a listen, like `star.user_daily_activity` from the fact."""
    return (
        rollup.where("listen_events > 0")
        .groupBy("user_id", "event_date")
        .agg(
            F.count_distinct("episode_id").alias("distinct_episodes"),
            F.sum("listen_events").alias("total_listen_events"),
        )
        .withColumn(refreshed, F.current_timestamp())
    )


def engagement(rollup: DataFrame, users: DataFrame, refreshed: str) -> DataFrame:
    """One row per user of the dimension, like `star.user_engagement` from the fact."""
    heard, day = F.col("listen_events") > 0, F.col("event_date")

    def distinct_heard(column: str) -> Column:
        return F.nullif(F.count_distinct(F.when(heard, F.col(column))), F.lit(0))

    activity = rollup.groupBy("user_id").agg(
        F.sum("valid_events").alias("total_valid_events"),
        F.sum("listen_events").alias("total_listen_events"),
        distinct_heard("episode_id").alias("distinct_episodes_listened"),
        distinct_heard("podcast_id").alias("distinct_podcasts_listened"),
        F.sum("capped_listen_seconds").alias("total_capped_listen_seconds"),
        F.try_divide(F.sum("rate_sum"), F.sum("rate_count")).alias("avg_listen_through_rate"),
        F.min(day).alias("first_event_date"),
        F.min(F.when(heard, day)).alias("first_listen_date"),
        F.max(day).alias("last_event_date"),
        F.count_distinct(day).alias("distinct_days_active"),
    )
    return users.select("user_id", "country", "signup_date").join(activity, "user_id", "left").withColumns(
        {
            "days_to_first_listen": cal.days_between(F.col("signup_date"), F.col("first_listen_date")),
            refreshed: F.current_timestamp(),
        }
    )
