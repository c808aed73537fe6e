"""The ten analyses of the star schema, with their thresholds as parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import listening as ls
from earshot.operators.ranking import best_per_group, rank_by, top
from earshot.operators.rules import flag_columns
from earshot.plans import staging
from earshot.plans.history import in_force
from earshot.plans.star import Star


def metric_rows(one_row: DataFrame) -> DataFrame:
    """A row of numbers as (metric, value) rows, in column order."""
    rows = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in one_row.columns]
    return one_row.select(F.inline(F.array(*rows)))


def data_quality_summary(star: Star) -> DataFrame:
    """Every raw row accounted for, in one pass: duplicates are merged with a count of their copies,
    so the raw total is a sum over the staged rows and the log is read and shuffled once. A stored
    star reads its events."""
    events, raw = star.accounted()
    rejected = F.col("is_rejected")
    counts = {
        "total_raw_events": raw,
        "staged_events": F.count(F.lit(1)),
        "valid_events": F.count_if(~rejected),
        "rejected_events": F.count_if(rejected),
        **{
            reason: F.count_if(F.col(flag))
            for reason, flag in zip(staging.REASONS, flag_columns(dict.fromkeys(staging.REASONS)))
        },
        "valid_events_before_episode_release": F.count_if(~rejected & F.col("is_before_episode_release")),
    }
    totals = events.agg(*[F.coalesce(count, F.lit(0)).alias(name) for name, count in counts.items()])
    removed = (F.col("total_raw_events") - F.col("staged_events")).alias("duplicate_events_removed")
    return metric_rows(totals.select("total_raw_events", removed, *totals.columns[1:]))


def recent(star: Star, days: int) -> DataFrame:
    """Valid events of the last `days` days of the data, the last one included. The first day is a
    scalar known before the scan, so older events are dropped ahead of the duplicate removal."""
    first_day = star.last_event_date.select(F.date_sub("event_date", days - 1)).scalar()
    return star.valid.where(F.col("event_date") >= first_day)


def events_by_episode(events: DataFrame, event_type: str, count: Column, name: str) -> DataFrame:
    return events.where(F.col("event_type") == event_type).groupBy("episode_id").agg(count.alias(name))


def top_completed_episodes(star: Star, days: int | None = None, n: int = 10) -> DataFrame:
    """Most completion events; counted per episode before the titles are joined."""
    events = star.valid if days is None else recent(star, days)
    counted = events_by_episode(events, ls.COMPLETION, F.count(F.lit(1)), "completion_events")
    titled = star.dim_episodes.select("episode_id", "title").join(counted, "episode_id")
    return top(titled, n, "completion_events", "episode_id")


def mean_catalogue(star: Star) -> Column:
    """Episodes per podcast, on average: one number, known before the scan that uses it."""
    per_podcast = star.dim_episodes.groupBy("podcast_id").agg(F.count_distinct("episode_id").alias("n"))
    return per_podcast.agg(F.avg("n")).scalar()


def podcast_completions(star: Star, min_episodes: int | Column = 0) -> DataFrame:
    """Completions per podcast and per episode of its catalogue, completed or not, best mean first.

    `min_episodes` leaves out catalogues too small to be ranked by their mean.
    """
    counted = events_by_episode(star.valid, ls.COMPLETION, F.count(F.lit(1)), "completion_events")
    total = F.coalesce(F.sum("completion_events"), F.lit(0))
    episodes = F.count_distinct("episode_id")
    podcasts = (
        star.dim_episodes.select("podcast_id", "episode_id")
        .join(counted, "episode_id", "left")
        .groupBy("podcast_id")
        .agg(
            episodes.alias("episode_count"),
            total.alias("total_completions"),
            F.round(total.cast("double") / episodes, 2).alias("avg_completions_per_episode"),
        )
        .where(F.col("episode_count") >= min_episodes)
    )
    return rank_by(podcasts, "avg_completions_per_episode", "podcast_id")


def rates_per_user(events: DataFrame) -> DataFrame:
    """Sum and number of listen-through rates of each listening user."""
    return (
        events.where("is_listen_event")
        .groupBy("user_id")
        .agg(F.sum("listen_through_rate").alias("rates"), F.count("listen_through_rate").alias("rated"))
    )


def pooled_mean() -> Column:
    """The mean over events, from the sums per user."""
    return ls.ratio(F.sum("rates"), F.sum("rated")).alias("avg_listen_through_rate")


def ltr_by_country(star: Star) -> DataFrame:
    """Mean rate by country. Rates are summed per user first, so the join with the users, which grow
    with the platform, meets each of them once: neither side can have a hot key."""
    by_user = star.dim_users.select("user_id", "country").join(rates_per_user(star.events), "user_id")
    return by_user.groupBy("country").agg(pooled_mean()).orderBy(F.col("country").asc_nulls_last())


def _ltr_by_episode_column(star: Star, column: str) -> DataFrame:
    heard = star.events.where(F.col("is_listen_event") & F.col("is_known_episode"))
    return heard.groupBy(column).agg(F.avg("listen_through_rate").alias("avg_listen_through_rate"))


def ltr_by_country_as_of(star: Star, users_history: DataFrame) -> DataFrame:
    """Mean rate by the country that a user had on the day of the event, null where none was known yet.

    Rates are summed by user and day first, so a hot user meets the lookup as one row a day.
    """
    rate = F.col("listen_through_rate")
    per_day = (
        star.events.where(rate.isNotNull())
        .groupBy("user_id", "event_date")
        .agg(F.sum(rate).alias("rate_sum"), F.count(rate).alias("rates"))
    )
    placed = in_force(per_day, users_history, "user_id", "event_date", ["country"], ["event_date"], star.broadcast_limit)
    return (
        placed.groupBy("country")
        .agg(F.sum("rates").alias("listen_events"), (F.sum("rate_sum") / F.sum("rates")).alias("avg_listen_through_rate"))
        .orderBy(F.col("country").asc_nulls_last())
    )


def ltr_by_podcast(star: Star) -> DataFrame:
    return rank_by(_ltr_by_episode_column(star, "podcast_id"), "avg_listen_through_rate", "podcast_id")


def ltr_by_length_bucket(star: Star) -> DataFrame:
    return _ltr_by_episode_column(star, "episode_length_bucket").orderBy(
        ls.bucket_rank(F.col("episode_length_bucket")).asc_nulls_last()
    )


def users_with_busy_day(star: Star, episodes: int = 3) -> DataFrame:
    """Users who listened to at least that many different episodes on one day."""
    name = f"users_{episodes}plus_episodes_in_a_day"
    busy = star.daily_variety.where(F.col("distinct_episodes") >= episodes)
    return busy.agg(F.count_distinct("user_id").alias(name))


def single_vs_multi_podcast(star: Star) -> DataFrame:
    podcasts = F.col("distinct_podcasts_listened")
    kind = F.when(podcasts.isNull(), "no_listens").when(podcasts == 1, "single_podcast")
    users = (
        star.engagement.groupBy(kind.otherwise("multi_podcast").alias("listener_type"))
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.round(F.avg("distinct_episodes_listened"), 1).alias("avg_episodes_listened"),
        )
    )
    return rank_by(users, "user_count", "listener_type")


def listens_per_user_podcast(star: Star) -> DataFrame:
    heard = star.events.where(F.col("is_listen_event") & F.col("is_known_episode"))
    return heard.groupBy("user_id", "podcast_id").agg(F.count(F.lit(1)).alias("listens"))


def top_podcast_share(star: Star) -> DataFrame:
    """How much of a user's listening goes to their most heard podcast: mean, least and most.

    The share of the top podcast is the largest count over the sum of counts, whichever of several
    tied podcasts is called the top one, so two plain aggregates do it without ranking anything.
    """
    share = (
        listens_per_user_podcast(star)
        .groupBy("user_id")
        .agg(ls.ratio(F.max("listens"), F.sum("listens")).alias("share"))
    )
    return share.agg(
        F.round(F.avg("share"), 2).alias("avg_top_podcast_concentration"),
        F.round(F.min("share"), 2).alias("min_concentration"),
        F.round(F.max("share"), 2).alias("max_concentration"),
    )


def top_podcast_per_user(star: Star) -> DataFrame:
    """Each user's most heard podcast, its listens and all their listens; the first by id of a tie."""
    return best_per_group(listens_per_user_podcast(star), "user_id", "listens", "podcast_id")
