"""

Every query builds its tables from the parquet files of the folder it is given. Columns that say when
a row was computed are left out, and means are rounded, because the last digits of a double sum
depend on the order of the partitions.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from earshot import Inputs, Star  # noqa: E402
from earshot.plans import analyses, audience, history, monitoring, profile, quality, rulesets  # noqa: E402
from earshot.plans.staging import stage_events  # noqa: E402
from earshot.plans.star import REFRESHED, StoredStar  # noqa: E402
from earshot.session import shared_folder  # noqa: E402
from earshot.sources import retail  # noqa: E402
from earshot.sources.inputs import EVENT_LOG, read_csv, read_log, write_csv  # noqa: E402
from earshot.streaming.increment import load_increment, stream_increments  # noqa: E402
from oracle import ORACLE  # noqa: E402

SMOKE_FOLDER = "/root/testdata/sf0.001"


def _star(spark: SparkSession, folder: str) -> Star:
    return Star(retail.from_retail(spark, folder))


def _timeless(df: DataFrame) -> DataFrame:
    return df.drop(REFRESHED)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _on_star(build: Callable[[Star], DataFrame], *rounded: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _rounded(_timeless(build(_star(spark, folder))), *rounded)


def _check_report(spark: SparkSession, folder: str) -> DataFrame:
    """Build the tables once, then check what was written."""
    stored = _star(spark, folder).write(shared_folder(spark, "star"))
    return quality.check_report(stored)


def _recorded_report(spark: SparkSession, folder: str) -> DataFrame:
    """The checks on single rows as counted while the tables are written."""
    return quality.recorded_report(_star(spark, folder).write(shared_folder(spark, "star")))


def _csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """The log written as a fully quoted file, read back, and cleaned; ids are text there."""
    path = os.path.join(shared_folder(spark, "csv"), "event_logs.csv")
    write_csv(retail.from_retail(spark, folder).event_logs, path)
    return stage_events(read_csv(spark, path, EVENT_LOG))


def _damaged_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log as a file in which some durations are no numbers, staged with those lines kept."""
    path = os.path.join(shared_folder(spark, "damaged"), "event_logs.csv")
    inputs = retail.from_retail(spark, folder)
    seconds = F.when(F.col("duration") % 50 == 7, F.concat(F.lit("x"), "duration")).otherwise(F.col("duration").cast("string"))
    write_csv(inputs.event_logs.withColumn("duration", seconds), path)
    return stage_events(read_log(spark, path)).select(
        "event_id", "event_timestamp_raw", "is_rejected", "rejection_reason_count", "rejection_reason_summary"
    )


def _ltr_by_region(spark: SparkSession, folder: str) -> DataFrame:
    regions = retail.regions(retail.table(spark, folder, "nation"), retail.table(spark, folder, "region"))
    return audience.ltr_by_region(_star(spark, folder), regions)


SNAPSHOT_DAYS = ("2024-01-01", "2024-02-01", "2024-03-01")


def _user_snapshots(
    spark: SparkSession, folder: str, days: tuple[str, str, str] = SNAPSHOT_DAYS
) -> list[tuple[str, DataFrame]]:
    """Three states of the user table: later ones move some users to another country, lack some,
    and have some the first one lacked."""
    users = _star(spark, folder).stg_users
    key = F.col("user_id")

    def moved(remainder: int, to: str):
        return F.when(key % 10 == remainder, F.lit(to)).otherwise(F.col("country"))

    second = users.where(key % 50 != 7).withColumn("country", moved(3, "NATION_0"))
    third = second.withColumn("country", moved(4, "NATION_1"))
    return list(zip(days, (users.where(key % 40 != 9), second, third)))


def _dim_users_history(spark: SparkSession, folder: str, days: tuple[str, str, str] = SNAPSHOT_DAYS) -> DataFrame:
    (day, first), *later = _user_snapshots(spark, folder, days)
    versions = history.open_history(first, F.lit(day))
    for day, snapshot in later:
        versions = history.apply_snapshot(versions, snapshot, "user_id", ["country"], F.lit(day))
    return versions


def _ltr_by_country_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """With snapshots taken while the events happen: some users move, some are not known at first."""
    versions = _dim_users_history(spark, folder, ("2024-01-05", "2024-01-12", "2024-01-20"))
    return _rounded(analyses.ltr_by_country_as_of(_star(spark, folder), versions), RATE)


def _rejection_alarm(spark: SparkSession, folder: str) -> DataFrame:
    """The days from the middle of the month on, held against those before; every seventh episode is missing
    from the dimension, which is an error."""
    inputs = retail.from_retail(spark, folder)
    star = Star(Inputs(inputs.users, inputs.episodes.where(F.col("episode_id") % 7 != 3), inputs.event_logs))
    path = shared_folder(spark, "daily")
    monitoring.daily_rejections(star).write.parquet(path)
    daily = spark.read.parquet(path)
    early, middle = (
        monitoring.rejection_baseline(daily.where(F.col("event_date").between(*days)))
        for days in (("2024-01-01", "2024-01-09"), ("2024-01-10", "2024-01-17"))
    )
    later = daily.where(F.col("event_date") >= "2024-01-18")
    alarm = monitoring.rejection_alarm(later, monitoring.merge_baselines(early, middle), quality.check_relationships(star))
    return _rounded(alarm, "rejection_rate", "usual_rate", "change_score")


def _listeners_in_windows(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_folder(spark, "listeners")
    audience.listener_sketches(_star(spark, folder)).write.parquet(path)
    windows = ("2024-01-01", "2024-01-14"), ("2024-01-12", "2024-01-31")
    return audience.listeners_in_windows(spark.read.parquet(path), *windows)


RETENTION_WINDOWS = [(0, 59), (60, 119), (100, 140), (120, 239)]


def _retention_by_days(spark: SparkSession, folder: str) -> DataFrame:
    star, path = _star(spark, folder), shared_folder(spark, "bits")
    audience.activity_bits(star).write.parquet(path)
    return audience.retention_by_days(spark.read.parquet(path), star.dim_users, RETENTION_WINDOWS)


def _rechecked(spark: SparkSession, folder: str) -> DataFrame:
    """Events stored under the first rules, judged by the second ones, which have a rule more."""
    stored = _star(spark, folder).write(shared_folder(spark, "star"))
    return rulesets.recheck(stored.classified, rulesets.RULESETS["2"], "2")


def _recheck_events(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("is_rejected", "rejection_reason_count", "rejection_reason_summary", "rejection_ruleset_version")
    return _rechecked(spark, folder).select("event_id", "is_overlong_duration", *columns)


def _ruleset_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return rulesets.coverage(_rechecked(spark, folder), rulesets.RULESETS["2"])


def _mart_under_second_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The mart once events have moved between fact and quarantine."""
    stored = _star(spark, folder).write(shared_folder(spark, "star"))
    return _rounded(_timeless(rulesets.apply_ruleset(stored, "2").engagement), RATE)


def _loaded_twice(spark: SparkSession, folder: str) -> StoredStar:
    """A first load of the earlier events, when every seventh episode is not known yet, then a second
    one of everything, which repeats them."""
    inputs = retail.from_retail(spark, folder)
    earlier = inputs.event_logs.where(F.col("timestamp") < "2024-01-20")
    known = inputs.episodes.where(F.col("episode_id") % 7 != 3)
    target = shared_folder(spark, "increment")
    load_increment(Inputs(inputs.users, known, earlier), target)
    load_increment(inputs, target)
    return StoredStar(target, inputs)


def _on_loaded(build: Callable[[Star], DataFrame], *rounded: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _rounded(_timeless(build(_loaded_twice(spark, folder))), *rounded)


def _incremental_fact_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The log as a file stream, run to its end, then replayed from the start into the same tables."""
    inputs = retail.from_retail(spark, folder)
    target = shared_folder(spark, "stream")
    for run in ("first", "replay"):
        files = spark.readStream.schema(retail.SCHEMAS["events"]).parquet(os.path.join(folder, "events*.parquet"))
        checkpoint = os.path.join(target, f"_checkpoint_{run}")
        stream_increments(retail.event_logs(files), inputs, target, checkpoint).awaitTermination()
    return _timeless(StoredStar(target, inputs).fact)


RATE = "avg_listen_through_rate"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # Tables of the star schema.
    "stg_users": _on_star(lambda s: s.stg_users),
    "stg_episodes": _on_star(lambda s: s.stg_episodes),
    "stg_event_logs": _on_star(lambda s: s.staged),
    "dim_users": _on_star(lambda s: s.dim_users),
    "dim_episodes": _on_star(lambda s: s.dim_episodes),
    "fct_listening_events": _on_star(lambda s: s.fact),
    "rejected_event_logs": _on_star(lambda s: s.rejected),
    "int_user_daily_activity": _on_star(lambda s: s.daily_activity),
    "mart_user_engagement": _on_star(lambda s: s.engagement, RATE),
    # Analyses.
    "data_quality_summary": _on_star(analyses.data_quality_summary),
    "top_completed_episodes_7d": _on_star(lambda s: analyses.top_completed_episodes(s, days=7)),
    "top_completed_episodes_all": _on_star(analyses.top_completed_episodes),
    "podcast_completions_avg": _on_star(analyses.podcast_completions),
    "ltr_by_country": _on_star(analyses.ltr_by_country, RATE),
    "ltr_by_podcast": _on_star(analyses.ltr_by_podcast, RATE),
    "ltr_by_length_bucket": _on_star(analyses.ltr_by_length_bucket, RATE),
    "users_3plus_episodes_in_a_day": _on_star(analyses.users_with_busy_day),
    "single_vs_multi_podcast": _on_star(analyses.single_vs_multi_podcast),
    "top_podcast_share": _on_star(analyses.top_podcast_share),
    "top_podcast_per_user": _on_star(analyses.top_podcast_per_user),
    # Checks, one query per kind and one report with all of them.
    **{name: _on_star(check) for name, check in quality.CHECKS.items()},
    "check_report": _check_report,
    "recorded_report": _recorded_report,
    # Profile of the raw log.
    "raw_log_profile": _on_star(
        profile.raw_log_profile, "rejected_share", "overrun_share", "avg_listen_through"
    ),
    "raw_log_profile_by_bucket": _on_star(profile.raw_log_profile_by_bucket, "avg_listen_through"),
    # Files out and in again.
    "csv_round_trip": _csv_round_trip,
    "damaged_log": _damaged_log,
    # Further questions, and loading bit by bit.
    "incremental_fact": _on_loaded(lambda s: s.fact),
    "incremental_daily_activity": _on_loaded(lambda s: s.daily_activity),
    "incremental_mart": _on_loaded(lambda s: s.engagement, RATE),
    "check_derived_tables": _on_loaded(quality.check_derived_tables),
    "incremental_fact_stream": _incremental_fact_stream,
    "listen_definition_sensitivity": _on_star(audience.listen_definition_sensitivity),
    "top_episodes_by_distinct_listeners": _on_star(audience.top_episodes_by_distinct_listeners),
    "podcast_completions_min_episodes": _on_star(
        lambda s: analyses.podcast_completions(s, min_episodes=analyses.mean_catalogue(s))
    ),
    "ltr_weighted": _on_star(audience.ltr_weighted, RATE, "weighted_listen_through_rate"),
    "rejections_by_dimension": _on_star(monitoring.rejections_by_dimension, "rejection_rate"),
    "rejection_rate_drift": _on_star(
        monitoring.rejection_rate_drift, "rejection_rate", "baseline_rate"
    ),
    "rejection_alarm": _rejection_alarm,
    "ruleset_version": _on_star(monitoring.ruleset_version),
    "recheck_events": _recheck_events,
    "ruleset_coverage": _ruleset_coverage,
    "mart_under_second_rules": _mart_under_second_rules,
    "dim_podcasts": _on_star(audience.dim_podcasts),
    "new_vs_returning_listeners": _on_star(audience.new_vs_returning_listeners),
    "heavy_user_concentration": _on_star(audience.heavy_user_concentration, "share_of_listens"),
    "cohort_retention": _on_star(audience.cohort_retention, "retention_rate"),
    "retention_by_days": _retention_by_days,
    "listeners_in_windows": _listeners_in_windows,
    "dim_users_history": _dim_users_history,
    "ltr_by_country_as_of": _ltr_by_country_as_of,
    "ltr_by_region": lambda spark, folder: _rounded(_ltr_by_region(spark, folder), RATE),
    "feature_impact": _on_star(
        lambda s: audience.feature_impact(s, F.col("user_id") % 2 == 0),
        RATE,
        "stddev_listen_through_rate",
    ),
}

ORACLES: dict[str, str] = dict(ORACLE)

# The operators for training data and their pipeline are an optional part.
try:
    import corpus_pipeline
    from earshot.llm.queries import LLM_ORACLE, LLM_QUERIES
except ModuleNotFoundError as absent:
    if absent.name not in ("earshot.llm", "corpus_pipeline"):
        raise
else:
    QUERIES.update(LLM_QUERIES)
    ORACLES.update(LLM_ORACLE)
    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    """Mean listen-through rate by country: touches every layer of the engine."""
    return QUERIES["ltr_by_country"](spark, SMOKE_FOLDER)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
