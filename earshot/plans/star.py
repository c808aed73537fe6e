"""The star schema: dimensions, fact, quarantine, daily activity and the user mart."""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions import calendar as cal
from earshot.functions import listening as ls
from earshot.operators import checks
from earshot.operators.lookup import BROADCAST_LIMIT, lookup_join
from earshot.operators.rules import flag_columns, split_quarantine
from earshot.operators.versions import State, publish, read_state
from earshot.plans import rollup, staging
from earshot.sources.inputs import Inputs

# The published tables and their columns, in order.
EVENTS = "events"
FACT = "fct_listening_events"
QUARANTINE = "rejected_event_logs"
DAILY = "int_user_daily_activity"
MART = "mart_user_engagement"
REFRESHED = "data_refreshed_on"
RULESET = "rejection_ruleset_version"
# What only the engine reads: the days on which an episode has events, and the copies of a staged event.
EPISODE_DAYS = "episode_days"
COPIES = "_copies"
FACT_COLUMNS = [
    "event_id",
    "user_id",
    "episode_id",
    "event_type",
    "event_datetime",
    "event_date",
    "event_year",
    "event_month",
    "event_hour_of_day",
    "event_day_of_week",
    "duration_raw_seconds",
    "duration_capped_seconds",
    "duration_exceeds_episode_length",
    "is_listen_event",
    "is_before_episode_release",
    "episode_duration_seconds",
    REFRESHED,
    "listen_through_rate",
]
REJECTED_COLUMNS = [
    "event_id",
    "event_type",
    "user_id",
    "episode_id",
    "event_timestamp_raw",
    "duration",
    *flag_columns(dict.fromkeys(staging.REASONS)),
    "rejection_reason_count",
    "rejection_reason_summary",
]
# Carried beside the fact, so that no analysis looks the episode up a second time.
EPISODE_COLUMNS = ["podcast_id", "episode_length_bucket", "is_known_episode"]
# The one written table of events, valid and rejected, holds each of these once.
DERIVED_COLUMNS = [c for c in FACT_COLUMNS if c not in (*REJECTED_COLUMNS, "duration_raw_seconds")]
EVENT_COLUMNS = [*REJECTED_COLUMNS, "is_rejected", RULESET, *DERIVED_COLUMNS, *EPISODE_COLUMNS]
# What an event says by itself; `measure` works the other columns out with its episode.
OWN_COLUMNS = [*REJECTED_COLUMNS, "is_rejected", RULESET, "event_datetime"]


def dim_users(staged_users: DataFrame) -> DataFrame:
    return staged_users.select(
        "user_id",
        "signup_date",
        "country",
        cal.year_of(F.col("signup_date")).alias("signup_year"),
        cal.month_of(F.col("signup_date")).alias("signup_month"),
        F.current_timestamp().alias(REFRESHED),
    )


def dim_episodes(staged_episodes: DataFrame) -> DataFrame:
    seconds = F.col("duration_seconds")
    return staged_episodes.select(
        "episode_id",
        "podcast_id",
        "title",
        "release_date",
        "duration_seconds",
        F.round(seconds.cast("double") / 60, 1).alias("duration_minutes"),
        cal.year_of(F.col("release_date")).alias("release_year"),
        cal.month_of(F.col("release_date")).alias("release_month"),
        ls.length_bucket(seconds).alias("episode_length_bucket"),
        F.current_timestamp().alias(REFRESHED),
    )


def episode_attributes(episodes: DataFrame) -> DataFrame:
    """What the metrics need of an episode, under names that do not clash with the event's."""
    return episodes.select(
        "episode_id",
        "podcast_id",
        "episode_length_bucket",
        F.col("release_date").alias("episode_release_date"),
        F.col("duration_seconds").alias("episode_duration_seconds"),
        F.lit(True).alias("is_known_episode"),
    )


def measure(events: DataFrame) -> DataFrame:
    """Derived columns of events that carry their episode's attributes; an unknown one left nulls."""
    raw, length = F.col("duration"), F.col("episode_duration_seconds")
    moment, day = F.col("event_datetime"), F.to_date("event_datetime")
    released = F.col("episode_release_date")
    listen = ls.is_listen(F.col("event_type"))
    return events.withColumns(
        {
            "event_date": day,
            "event_year": cal.year_of(moment),
            "event_month": cal.month_of(moment),
            "event_hour_of_day": cal.hour_of(moment),
            "event_day_of_week": cal.day_name(moment),
            "duration_capped_seconds": ls.capped(raw, length),
            "duration_exceeds_episode_length": raw.isNotNull() & (raw > length),
            "is_listen_event": listen,
            "is_before_episode_release": released.isNotNull() & day.isNotNull() & (day < released),
            "is_known_episode": F.coalesce("is_known_episode", F.lit(False)),
            "listen_through_rate": F.when(listen, ls.ratio(ls.capped(raw, length), length)),
            REFRESHED: F.current_timestamp(),
        }
    )


def fact_rows(events: DataFrame) -> DataFrame:
    """The valid ones of measured events, with the fact's columns and those of the episode."""
    valid = split_quarantine(events)[0].withColumn("duration_raw_seconds", F.col("duration"))
    return valid.select(*FACT_COLUMNS, *EPISODE_COLUMNS)


def user_daily_activity(valid: DataFrame) -> DataFrame:
    """One row per user and day with a listen; nothing of the episode is needed but its id. The
    distinct count shuffles on user, day and episode first, so a heavy user is spread over tasks."""
    return (
        valid.where(ls.is_listen(F.col("event_type")))
        .groupBy("user_id", "event_date")
        .agg(
            F.count_distinct("episode_id").alias("distinct_episodes"),
            F.count(F.lit(1)).alias("total_listen_events"),
        )
        .withColumn(REFRESHED, F.current_timestamp())
    )


def user_engagement(events: DataFrame, users: DataFrame) -> DataFrame:
    """One row per user of the dimension, with nulls where nothing valid was recorded.

    Spark works the three distinct counts out by shuffling on user and counted value, after merging
    what it can in the map tasks, so a heavy user is spread over many tasks. (Summing per user,
    episode and day beforehand costs a further shuffle and was slower by half.)
    """
    listen, day = F.col("is_listen_event"), F.col("event_date")

    def distinct_heard(column: str) -> Column:
        return F.nullif(F.count_distinct(F.when(listen, F.col(column))), F.lit(0))

    activity = events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_valid_events"),
        F.count_if(listen).alias("total_listen_events"),
        distinct_heard("episode_id").alias("distinct_episodes_listened"),
        distinct_heard("podcast_id").alias("distinct_podcasts_listened"),
        F.sum(F.when(listen, F.col("duration_capped_seconds"))).alias("total_capped_listen_seconds"),
        F.avg("listen_through_rate").alias("avg_listen_through_rate"),
        F.min(day).alias("first_event_date"),
        F.min(F.when(listen, day)).alias("first_listen_date"),
        F.max(day).alias("last_event_date"),
        F.count_distinct(day).alias("distinct_days_active"),
    )
    return users.select("user_id", "country", "signup_date").join(activity, "user_id", "left").withColumns(
        {
            "days_to_first_listen": cal.days_between(F.col("signup_date"), F.col("first_listen_date")),
            REFRESHED: F.current_timestamp(),
        }
    )


class Star:
    """All tables of the engine as lazy frames over three inputs; each is planned on first use."""

    def __init__(self, inputs: Inputs, broadcast_limit: int = BROADCAST_LIMIT):
        self.inputs = inputs
        self.broadcast_limit = broadcast_limit

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stage_users(self.inputs.users)

    @cached_property
    def stg_episodes(self) -> DataFrame:
        return staging.stage_episodes(self.inputs.episodes)

    @cached_property
    def cleaned_log(self) -> DataFrame:
        """The raw log cleaned: one row per distinct event, saying which rules it was checked against."""
        return staging.stage_events(self.inputs.event_logs, version=staging.RULESET_VERSION)

    @property
    def versioned(self) -> DataFrame:
        """The staged events with the version of their rules."""
        return self.cleaned_log

    @cached_property
    def staged(self) -> DataFrame:
        return self.versioned.drop(RULESET)

    def accounted(self) -> tuple[DataFrame, Column]:
        """All staged events, measured, and an aggregate over them that counts the raw rows."""
        staged = staging.stage_events(self.inputs.event_logs, copies=COPIES)
        return measure(self.look_up_episodes(staged)), F.sum(COPIES)

    @cached_property
    def flagged_log(self) -> DataFrame:
        """Every raw event, copies included, with key and flags; nothing is shuffled for it."""
        return staging.flag_events(staging.raw_events(self.inputs.event_logs))

    @cached_property
    def valid(self) -> DataFrame:
        """Valid staged events with their day, before any lookup."""
        return split_quarantine(self.staged)[0].withColumn("event_date", F.to_date("event_datetime"))

    @cached_property
    def valid_copies(self) -> DataFrame:
        """`valid` with the copies left in. What is counted distinct, or is a first or last of
        something, comes out the same, and the shuffle of the whole log is saved."""
        return split_quarantine(self.flagged_log)[0].withColumn("event_date", F.to_date("event_datetime"))

    @cached_property
    def quarantine(self) -> DataFrame:
        """Rejected events; nothing has to be looked up for them."""
        return split_quarantine(self.staged)[1]

    @property
    def rejected(self) -> DataFrame:
        return self.quarantine.select(*REJECTED_COLUMNS)

    @cached_property
    def dim_users(self) -> DataFrame:
        return dim_users(self.stg_users)

    @cached_property
    def dim_episodes(self) -> DataFrame:
        return dim_episodes(self.stg_episodes)

    @cached_property
    def classified(self) -> DataFrame:
        """All staged events, valid and rejected, with everything known about them."""
        return measure(self.look_up_episodes(self.versioned)).select(*EVENT_COLUMNS)

    @cached_property
    def counted(self) -> DataFrame:
        """`classified` with the number of raw rows that each event merges."""
        staged = staging.stage_events(self.inputs.event_logs, copies=COPIES, version=staging.RULESET_VERSION)
        return measure(self.look_up_episodes(staged)).select(*EVENT_COLUMNS, COPIES)

    @cached_property
    def event_schema(self) -> T.StructType:
        """Schema of `classified`, without planning the lookup."""
        attributes = episode_attributes(dim_episodes(self.stg_episodes))
        joined = self.cleaned_log.join(attributes, "episode_id", "left")
        return measure(joined).select(*EVENT_COLUMNS).schema

    @cached_property
    def events(self) -> DataFrame:
        """The fact plus the episode columns the analyses group by. The validity filter moves below
        the lookup and the duplicate removal."""
        return fact_rows(self.classified)

    @property
    def fact(self) -> DataFrame:
        return self.events.select(*FACT_COLUMNS)

    @cached_property
    def daily_activity(self) -> DataFrame:
        return user_daily_activity(self.valid)

    @cached_property
    def daily_variety(self) -> DataFrame:
        """Of the daily activity only the distinct episodes, which copies do not change."""
        return user_daily_activity(self.valid_copies).drop("total_listen_events")

    @cached_property
    def engagement(self) -> DataFrame:
        return user_engagement(self.events, self.dim_users)

    @cached_property
    def last_event_date(self) -> DataFrame:
        """One row: the day of the last valid event."""
        return self.valid_copies.agg(F.max("event_date").alias("event_date"))

    def look_up_episodes(self, events: DataFrame, profile: DataFrame | None = None) -> DataFrame:
        """Hot episodes are told from `profile`, by default the raw log: one column of it, counted
        without cleaning."""
        return lookup_join(
            events,
            episode_attributes(self.dim_episodes),
            "episode_id",
            spread_on=["user_id", "event_timestamp_raw"],
            profile=self.inputs.event_logs if profile is None else profile,
            limit=self.broadcast_limit,
        )

    def models(self) -> dict[str, DataFrame]:
        """Published name -> frame."""
        return {
            "stg_users": self.stg_users,
            "stg_episodes": self.stg_episodes,
            "stg_event_logs": self.staged,
            "dim_users": self.dim_users,
            "dim_episodes": self.dim_episodes,
            FACT: self.fact,
            QUARANTINE: self.rejected,
            DAILY: self.daily_activity,
            MART: self.engagement,
        }

    def create_views(self) -> None:
        """Register every table as a temporary view, for `spark.sql`."""
        for name, frame in self.models().items():
            frame.createOrReplaceTempView(name)

    def write(self, folder: str) -> "StoredStar":
        """Write the tables once, into a new folder, and return the star that reads them. The log is
        read and cleaned once for the fact and the quarantine together, then dealt out by day."""
        spark = self.inputs.users.sparkSession
        if read_state(spark, folder) is not None:
            raise ValueError(f"{folder} holds a star already; load_increment adds to it")
        raw = self.inputs.event_logs.agg(F.count(F.lit(1))).first()[0]
        state = write_load(self, self.counted, folder, None, {"raw": raw})
        return write_derived(StoredStar(folder, self.inputs, self.broadcast_limit, state), 1)


#: What is counted of a dimension while it is written.
DIMENSION_TOTALS = {
    "dim_users": {"users_without_id": "user_id IS NULL"},
    "dim_episodes": {
        "episodes_without_id": "episode_id IS NULL",
        "episodes_unknown_bucket": "episode_length_bucket NOT IN ({})".format(", ".join(f"'{b}'" for b in ls.LENGTH_BUCKETS)),
    },
}


def write_totals() -> dict[str, Column]:
    """What is counted of the events while they are written; `quality.recorded_report` reads it."""
    rejected, valid = F.col("is_rejected"), ~F.col("is_rejected")
    listen, capped = F.col("is_listen_event"), F.col("duration_capped_seconds")
    return {
        "fact": F.count_if(valid),
        "quarantine": F.count_if(rejected),
        "fact_without_id": F.count_if(valid & F.col("event_id").isNull()),
        "quarantine_without_id": F.count_if(rejected & F.col("event_id").isNull()),
        "fact_unknown_type": F.count_if(valid & checks.is_not_among("event_type", ls.EVENT_TYPES)),
        "fact_capped_null_rule": F.count_if(valid & (listen == capped.isNull())),
        "quarantine_without_reason": F.count_if(rejected & (F.col("rejection_reason_count") == 0)),
    }


def write_events(events: DataFrame, folder: str, load: int) -> dict[str, int]:
    """One table, partitioned by load, validity and day: the fact and the quarantine are read from their own
    folders of it, and both change in one step. The rebalance hint lets Spark split a day that holds a
    large share of the rows and merge small ones, so no task writes a whole hot day.

    Returns `write_totals`, and the raw rows merged, observed where the rows are written: behind the last
    shuffle, where a task that is run again counts once.
    """
    partitions = ["is_rejected", "event_date"]
    seen = Observation()
    totals = {**write_totals(), "copies": F.sum(COPIES)}
    dealt = events.hint("rebalance", *partitions).observe(seen, *[c.alias(name) for name, c in totals.items()])
    # A load that died may have left rows of its own behind: its whole place is written over.
    target = os.path.join(folder, EVENTS, f"load={load}")
    dealt.drop(COPIES).write.partitionBy(*partitions).mode("overwrite").parquet(target)
    return {name: seen.get.get(name) or 0 for name in totals}


def write_load(
    star: "Star",
    events: DataFrame,
    folder: str,
    before: State | None,
    totals: dict[str, int],
    days: list[str] = (),
) -> State:
    """Write `events` (with their copies) and what follows from them as the next load, and return the state that
    shows it, which is not published yet. On `days` only this load's rows count. Work is in proportion to
    `events`: nothing older is read. `totals` are added to those of the state and of the events."""
    load = before.version + 1 if before else 1
    counted = write_events(events, folder, load)
    spark = star.inputs.users.sparkSession
    written = spark.read.schema(star.event_schema).parquet(os.path.join(folder, EVENTS, f"load={load}"))
    by_day = rollup.roll_up(fact_rows(written)).hint("rebalance", "event_date")
    by_day.write.partitionBy("event_date").mode("overwrite").parquet(os.path.join(folder, rollup.ROLLUP, f"load={load}"))
    found = written.where(F.col("episode_id").isNotNull()).select("episode_id", "event_date").distinct()
    found.write.mode("overwrite").parquet(os.path.join(folder, EPISODE_DAYS, f"load={load}"))
    tables = dict(before.tables) if before else {}
    known = StoredStar(folder, star.inputs, star.broadcast_limit, before) if before else None
    sums = dict(before.totals) if before else {}
    for name, conditions in DIMENSION_TOTALS.items():
        new = getattr(star, name)
        if known is None or not same_rows(getattr(known, name), new):
            seen = Observation()
            observed = new.observe(seen, *[F.count_if(F.expr(bad)).alias(total) for total, bad in conditions.items()])
            observed.write.mode("overwrite").parquet(os.path.join(folder, name, f"v{load}"))
            tables[name] = load
            sums |= {total: seen.get.get(total) or 0 for total in conditions}
    for name, value in [*counted.items(), *totals.items()]:
        sums[name] = sums.get(name, 0) + value
    since = {**(before.days if before else {}), **dict.fromkeys(days, load)}
    return State(load, before.first if before else 1, tables, since, sums)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two dimensions say the same, whenever they were computed."""
    columns = [c for c in a.columns if c != REFRESHED]
    both = a.select(*columns, F.lit(1).alias("_n")).union(b.select(*columns, F.lit(-1).alias("_n")))
    return both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n != 0").isEmpty()


def write_derived(stored: "StoredStar", version: int) -> "StoredStar":
    """Write daily activity and user mart from the roll-up that `stored` shows, and publish them with its
    state as `version`. Readers then need not merge the roll-up."""
    state, folder = stored.state, stored.folder
    for name, table in ((DAILY, stored.merged_daily), (MART, stored.merged_engagement)):
        table.write.mode("overwrite").parquet(os.path.join(folder, name, f"v{version}"))
    state = State(version, state.first, {**state.tables, DAILY: version, MART: version}, state.days, state.totals)
    publish(stored.spark, folder, state)
    return StoredStar(folder, stored.inputs, stored.broadcast_limit, state)


def rewrite(stored: "StoredStar", events: DataFrame) -> "StoredStar":
    """Write `events`, measured with the dimensions of `stored`, in place of all it shows, and publish them. Places
    of loads before `State.first` are not read any more once nobody reads an older state."""
    before = stored.state
    counted = events.withColumn(COPIES, F.lit(0).cast("long"))
    lost = {name: -before.totals.get(name, 0) for name in write_totals()}
    written = write_load(stored, counted, stored.folder, before, lost)
    state = State(written.version, written.version, written.tables, {}, written.totals)
    publish(stored.spark, stored.folder, state)
    return StoredStar(stored.folder, stored.inputs, stored.broadcast_limit, state)


class StoredStar(Star):
    """The same tables read from a folder written by `Star.write` or by loads; nothing is cleaned again, unless
    `cleaned_log` is asked for. The folder may hold more events than `inputs`, which then are the last batch.

    The star shows the state that the folder had when it was made, or the one given, also while a load
    adds to it. Daily activity and user mart are read where they were written for that state, and merged
    from the roll-up otherwise.
    """

    def __init__(self, folder: str, inputs: Inputs, broadcast_limit: int = BROADCAST_LIMIT, state: State | None = None):
        super().__init__(inputs, broadcast_limit)
        self.folder = folder
        self.spark = inputs.users.sparkSession
        self.state = state or read_state(self.spark, folder)
        if self.state is None:
            raise FileNotFoundError(f"{folder} holds no star")

    def _whole(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, name, f"v{self.state.tables[name]}"))

    def _grown(self, name: str, schema: T.StructType) -> DataFrame:
        """What this state shows of a table that grows by loads. The schema is given: a table without rows, or
        without any known day, does not tell it."""
        with_load = T.StructType([*schema.fields, T.StructField("load", T.IntegerType())])
        rows = self.spark.read.schema(with_load).parquet(os.path.join(self.folder, name))
        return rows.where(self.state.visible(F.col("load"), F.col("event_date"))).select(*schema.fieldNames())

    @cached_property
    def dim_users(self) -> DataFrame:
        return self._whole("dim_users")

    @cached_property
    def dim_episodes(self) -> DataFrame:
        return self._whole("dim_episodes")

    @cached_property
    def classified(self) -> DataFrame:
        return self._grown(EVENTS, self.event_schema).select(*EVENT_COLUMNS)

    @cached_property
    def rollup(self) -> DataFrame:
        return self._grown(rollup.ROLLUP, rollup.roll_up(self.events).schema)

    @cached_property
    def episode_days(self) -> DataFrame:
        schema = self.event_schema
        return self._grown(EPISODE_DAYS, T.StructType([schema["episode_id"], schema["event_date"]]))

    def rows_now(self) -> tuple[int, int]:
        """Rows of the fact and of the quarantine, as the files of this state say: no column is read."""
        counts = self._grown(EVENTS, self.event_schema).groupBy("is_rejected").agg(F.count(F.lit(1)).alias("n")).collect()
        by_side = {r["is_rejected"]: r["n"] for r in counts}
        return by_side.get(False, 0), by_side.get(True, 0)

    def is_written(self, name: str) -> bool:
        """Whether a derived table was written for this very state."""
        return self.state.tables.get(name) == self.state.version

    @property
    def versioned(self) -> DataFrame:
        return self.classified.select(*self.cleaned_log.columns)

    def accounted(self) -> tuple[DataFrame, Column]:
        """The raw rows are counted in `inputs`, without looking at them; for this the log has to be whole."""
        return self.classified, F.max(self.inputs.event_logs.agg(F.count(F.lit(1))).scalar())

    def stale_days(self) -> DataFrame:
        """Days (`_day`) with events that carry something of their episode which the dimension does
        not say: it arrived, changed or went after they were measured.

        Compared once per episode, day and value, so a hot episode meets the join as a few rows.
        """
        carried = ["podcast_id", "episode_duration_seconds", "is_known_episode"]
        groups = self.classified.where(F.col("episode_id").isNotNull())
        groups = groups.select("episode_id", "event_date", *carried, "is_before_episode_release").distinct()
        now = F.struct(*carried, "episode_release_date").alias("now")
        joined = groups.join(episode_attributes(self.dim_episodes).select("episode_id", now), "episode_id", "left")
        before = F.coalesce(F.col("event_date") < F.col("now.episode_release_date"), F.lit(False))
        differs = ~before.eqNullSafe(F.col("is_before_episode_release"))
        for column in carried:
            value = F.col(f"now.{column}")
            if column == "is_known_episode":
                value = F.coalesce(value, F.lit(False))
            differs |= ~value.eqNullSafe(F.col(column))
        return joined.where(differs).select(F.col("event_date").alias("_day")).distinct()

    @cached_property
    def quarantine(self) -> DataFrame:
        return split_quarantine(self.classified)[1]

    @cached_property
    def merged_daily(self) -> DataFrame:
        return rollup.daily_activity(self.rollup, REFRESHED)

    @cached_property
    def merged_engagement(self) -> DataFrame:
        return rollup.engagement(self.rollup, self.dim_users, REFRESHED)

    @cached_property
    def daily_activity(self) -> DataFrame:
        return self._whole(DAILY) if self.is_written(DAILY) else self.merged_daily

    @cached_property
    def engagement(self) -> DataFrame:
        return self._whole(MART) if self.is_written(MART) else self.merged_engagement

    @cached_property
    def daily_variety(self) -> DataFrame:
        return self.daily_activity

    @cached_property
    def valid(self) -> DataFrame:
        return self.events

    @cached_property
    def valid_copies(self) -> DataFrame:
        return self.events
