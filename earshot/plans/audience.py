"""Further questions about listeners and the catalogue, on the same star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import calendar as cal
from earshot.functions import listening as ls
from earshot.operators.ranking import running_sums, top
from earshot.plans.analyses import pooled_mean, rates_per_user
from earshot.plans.star import Star


def listen_definition_sensitivity(star: Star, episodes: int = 3) -> DataFrame:
    """Users with a busy day under three readings of "listened", from one pass.

    Distinct episodes become rows (user, day, episode) with a flag per reading, so each further step
    is a plain sum or maximum over fewer rows and no distinct count is needed.
    """
    kind = F.col("event_type")
    readings = {
        "any_event": F.lit(True),
        "play_or_complete": ls.is_listen(kind),
        "play_only": kind == "play",
    }
    per_episode = star.valid_copies.groupBy("user_id", "event_date", "episode_id").agg(
        *[F.max(hit.cast("int")).alias(name) for name, hit in readings.items()]
    )
    per_day = per_episode.groupBy("user_id", "event_date").agg(*[F.sum(n).alias(n) for n in readings])
    per_user = per_day.groupBy("user_id").agg(*[F.max(n).alias(n) for n in readings])
    counted = per_user.agg(*[F.count_if(F.col(n) >= episodes).alias(n) for n in readings])
    rows = [
        F.struct(F.lit(n).alias("definition"), F.col(n).alias(f"users_{episodes}plus_episodes_in_a_day"))
        for n in readings
    ]
    return counted.select(F.inline(F.array(*rows)))


def top_episodes_by_distinct_listeners(star: Star, n: int = 10) -> DataFrame:
    """Users who completed an episode, however often."""
    listeners = (
        star.valid_copies.where(F.col("event_type") == ls.COMPLETION)
        .groupBy("episode_id")
        .agg(F.count_distinct("user_id").alias("distinct_listeners"))
    )
    titled = star.dim_episodes.select("episode_id", "title").join(listeners, "episode_id")
    return top(titled, n, "distinct_listeners", "episode_id")


def ltr_weighted(star: Star) -> DataFrame:
    """By podcast: the mean of event rates beside seconds heard over seconds on offer."""
    heard = star.events.where(F.col("is_listen_event") & F.col("is_known_episode"))
    return heard.groupBy("podcast_id").agg(
        F.avg("listen_through_rate").alias("avg_listen_through_rate"),
        ls.ratio(F.sum("duration_capped_seconds"), F.sum("episode_duration_seconds")).alias(
            "weighted_listen_through_rate"
        ),
    )


def dim_podcasts(star: Star) -> DataFrame:
    return star.dim_episodes.groupBy("podcast_id").agg(
        F.count_distinct("episode_id").alias("episode_count"),
        F.min("release_date").alias("first_release_date"),
        F.max("release_date").alias("last_release_date"),
    )


def new_vs_returning_listeners(star: Star) -> DataFrame:
    """Per episode: listeners whose first day with any listen is their first day with this episode,
    and the others. Only (user, episode) pairs reach the join, never the events."""
    pairs = (
        star.valid_copies.where(ls.is_listen(F.col("event_type")))
        .groupBy("user_id", "episode_id")
        .agg(F.min("event_date").alias("first_heard"))
    )
    arrival = pairs.groupBy("user_id").agg(F.min("first_heard").alias("first_listen"))
    new = F.col("first_heard") == F.col("first_listen")
    return (
        pairs.join(arrival, "user_id")
        .groupBy("episode_id")
        .agg(F.count_if(new).alias("new_listeners"), F.count_if(~new).alias("returning_listeners"))
    )


def heavy_user_concentration(star: Star, percents: Sequence[int] = (1, 5, 10, 20, 50)) -> DataFrame:
    """Share of all listens made by the heaviest 1 %, 5 %, ... of listening users (rounded up).

    Users are first folded into a histogram: listens per user -> number of such users. Different
    counts that add up to N listens number at most sqrt(2 N), and they are summed in ranges
    (`running_sums`), where ranking the users would sort all of them in one place. Users with equal counts are
    interchangeable, which makes the cut inside a step exact.
    """
    per_user = (
        star.valid.where(ls.is_listen(F.col("event_type")))
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("listens"))
    )
    steps = per_user.groupBy("listens").agg(F.count(F.lit(1)).alias("users"))
    summed = running_sums(steps.withColumn("heard", F.col("listens") * F.col("users")), "listens", ["users", "heard"])
    running = summed.withColumnsRenamed({"heard_through": "listens_through", "all_heard": "all_listens"})
    wanted = running.withColumn(
        "top_percent", F.explode(F.array(*[F.lit(p).cast("long") for p in percents]))
    ).withColumn("heavy_users", F.expr("(top_percent * all_users + 99) div 100"))
    beyond = F.col("users_through") - F.col("heavy_users")
    reached = (beyond >= 0) & (beyond < F.col("users"))
    heavy = F.col("listens_through") - beyond * F.col("listens")
    return wanted.where(reached).select(
        "top_percent",
        "heavy_users",
        heavy.alias("heavy_listens"),
        ls.ratio(heavy, F.col("all_listens")).alias("share_of_listens"),
    )


def cohort_retention(star: Star) -> DataFrame:
    """Signup-month cohort x months since signup: users with a listen in that month."""
    signup = F.date_trunc("month", "signup_date").cast("date")
    users = star.dim_users.select(
        "user_id", signup.alias("signup_month"), cal.month_index(F.col("signup_date")).alias("signup_index")
    )
    active = (
        star.valid_copies.where(ls.is_listen(F.col("event_type")))
        .select("user_id", cal.month_index(F.col("event_date")).alias("active_index"))
        .distinct()
    )
    sizes = users.groupBy("signup_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    since = (F.col("active_index") - F.col("signup_index")).alias("months_since_signup")
    return (
        users.join(active, "user_id")
        .groupBy("signup_month", since)
        .agg(F.count(F.lit(1)).alias("active_users"))
        .join(sizes, "signup_month")
        .withColumn("retention_rate", ls.ratio(F.col("active_users"), F.col("cohort_size")))
    )


def ltr_by_region(star: Star, regions: DataFrame) -> DataFrame:
    """Mean rate by country, by region and overall; a null stands for "all of them".

    `regions` maps each country to its region. Rates are summed per user and then per country before
    the regions are joined, so the roll-up itself runs over as many rows as there are countries.
    """
    countries = (
        star.dim_users.select("user_id", "country")
        .join(rates_per_user(star.events), "user_id")
        .groupBy("country")
        .agg(F.sum("rates").alias("rates"), F.sum("rated").alias("rated"))
    )
    return (
        countries.join(regions, "country")
        .rollup("region", "country")
        .agg(F.sum("rated").alias("listen_events"), pooled_mean())
    )


def feature_impact(star: Star, exposed: Column) -> DataFrame:
    """Listen-through rate of exposed and control listens side by side. The split has to come from a
    flag recorded with the event or the user; a before-and-after comparison would mix in every other
    trend of the period."""
    group = F.when(exposed, "exposed").otherwise("control").alias("exposure_group")
    return (
        star.events.where("is_listen_event")
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("listen_events"),
            F.avg("listen_through_rate").alias("avg_listen_through_rate"),
            F.stddev_samp("listen_through_rate").alias("stddev_listen_through_rate"),
        )
    )


def listener_sketches(star: Star, nominal: int = 12) -> DataFrame:
    """(episode_id, event_date, listeners): a theta sketch of the users who played or completed an episode on a
    day. Sketches unite, so they are written once a day and answer for any window without the log.

    Up to 2^`nominal` users they are exact; beyond that the relative standard error is 1 / sqrt(2^nominal).
    """
    heard = star.valid_copies.where(ls.is_listen(F.col("event_type")))
    return heard.groupBy("episode_id", "event_date").agg(
        # A sketch passes over an empty text, which may be a user's id.
        F.theta_sketch_agg(F.concat(F.lit("="), F.col("user_id").cast("string")), F.lit(nominal)).alias("listeners")
    )


def listeners_in_windows(sketches: DataFrame, earlier: tuple[str, str], later: tuple[str, str]) -> DataFrame:
    """Per episode: distinct listeners of two windows of days (first and last), of both together, those of the
    later one who are new, and those who came back; from `listener_sketches` only."""

    def united(first: str, last: str):
        days = F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        return F.theta_union_agg(F.when(days, F.col("listeners")))

    both = sketches.groupBy("episode_id").agg(united(*earlier).alias("a"), united(*later).alias("b"))

    def count(sketch):
        return F.theta_sketch_estimate(sketch)

    return both.select(
        "episode_id",
        count("a").alias("earlier_listeners"),
        count("b").alias("later_listeners"),
        count(F.theta_union("a", "b")).alias("listeners"),
        count(F.theta_difference("b", "a")).alias("new_listeners"),
        count(F.theta_intersection("a", "b")).alias("returning_listeners"),
    )


#: Days that one mask of `activity_bits` stands for.
BITS = 64


def activity_bits(star: Star) -> DataFrame:
    """(user_id, block, days): a bit for each day on which a user listened, 64 days of the calendar to a row.
    Masks unite by `bit_or`, so they can be kept and added to."""
    day = F.unix_date("event_date")
    heard = star.valid_copies.where(ls.is_listen(F.col("event_type")))
    return heard.groupBy("user_id", F.floor(day / BITS).cast("int").alias("block")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(BITS)))).alias("days")
    )


def retention_by_days(bits: DataFrame, users: DataFrame, windows: Sequence[tuple[int, int]]) -> DataFrame:
    """Signup-month cohort x window (first and last day since signup): users of the cohort, and those who
    listened in the window, from `activity_bits`. The windows may overlap and be any."""
    since = F.unix_date("signup_date")
    opened = users.select("user_id", F.date_trunc("month", "signup_date").cast("date").alias("cohort"), since.alias("since"))
    masked = opened.join(bits, "user_id", "left")
    low = F.col("block") * BITS

    def listened(first: int, last: int):
        # The window's days within the block, as a mask; shifts by 64 would wrap around.
        start = F.greatest(F.col("since") + first - low, F.lit(0))
        stop = F.least(F.col("since") + last - low, F.lit(BITS - 1))
        ones = F.lit(-1).cast("long")
        mask = F.call_function("shiftleft", ones, start).bitwiseAND(
            F.call_function("shiftrightunsigned", ones, F.lit(BITS - 1) - stop)
        )
        inside = (start < BITS) & (stop >= 0) & (start <= stop)
        return F.coalesce(inside & (F.col("days").bitwiseAND(mask) != 0), F.lit(False))

    names = [f"{first}-{last}" for first, last in windows]
    per_user = masked.groupBy("cohort", "user_id").agg(
        *[F.max(listened(*w)).alias(name) for name, w in zip(names, windows)]
    )
    counted = per_user.groupBy("cohort").agg(
        F.count(F.lit(1)).alias("cohort_users"), *[F.count_if(F.col(f"`{name}`")).alias(name) for name in names]
    )
    entries = [F.struct(F.lit(n).alias("days_since_signup"), F.col(f"`{n}`").alias("active_users")) for n in names]
    return counted.select("cohort", "cohort_users", F.inline(F.array(*entries)))
