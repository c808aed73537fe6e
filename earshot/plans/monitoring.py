"""Where rejections come from, and when their rate moves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions import listening as ls
from earshot.operators.lookup import lookup_join
from earshot.operators.rules import flag_columns
from earshot.plans import staging
from earshot.plans.star import Star

# The reasons a row can have and still belong to a day.
DATED_REASONS = tuple(r for r in staging.REASONS if not r.endswith("_timestamp"))


def rejections_by_dimension(star: Star) -> DataFrame:
    """Staged and rejected events by event type, day, episode and country of the user.

    Every staged row is counted under all four headings in one pass. Users are counted as such and
    turned into countries afterwards, when there is one row left per user.
    """
    headings = {
        "event_type": F.col("event_type"),
        "event_date": F.to_date("event_datetime").cast("string"),
        "episode": F.col("episode_id").cast("string"),
        "user": F.col("user_id").cast("string"),
    }
    entries = [F.struct(F.lit(n).alias("dimension"), c.alias("value")) for n, c in headings.items()]
    counted = (
        star.staged.select("is_rejected", F.inline(F.array(*entries)))
        .groupBy("dimension", "value")
        .agg(F.count(F.lit(1)).alias("staged"), F.count_if("is_rejected").alias("rejected"))
    )
    is_user = F.col("dimension") == "user"
    countries = star.dim_users.select(F.col("user_id").cast("string").alias("_user"), "country")
    placed = lookup_join(
        counted.withColumn("_user", F.when(is_user, F.col("value"))),
        countries,
        "_user",
        spread_on=["dimension", "value"],
        limit=star.broadcast_limit,
    )
    return (
        placed.groupBy(
            F.when(is_user, "country").otherwise(F.col("dimension")).alias("dimension"),
            F.when(is_user, F.col("country")).otherwise(F.col("value")).alias("value"),
        )
        .agg(F.sum("staged").alias("staged_events"), F.sum("rejected").alias("rejected_events"))
        .withColumn("rejection_rate", ls.ratio(F.col("rejected_events"), F.col("staged_events")))
    )


def daily_rejections(star: Star) -> DataFrame:
    """(event_date, staged_events, reason, rejected_events) of each day with staged events, a row per reason
    and one for any. Rows without a readable time belong to no day."""
    flags = dict(zip(staging.REASONS, flag_columns(dict.fromkeys(staging.REASONS))))
    counts = {"any": F.count_if("is_rejected"), **{r: F.count_if(flags[r]) for r in DATED_REASONS}}
    per_day = (
        star.staged.where(F.col("event_datetime").isNotNull())
        .groupBy(F.to_date("event_datetime").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("staged_events"), *[n.alias(r) for r, n in counts.items()])
    )
    entries = [F.struct(F.lit(r).alias("reason"), F.col(r).alias("rejected_events")) for r in counts]
    return per_day.select("event_date", "staged_events", F.inline(F.array(*entries)))


def rejection_rate_drift(star: Star, days: int = 7, warn_above: float = 1.5) -> DataFrame:
    """Daily rejection rate per reason against the `days` recorded days before it.

    `warn` means more than `warn_above` times the baseline. Rows without a readable time belong to no
    day. The windows run over days, one small partition per reason.
    """
    long = daily_rejections(star)
    before = Window.partitionBy("reason").orderBy("event_date").rowsBetween(-days, -1)
    rated = long.select(
        "event_date",
        "reason",
        "staged_events",
        "rejected_events",
        ls.ratio(F.col("rejected_events"), F.col("staged_events")).alias("rejection_rate"),
        ls.ratio(F.sum("rejected_events").over(before), F.sum("staged_events").over(before)).alias(
            "baseline_rate"
        ),
    )
    drifted = F.col("rejection_rate") > F.col("baseline_rate") * warn_above
    severity = F.when(F.col("baseline_rate").isNull(), "no_baseline").when(drifted, "warn").otherwise("ok")
    return rated.withColumn("severity", severity)


def rejection_baseline(daily: DataFrame, k: int = 200) -> DataFrame:
    """(reason, weekday, rates): quantile sketches of the daily rates, from rows of `daily_rejections`.

    Sketches merge, so a baseline of years is the union of what was stored for each month (`merge_baselines`);
    of up to `k` days they are exact, beyond that their ranks err by a little more than one in `k`.
    """
    rate = ls.ratio(F.col("rejected_events"), F.col("staged_events"))
    return daily.groupBy("reason", F.weekday("event_date").alias("weekday")).agg(
        F.kll_sketch_agg_double(rate, F.lit(k)).alias("rates")
    )


def merge_baselines(*baselines: DataFrame) -> DataFrame:
    """One baseline of several."""
    every = reduce(DataFrame.unionByName, baselines)
    return every.groupBy("reason", "weekday").agg(F.kll_merge_agg_double("rates").alias("rates"))


def rejection_alarm(daily: DataFrame, baseline: DataFrame, report: DataFrame, usual: float = 0.75, warn_above: float = 0.5) -> DataFrame:
    """Grades for the days in `daily` (rows of `daily_rejections`) and for the checks in `report`.

    A day's rate is held against the `usual` quantile that its weekday has in the baseline. What it is above
    that adds to a change score, what it is below takes from it, never under zero: a jump shows at once, a
    small rise when it lasts. `warn`: the score is above `warn_above` times the usual rate. `error`: a check on
    references or reconciliation, or any other of the report, has failing rows; such a row has no day. The
    score runs over days, one small partition per reason.
    """
    rate = ls.ratio(F.col("rejected_events"), F.col("staged_events"))
    rated = daily.withColumns({"rejection_rate": rate, "weekday": F.weekday("event_date")})
    levels = baseline.select(
        "reason", "weekday", F.kll_sketch_get_quantile_double("rates", F.lit(usual)).alias("usual_rate")
    )
    held = rated.join(levels, ["reason", "weekday"], "left")
    days = Window.partitionBy("reason").orderBy("event_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The score with its floor at zero is the sum so far less the lowest sum so far.
    summed = held.withColumn("_sum", F.sum(F.coalesce(F.col("rejection_rate") - F.col("usual_rate"), F.lit(0.0))).over(days))
    lowest = F.least(F.min("_sum").over(days), F.lit(0.0))
    scored = summed.withColumn("change_score", F.col("_sum") - lowest)
    grade = F.when(F.col("usual_rate").isNull(), "no_baseline").when(
        F.col("change_score") > F.col("usual_rate") * warn_above, "warn"
    )
    columns = ("event_date", "reason", "staged_events", "rejected_events", "rejection_rate", "usual_rate", "change_score")
    by_day = scored.select(*columns, grade.otherwise("ok").alias("severity"))
    checked = report.select(
        F.lit(None).cast("date").alias("event_date"),
        F.concat_ws(": ", "check", "target").alias("reason"),
        F.lit(None).cast("long").alias("staged_events"),
        F.col("failing_rows").alias("rejected_events"),
        *[F.lit(None).cast("double").alias(c) for c in columns[4:]],
        F.when(F.col("failing_rows") > 0, "error").otherwise("ok").alias("severity"),
    )
    return by_day.unionByName(checked)


class AlarmRaised(Exception):
    """Raised with the rows graded as errors."""


def stop_on_error(alarm: DataFrame) -> None:
    """Stop the job on an error; warnings let it go on."""
    failed = alarm.where("severity = 'error'").collect()
    if failed:
        raise AlarmRaised("; ".join(f"{r['reason']}: {r['rejected_events']}" for r in failed))


def ruleset_version(star: Star) -> DataFrame:
    """Staged events that say which set of rules they were checked against."""
    return star.versioned
