"""Graded alarms, sketches and masks of listeners, and events judged by later rules."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from earshot import Star
from earshot.plans import audience, monitoring, rulesets
from earshot.plans.star import StoredStar
from earshot.session import shared_folder
from earshot.streaming.increment import load_increment
from tests.frames import ANN, LONG, SHORT, event, inputs, rows, star


def days(spark, rates):
    """`daily_rejections` of one reason: a day for each rate in hundredths, from Monday 1 January 2024."""
    first = dt.date(2024, 1, 1)
    return spark.createDataFrame(
        [(first + dt.timedelta(days=i), 100, "any", r) for i, r in enumerate(rates)],
        "event_date date, staged_events long, reason string, rejected_events long",
    )


def test_alarm_tells_a_jump_a_creep_and_noise(spark):
    usual = [4, 5, 3, 4, 4, 9, 9] * 4
    baseline = monitoring.rejection_baseline(days(spark, usual))
    two = monitoring.merge_baselines(
        monitoring.rejection_baseline(days(spark, usual).where("event_date < '2024-01-15'")),
        monitoring.rejection_baseline(days(spark, usual).where("event_date >= '2024-01-15'")),
    )
    none = spark.createDataFrame([], "check string, target string, failing_rows long")

    def grades(rates, held=baseline):
        later = days(spark, usual + rates).where("event_date >= '2024-01-29'")
        return [r["severity"] for r in monitoring.rejection_alarm(later, held, none).orderBy("event_date").collect()]

    assert grades([4, 5, 3, 4, 4, 9, 9]) == ["ok"] * 7
    assert grades([4, 6, 3, 4, 4, 10, 9]) == ["ok"] * 7
    assert grades([8, 5, 0, 0, 0, 0, 0]) == ["warn", "warn", *["ok"] * 5]
    # One hundredth too many a day is noise at first and a change when it lasts.
    assert grades([5, 6, 4, 5, 5, 10, 10]) == ["ok", "ok", "warn", "warn", "warn", "warn", "warn"]
    assert grades([8, 5, 3], two) == grades([8, 5, 3])
    assert grades([4] * 2, baseline.where("weekday > 0")) == ["no_baseline", "ok"]


def test_errors_stop_the_job_and_warnings_do_not(spark):
    rates = days(spark, [1] * 7 + [50])
    baseline = monitoring.rejection_baseline(rates.where("event_date < '2024-01-08'"))
    report = spark.createDataFrame([("relationships", "fact.user_id", 0)], "check string, target string, failing_rows long")
    fine = monitoring.rejection_alarm(rates.where("event_date >= '2024-01-08'"), baseline, report)
    assert rows(fine, "reason", "severity") == [("any", "warn"), ("relationships: fact.user_id", "ok")]
    monitoring.stop_on_error(fine)
    broken = monitoring.rejection_alarm(rates, baseline, report.withColumn("failing_rows", F.lit(3).cast("long")))
    with pytest.raises(monitoring.AlarmRaised, match="relationships: fact.user_id: 3"):
        monitoring.stop_on_error(broken)


def test_sketches_of_many_listeners_are_within_their_error(spark):
    n = 100_000
    log = spark.range(n).select(
        F.lit("play").alias("event_type"),
        F.col("id").cast("string").alias("user_id"),
        F.lit("e1").alias("episode_id"),
        F.format_string("2024-03-%02dT10:00:00", (F.col("id") % 20 + 1).cast("int")).alias("timestamp"),
        F.lit(10).cast("long").alias("duration"),
    )
    made = inputs(spark, [event()])
    sketches = audience.listener_sketches(Star(type(made)(made.users, made.episodes, log)))
    (found,) = audience.listeners_in_windows(sketches, ("2024-03-01", "2024-03-12"), ("2024-03-09", "2024-03-20")).collect()
    exact = (0.6 * n, 0.6 * n, n, 0.4 * n, 0.2 * n)
    # Four standard errors of the union; a difference or an intersection inherits the union's.
    assert all(abs(got - want) <= 4 * n / 64 for got, want in zip(found[1:], exact))


def test_sketches_of_few_listeners_are_exact(spark):
    s = star(spark, [event(at="2024-03-05"), event(user="bob", at="2024-03-05"), event(at="2024-03-07"), event("seek", "cy"), event(episode="e3")])
    found = audience.listeners_in_windows(audience.listener_sketches(s), ("2024-03-05", "2024-03-06"), ("2024-03-07", "2024-03-09"))
    assert rows(found, "*") == [("e1", 2, 1, 2, 0, 1), ("e3", 1, 0, 1, 0, 0)]


def test_masks_tell_the_same_as_the_days(spark):
    random.seed(4)
    signup = {f"u{i}": dt.date(2024, 1, 1) + dt.timedelta(days=random.randrange(90)) for i in range(30)}
    heard = {u: {d + dt.timedelta(days=random.randrange(-40, 260)) for _ in range(random.randrange(6))} for u, d in signup.items()}
    log = [event(user=u, at=str(day)) for u, listened in heard.items() for day in listened]
    s = star(spark, log, users=[(u, str(d), "DE") for u, d in signup.items()])
    windows = [(0, 0), (0, 63), (1, 64), (-30, -1), (63, 64), (0, 300), (10, 200), (64, 127)]
    want = []
    for cohort in {d.replace(day=1) for d in signup.values()}:
        own = [u for u, d in signup.items() if d.replace(day=1) == cohort]
        for a, b in windows:
            active = sum(any(a <= (day - signup[u]).days <= b for day in heard[u]) for u in own)
            want.append((cohort, len(own), f"{a}-{b}", active))
    assert rows(audience.retention_by_days(audience.activity_bits(s), s.dim_users, windows), "*") == sorted(want, key=repr)


LOG = [
    event(seconds=1700),
    event(seconds=1900),
    event(seconds=1900, user=None),
    event(seconds=9000, episode="nobody knows"),
    event("pause", seconds=9999),
    event(at="?"),
]


def test_a_later_rule_is_told_where_it_can_be(spark):
    stored = star(spark, LOG).write(shared_folder(spark, "star"))
    rules = rulesets.RULESETS["2"]
    judged = rulesets.recheck(stored.classified, rules, "2")
    found = rows(judged, "duration", "is_overlong_duration", "rejection_reason_summary", "rejection_ruleset_version")
    assert found == sorted(
        [
            (1700, False, "", "2"),
            (1900, True, "overlong_duration", "2"),
            (1900, True, "missing_user_id, overlong_duration", "2"),
            (9000, None, "", "1"),
            (9999, False, "", "2"),
            (300, False, "malformed_timestamp", "2"),
        ],
        key=repr,
    )
    # A column that was not kept: nothing can be told of any row.
    blind = rulesets.recheck(stored.classified.drop("episode_duration_seconds"), rules, "2")
    assert rows(blind.select("is_overlong_duration", "rejection_ruleset_version").distinct(), "*") == [(None, "1")]
    counts = {(r[0], r["reason"]): tuple(r)[2:] for r in rulesets.coverage(judged, rules).collect()}
    assert counts["2", "overlong_duration"] == (5, 2, 0) and counts["1", "overlong_duration"] == (1, 0, 1)
    assert counts["2", "malformed_timestamp"] == (5, 1, 0)
    # Under the rules they were stored with, nothing moves.
    same = rulesets.recheck(stored.classified, rulesets.RULESETS["1"], "1")
    assert rows(same, *stored.classified.columns) == rows(stored.classified, "*")


def test_events_move_when_a_rule_set_is_applied(spark):
    folder = shared_folder(spark, "star")
    made = inputs(spark, LOG, users=[ANN], episodes=[SHORT, LONG])
    before = Star(made).write(folder)
    after = rulesets.apply_ruleset(before, "2")
    assert (before.events.count(), before.quarantine.count()) == (4, 2)
    assert (after.events.count(), after.quarantine.count()) == (3, 3)
    assert rows(after.engagement, "user_id", "total_valid_events", "total_capped_listen_seconds") == [("ann", 3, 9600)]
    assert after.state.totals["fact"] == 3 and rows(StoredStar(folder, made).events, "event_id") == rows(after.events, "event_id")
    # Loading the same log again adds nothing, under whatever rules its events stand.
    load_increment(made, folder)
    assert rows(StoredStar(folder, made).classified, "*") == rows(after.classified, "*")


def test_damaged_lines_are_not_judged(spark):
    made = inputs(spark, [event()])
    line = spark.createDataFrame([(None, None, None, '"play","x', None, True)], "event_type string, user_id string, episode_id string, timestamp string, duration long, is_damaged_line boolean")
    log = made.event_logs.withColumn("is_damaged_line", F.lit(False)).union(line)
    stored = Star(type(made)(made.users, made.episodes, log)).write(shared_folder(spark, "star"))
    judged = rulesets.recheck(stored.classified, rulesets.RULESETS["2"], "2").where("is_rejected")
    assert rows(judged, "rejection_reason_count", "rejection_reason_summary", "is_missing_user_id") == [(1, "damaged_line", False)]
