"""History of a dimension, audience questions and monitoring, on frames of a few rows."""

import datetime as dt

from pyspark.sql import functions as F

from earshot.operators.dedup import one_per_key
from earshot.operators.ranking import best_per_group, running_sums, top
from earshot.plans import audience, history, monitoring, profile
from tests.frames import event, plan_of, rows, star

D1, D2, D3 = (dt.date(2024, m, 1) for m in (1, 2, 3))


def test_history(spark):
    def snapshot(*users):
        return spark.createDataFrame(list(users), "user_id string, country string, note string")

    def apply(h, s, day):
        return history.apply_snapshot(h, s, "user_id", ["country"], F.lit(day))

    first = history.open_history(snapshot(("a", "DE", "x"), ("b", None, "x"), ("c", "IE", "x")), F.lit("2024-01-01"))
    second = snapshot(("a", "FR", "y"), ("b", None, "y"), ("d", "US", "y"))
    once = apply(first, second, "2024-02-01")
    expected = [
        ("a", "DE", "x", D1, D2, False),
        ("a", "FR", "y", D2, None, True),
        ("b", None, "x", D1, None, True),
        ("c", "IE", "x", D1, None, True),
        ("d", "US", "y", D2, None, True),
    ]
    assert rows(once, "*") == sorted(expected, key=repr)
    assert rows(apply(once, second, "2024-02-01"), "*") == rows(once, "*")
    back = apply(once, snapshot(("a", "DE", "z"), ("b", "PT", "z")), "2024-03-01")
    assert rows(back.where("user_id = 'a'"), "country", "valid_from", "valid_to") == sorted(
        [("DE", D1, D2), ("FR", D2, D3), ("DE", D3, None)], key=repr
    )
    assert back.where("is_current").count() == 4
    older = apply(back, snapshot(("a", "US", "o"), ("b", None, "o")), "2024-01-15")
    assert rows(older, "*") == rows(back, "*")


def test_listen_definitions(spark):
    def day(kind, n, user):
        return [event(kind=kind, user=user, episode=f"x{i}") for i in range(n)]

    s = star(spark, day("pause", 3, "ann") + day("complete", 2, "bob") + day("play", 1, "bob") + [event("play", "bob", "y")])
    assert rows(audience.listen_definition_sensitivity(s), "*") == [("any_event", 2), ("play_only", 0), ("play_or_complete", 1)]


def test_concentration_is_exact_inside_a_tie(spark):
    events = [event(user=f"u{u}", seconds=i + 1) for u, n in enumerate([5, 3, 3, 3, 1, 1]) for i in range(n)]
    found = audience.heavy_user_concentration(star(spark, events), percents=(1, 50, 100))
    assert rows(found, "top_percent", "heavy_users", "heavy_listens") == [(1, 1, 5), (100, 6, 16), (50, 3, 11)]


def test_new_and_returning(spark):
    events = [
        event(episode="e1", at="2024-03-05"),
        event(episode="e2", at="2024-03-05"),
        event(episode="e3", at="2024-03-06"),
        event(episode="e1", at="2024-03-07"),
        event(user="bob", episode="e3", at="2024-03-07"),
    ]
    found = audience.new_vs_returning_listeners(star(spark, events))
    assert rows(found, "episode_id", "new_listeners", "returning_listeners") == [("e1", 1, 0), ("e2", 1, 0), ("e3", 1, 1)]


def test_cohorts(spark):
    events = [event(at="2024-03-05"), event(at="2024-03-06"), event(user="cy", at="2024-04-01")]
    found = audience.cohort_retention(star(spark, events))
    assert rows(found, "months_since_signup", "active_users", "cohort_size", "retention_rate") == [
        (1, 1, 1, 1.0), (2, 1, 1, 1.0),
    ]


def test_region_rollup(spark):
    regions = spark.createDataFrame([("DE", "EU"), ("IE", "EU")], "country string, region string")
    events = [event(seconds=300), event(user="bob", seconds=600)]
    assert rows(audience.ltr_by_region(star(spark, events), regions), "region", "country", "listen_events", "avg_listen_through_rate") == sorted(
        [("EU", "DE", 1, 0.5), ("EU", "IE", 1, 1.0), ("EU", None, 2, 0.75), (None, None, 2, 0.75)], key=repr
    )


def test_the_version_in_force(spark):
    versions = spark.createDataFrame(
        [
            ("a", "DE", "2024-01-01", "2024-01-10"),
            ("a", "IE", "2024-01-10", None),
            ("b", None, "2024-01-05", "2024-01-07"),
            (None, "XX", "2024-01-01", None),
        ],
        "user_id string, country string, valid_from string, valid_to string",
    ).withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})
    days = ["2023-12-31", "2024-01-01", "2024-01-09", "2024-01-10", "2024-06-01", None]
    events = spark.createDataFrame([(u, d, i) for u in ("a", "b", "c", None) for i, d in enumerate(days)] * 2, "user_id string, day string, n int")
    events = events.withColumn("day", F.col("day").cast("date"))
    want = [None, "DE", "DE", "IE", "IE", None]
    # Broadcast, and shuffled with hot keys cut into pieces.
    for limit in (1 << 20, 0):
        found = history.in_force(events, versions, "user_id", "day", ["country"], ["n"], limit)
        assert found.columns == ["user_id", "day", "n", "country"] and found.count() == 48
        assert rows(found.where("user_id = 'a'"), "n", "country") == sorted(list(enumerate(want)) * 2, key=repr)
        assert found.where("user_id <> 'a' OR user_id IS NULL").where("country IS NOT NULL").isEmpty()


def test_drift(spark):
    def day(number, good, bad):
        at = f"2024-03-{number:02d}T00:00:00"
        return [event(at=at, seconds=i + 1) for i in range(good)] + [event(user=None, at=at, seconds=i + 1) for i in range(bad)]

    s = star(spark, day(1, 8, 2) + day(2, 8, 2) + day(3, 5, 5))
    found = monitoring.rejection_rate_drift(s).where("reason = 'missing_user_id'")
    assert rows(found, "event_date", "rejection_rate", "baseline_rate", "severity") == [
        (dt.date(2024, 3, 1), 0.2, None, "no_baseline"),
        (dt.date(2024, 3, 2), 0.2, 0.2, "ok"),
        (dt.date(2024, 3, 3), 0.5, 0.2, "warn"),
    ]


def test_profile_keeps_copies_and_listens_without_a_user(spark):
    s = star(spark, [event(), event(), event(user=None, seconds=900), event(at="malformed-date"), event(kind="seek")])
    (found,) = profile.raw_log_profile(s).collect()
    assert tuple(found) == (5, 2, 0.4, 4, 1, 0.25, 0.625)
    assert rows(profile.raw_log_profile_by_bucket(s), "*") == [("short", 0.625, 4)]


def test_best_per_group(spark):
    df = spark.createDataFrame(
        [("a", 2, "y"), ("a", 2, "x"), ("a", 1, "w"), ("b", 5, None), (None, 1, "z")], "g string, n long, k string"
    )
    assert rows(best_per_group(df, "g", "n", "k"), "g", "k", "n", "total_n") == sorted(
        [("a", "x", 2, 5), ("b", None, 5, 5), (None, "z", 1, 1)], key=repr
    )


def test_one_per_key_and_top(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("c", None)], "k string, n long")
    assert rows(one_per_key(df, "k"), "k") == [("a",), ("b",), ("c",)]
    assert [r["k"] for r in top(one_per_key(df, "k"), 3, "n", "k").collect()] == ["a", "b", "c"]


def test_running_sums_are_made_in_ranges(spark):
    values = [1, 2, 3, 4, 7, 8, 9, 1000, 1001, 10**9, 2**40, 2**40 + 1]
    df = spark.createDataFrame([(v, v % 5 + 1, i) for i, v in enumerate(values)], "along long, n long, m long")
    summed = running_sums(df, "along", ["n", "m"])
    want = [
        (v, sum(x % 5 + 1 for x in values if x >= v), sum(i for i, x in enumerate(values) if x >= v)) for v in values
    ]
    assert rows(summed, "along", "n_through", "m_through") == sorted(want, key=repr)
    assert rows(summed.select("all_n", "all_m").distinct(), "*") == [(sum(v % 5 + 1 for v in values), sum(range(len(values))))]
    assert running_sums(df.limit(0), "along", ["n"]).count() == 0
    assert "SinglePartition" not in plan_of(summed)


def test_concentration_has_no_task_for_all(spark):
    assert "SinglePartition" not in plan_of(audience.heavy_user_concentration(star(spark, [event()])))
