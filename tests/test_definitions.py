"""Edges of the business definitions, on frames of a few rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from earshot.functions.calendar import day_name, days_between, parse_timestamp
from earshot.functions.keys import surrogate_key
from earshot.functions.listening import length_bucket
from earshot.operators.rules import flag_rules, split_quarantine
from earshot.plans import analyses
from tests.frames import ANN, BOB, LONG, MEDIUM, SHORT, event, rows, star

READABLE = {
    "2025-01-01T10:00:00": "2025-01-01 10:00:00",
    "2025-01-01 10:00:00": "2025-01-01 10:00:00",
    "2025-01-01": "2025-01-01 00:00:00",
    "2025-1-1": "2025-01-01 00:00:00",
    "2025/01/02 03:04:05": "2025-01-02 03:04:05",
    "2025-01-01T10:00": "2025-01-01 10:00:00",
    "2025-01-01T1:02:03": "2025-01-01 01:02:03",
    "2025-01-01T10:00:00.25": "2025-01-01 10:00:00.25",
    "2025-01-01T10:00:00.123456789": "2025-01-01 10:00:00.123456",
    "2025-01-01T10:00:00Z": "2025-01-01 10:00:00",
    "2025-01-01T10:00Z": "2025-01-01 10:00:00",
    "2025-01-01T10:00:00+02:00": "2025-01-01 10:00:00",
    "2025-01-01T10:00:00-0530": "2025-01-01 10:00:00",
    "2025-01-01 10:00:00 UTC": "2025-01-01 10:00:00",
    "2024-02-29": "2024-02-29 00:00:00",
}
UNREADABLE = [
    "malformed-date", "", "2025", "2025-01", "10:00", "now", "today", " 2025-01-01 ", "2025-01-01 ",
    "2025-02-30", "2025-02-29", "2025-13-01", "01/02/2025", "2025-01/01", "2025-01-01T10", "2025-01-01Z",
    "2025-01-01T25:00:00", "2025-01-01T10:00:60", "2025-01-01t10:00:00", "20250101", "2025-01-01T10:00:00+2",
    "2025-01-01T10:00:00UTC",
]


def test_timestamp_grammar(spark):
    texts = [*READABLE, *UNREADABLE]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    parsed = parse_timestamp(F.col("t")).cast("string")
    found = {r["t"]: r["p"] for r in df.select("t", parsed.alias("p")).collect()}
    assert found == {**READABLE, **dict.fromkeys(UNREADABLE)}


def test_timestamps_read_like_the_sql_engine(spark):
    """The same texts through a plain try_cast of the SQL engine."""
    import duckdb

    con = duckdb.connect()
    for text in [*READABLE, *UNREADABLE]:
        known = con.execute("SELECT CAST(TRY_CAST(? AS TIMESTAMP) AS VARCHAR)", [text]).fetchone()[0]
        assert known == READABLE.get(text), text


def test_null_in_key_is_a_value_of_its_own(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", None), (None, "a")], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    assert keys[0] == keys[3] and len(set(keys)) == 3


def test_different_rows_have_different_keys(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "n"), ("n", None), ("_null_", "x"), (None, "x"), ("1:a", ""), ("", "1:a")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(surrogate_key("x", "y")).distinct().count() == len(rows)


def test_length_buckets(spark):
    df = spark.createDataFrame([(s,) for s in (1199, 1200, 2699, 2700, None)], "s long")
    assert [r[0] for r in df.select(length_bucket(F.col("s"))).collect()] == [
        "short", "medium", "medium", "long", "long",
    ]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 4), dt.date(2024, 3, 1))], "a date, b date")
    assert tuple(df.select(day_name(F.col("a")), days_between(F.col("b"), F.col("a"))).first()) == ("Monday", 3)


def test_equal_raw_rows_are_one_event_and_unequal_ones_are_not(spark):
    s = star(spark, [event(), event(), event(user=None), event(user=None), event(user=""), event(seconds=301)])
    assert s.staged.count() == 4
    assert s.staged.select("event_id").distinct().count() == 4


def test_flags_count_and_summary(spark):
    s = star(
        spark,
        [
            event(kind=None, seconds=None),
            event(user=None, at="malformed-date"),
            event(episode=None, at=None, seconds=None),
            event(kind="pause"),
        ],
    )
    assert rows(s.staged, "rejection_reason_count", "rejection_reason_summary", "is_missing_duration", "is_rejected") == [
        (0, "", False, False),
        (1, "missing_event_type", False, True),
        (2, "missing_user_id, malformed_timestamp", False, True),
        (3, "missing_episode_id, missing_timestamp, missing_duration", True, True),
    ]


def test_rules_are_extensible_and_versioned(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x long")
    out = flag_rules(df, {"negative": F.col("x") < 0, "missing": F.col("x").isNull()}, version="2")
    valid, rejected = split_quarantine(out)
    assert rows(rejected, "x", "is_negative", "is_missing", "rejection_ruleset_version") == [
        (-1, True, False, "2"), (None, False, True, "2"),
    ]
    assert rows(valid, "x") == [(1,)]


FACT = ("duration_capped_seconds", "duration_exceeds_episode_length", "listen_through_rate", "is_listen_event")


@pytest.mark.parametrize(
    ("row", "expected"),
    [
        (event(seconds=300), (300, False, 0.5, True)),
        (event(seconds=600), (600, False, 1.0, True)),
        (event(seconds=601), (600, True, 1.0, True)),
        (event(kind="complete", seconds=6000), (600, True, 1.0, True)),
        (event(kind="pause"), (None, False, None, False)),
        (event(kind="pause", seconds=700), (600, True, None, False)),
        (event(episode="unknown"), (300, None, None, True)),
        (event(episode="zero"), (0, True, None, True)),
    ],
)
def test_capping(spark, row, expected):
    s = star(spark, [row], episodes=[SHORT, ("zero", "p9", "Zero", "2024-01-01", 0)])
    assert rows(s.fact, *FACT) == [expected]


def test_before_release_is_strict(spark):
    s = star(spark, [event(at="2024-02-29T23:59:59"), event(at="2024-03-01T00:00:00"), event(episode="unknown")])
    assert rows(s.fact, "episode_id", "is_before_episode_release") == [("e1", False), ("e1", True), ("unknown", False)]


def test_calendar_parts_of_the_fact(spark):
    fact = star(spark, [event(at="2024-03-05T10:00:00")]).fact
    parts = ("event_date", "event_year", "event_month", "event_hour_of_day", "event_day_of_week")
    assert rows(fact, *parts) == [(dt.date(2024, 3, 5), 2024, 3, 10, "Tuesday")]


def test_engagement_nulls(spark):
    s = star(spark, [event(kind="seek", user="bob"), event(user="ann", at=None), event(user="ann", episode=None)])
    columns = (
        "user_id", "total_valid_events", "total_listen_events", "distinct_episodes_listened",
        "distinct_podcasts_listened", "total_capped_listen_seconds", "avg_listen_through_rate",
        "distinct_days_active", "days_to_first_listen",
    )
    assert rows(s.engagement, *columns) == [
        ("ann", *[None] * 8),
        ("bob", 1, 0, None, None, None, None, 1, None),
        ("cy", *[None] * 8),
    ]


def test_engagement_sums(spark):
    events = [
        event(kind="download", at="2024-03-04T00:00:00"),
        event(seconds=300),
        event(seconds=900),
        event(episode="e2", at="2024-03-06T01:00:00", seconds=300),
    ]
    s = star(spark, events, users=[ANN])
    (row,) = s.engagement.collect()
    assert row["total_valid_events"] == 4 and row["total_listen_events"] == 3
    assert row["distinct_episodes_listened"] == 2 and row["distinct_podcasts_listened"] == 1
    assert row["total_capped_listen_seconds"] == 1200
    assert row["avg_listen_through_rate"] == pytest.approx((0.5 + 1 + 0.25) / 3)
    assert row["first_event_date"] == dt.date(2024, 3, 4) and row["first_listen_date"] == dt.date(2024, 3, 5)
    assert row["distinct_days_active"] == 3 and row["days_to_first_listen"] == 64


def test_daily_activity_counts_listens_only(spark):
    s = star(spark, [event(), event(seconds=301), event(episode="e2"), event(kind="seek", episode="e3")])
    assert rows(s.daily_activity, "user_id", "distinct_episodes", "total_listen_events") == [("ann", 2, 3)]


def test_recent_window_is_inclusive_and_anchored_on_any_valid_event(spark):
    events = [
        event(kind="complete", at="2024-03-14T23:59:59"),
        event(kind="complete", episode="e2", at="2024-03-13T23:59:59"),
        event(kind="pause", at="2024-03-20T00:00:00"),
        event(kind="pause", user=None, at="2024-05-20T00:00:00"),
    ]
    found = analyses.top_completed_episodes(star(spark, events), days=7)
    assert rows(found, "episode_id", "completion_events") == [("e1", 1)]


def test_top_episodes_break_ties_by_id(spark):
    events = [event(kind="complete", episode=e, seconds=s) for e, n in (("e1", 2), ("e2", 2), ("e3", 3)) for s in range(1, n + 1)]
    found = analyses.top_completed_episodes(star(spark, events), n=2).collect()
    assert [tuple(r) for r in found] == [("e3", "Three", 3), ("e1", "One", 2)]


def test_podcast_without_completions_has_zero(spark):
    s = star(spark, [event(kind="complete"), event(kind="complete", seconds=2)])
    found = analyses.podcast_completions(s).collect()
    assert [tuple(r) for r in found] == [("p1", 2, 2, 1.0), ("p2", 1, 0, 0.0)]
    assert [r[0] for r in analyses.podcast_completions(s, min_episodes=2).collect()] == ["p1"]


def test_share_of_tied_top_podcast(spark):
    events = [event(), event(episode="e3"), event(user="bob"), event(user="bob", seconds=1)]
    found = analyses.top_podcast_share(star(spark, events)).first()
    assert tuple(found) == (0.75, 0.5, 1.0)


def test_listener_types(spark):
    events = [event(), event(user="bob"), event(user="bob", episode="e3")]
    found = analyses.single_vs_multi_podcast(star(spark, events)).collect()
    assert [tuple(r) for r in found] == [
        ("multi_podcast", 1, 2.0), ("no_listens", 1, None), ("single_podcast", 1, 1.0),
    ]


def test_buckets_in_their_natural_order(spark):
    events = [event(episode=e) for e in ("e3", "e2", "e1")]
    found = analyses.ltr_by_length_bucket(star(spark, events)).collect()
    assert [r[0] for r in found] == ["short", "medium", "long"]


def test_unknown_episode_is_in_the_fact_but_in_no_episode_metric(spark):
    s = star(spark, [event(kind="complete", episode="unknown"), event(kind="complete")])
    assert s.fact.count() == 2
    assert rows(analyses.top_completed_episodes(s), "episode_id") == [("e1",)]
    assert rows(analyses.ltr_by_podcast(s), "podcast_id") == [("p1",)]


def test_duplicated_episode_fans_the_fact_out(spark):
    assert star(spark, [event()], episodes=[SHORT, SHORT, LONG]).fact.count() == 2


def test_unreadable_date_of_a_dimension_stops_the_job(spark):
    s = star(spark, [], users=[("ann", "malformed-date", "DE"), BOB], episodes=[MEDIUM])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        s.dim_users.collect()


def test_empty_log(spark):
    s = star(spark, [])
    assert s.fact.count() == 0 and s.engagement.count() == 3
    assert {r["value"] for r in analyses.data_quality_summary(s).collect()} == {0}
    assert analyses.users_with_busy_day(s).first()[0] == 0
    assert analyses.top_completed_episodes(s, days=7).count() == 0


def test_views_answer_sql(spark):
    star(spark, [event(), event(user=None)]).create_views()
    found = spark.sql(
        "SELECT u.country, count(*) AS n FROM fct_listening_events f JOIN dim_users u USING (user_id) GROUP BY 1"
    )
    assert rows(found, "country", "n") == [("DE", 1)]
    assert spark.table("rejected_event_logs").count() == 1
