"""Checks pass on the given tables (see test_queries) and fail on frames broken on purpose."""

import pytest
from pyspark.sql import functions as F

from earshot import Star
from earshot.operators import checks as c
from earshot.plans import quality
from earshot.plans.star import StoredStar
from earshot.session import shared_folder
from earshot.streaming.increment import load_increment
from tests.frames import ANN, BOB, LONG, MEDIUM, SHORT, event, inputs, rows, star


def failing(df):
    return {(r["check"], r["target"]): r["failing_rows"] for r in df.collect() if r["failing_rows"]}


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), ("c",), (None,), (None,)], "k string")
    assert failing(c.check_unique(df, "t.k", "k")) == {("unique", "t.k"): 2}
    assert failing(c.check_key(df, "t.k", "k")) == {("unique", "t.k"): 2, ("not_null", "t.k"): 2}


def test_a_pass_is_a_row_with_zero(spark):
    df = spark.createDataFrame([], "k string")
    assert rows(c.check_key(df, "t.k", "k"), "check", "failing_rows") == [("not_null", 0), ("unique", 0)]
    assert rows(c.check_unique(df, "t", "k"), "check", "failing_rows") == [("unique", 0)]
    assert rows(c.check_references(df, "t", "k", df, "k"), "failing_rows") == [(0,)]


def test_accepted_values_ignore_null(spark):
    df = spark.createDataFrame([("play",), ("rewind",), (None,)], "event_type string")
    found = c.check_rows(df, [("accepted_values", "t", c.is_not_among("event_type", ["play"]))])
    assert failing(found) == {("accepted_values", "t"): 1}


def test_references_count_child_rows(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "id string")
    assert failing(c.check_references(child, "t.k", "k", parent, "id")) == {("relationships", "t.k"): 2}


def test_split(spark):
    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "id string")

    whole = ("whole", ids("a", "b", "c"))
    good = c.check_split(whole, {"x": ids("a", "b"), "y": ids("c")}, "id")
    assert good.count() == 8 and failing(good) == {}
    both = c.check_split(whole, {"x": ids("a", "b"), "y": ids("b")}, "id")
    assert failing(both) == {("exclusive_split", "x, y"): 1}
    lost = c.check_split(whole, {"x": ids("a", "b"), "y": ids()}, "id")
    assert failing(lost) == {("reconciliation", "whole"): 1}
    twice = c.check_split(whole, {"x": ids("a", "b", "b"), "y": ids("c", None)}, "id")
    assert failing(twice) == {("unique", "x.id"): 1, ("not_null", "y.id"): 1, ("reconciliation", "whole"): 1}
    assert failing(c.check_disjoint(ids("a", "b"), ids("b", "b"), "id", "t")) == {("exclusive_split", "t"): 1}
    assert failing(c.check_parts_sum(whole[1], [ids("a")], "t")) == {("reconciliation", "t"): 1}


def test_broken_star(spark):
    events = [event(kind="pause", seconds=5), event(kind="rewind"), event(user="ghost"), event(episode="ghost")]
    broken = star(
        spark,
        events,
        users=[ANN, ANN, (None, "2024-01-01", "DE")],
        episodes=[SHORT, MEDIUM, LONG, (None, "p", "t", "2024-01-01", 1)],
    )
    assert failing(quality.check_capped_null_rule(broken)) == {("capped_null_rule", "fct_listening_events"): 1}
    assert failing(quality.check_accepted_values(broken)) == {("accepted_values", "fct_listening_events.event_type"): 1}
    assert failing(quality.check_relationships(broken)) == {
        ("relationships", "fct_listening_events.user_id"): 1,
        ("relationships", "fct_listening_events.episode_id"): 1,
    }
    assert failing(quality.check_unique(broken)) == {
        ("unique", "stg_users.user_id"): 1, ("unique", "dim_users.user_id"): 1, ("unique", "mart_user_engagement.user_id"): 1,
    }
    assert failing(quality.check_not_null(broken)) == {
        ("not_null", "stg_users.user_id"): 1, ("not_null", "stg_episodes.episode_id"): 1,
        ("not_null", "dim_users.user_id"): 1, ("not_null", "dim_episodes.episode_id"): 1,
        ("not_null", "mart_user_engagement.user_id"): 1,
    }
    each = {}
    for check in quality.CHECKS.values():
        each.update(failing(check(broken)))
    report = quality.check_report(broken)
    assert report.count() == 26 and failing(report) == each
    with pytest.raises(quality.ChecksFailed, match="capped_null_rule on fct_listening_events: 1"):
        quality.require_clean(report)


def test_rules_of_the_fact_catch_a_wrong_cap_and_a_missing_reason(spark):
    s = star(spark, [event(seconds=900), event(user=None)])
    s.__dict__["events"] = s.events.withColumn("duration_capped_seconds", F.col("duration_raw_seconds"))
    s.__dict__["quarantine"] = s.quarantine.withColumn("rejection_reason_count", F.lit(0))
    assert failing(quality.check_capped_le_length(s)) == {("capped_le_length", "fct_listening_events"): 1}
    assert failing(quality.check_rejected_has_reason(s)) == {("rejected_has_reason", "rejected_event_logs"): 1}


def test_written_star_is_the_same_and_clean(spark):
    s = star(spark, [event(), event(), event(user="bob", at="2024-03-06"), event(user=None), event(at=None)], users=[ANN, BOB])
    stored = s.write(shared_folder(spark, "star"))
    for name, frame in s.models().items():
        columns = [x for x in frame.columns if x != "data_refreshed_on"]
        assert stored.models()[name].columns == frame.columns, name
        assert rows(stored.models()[name], *columns) == rows(frame, *columns), name
    quality.require_clean(quality.check_report(stored))
    assert stored.last_event_date.first()[0] == s.last_event_date.first()[0]


def test_capped_duration_is_held_against_the_dimension(spark):
    whole = star(spark, [event()]).write(shared_folder(spark, "star"))
    whole.dim_episodes = whole.dim_episodes.withColumn("duration_seconds", F.lit(10))
    assert failing(quality.check_capped_le_length(whole)) == {("capped_le_length", "fct_listening_events"): 1}


def test_checks_on_rows_are_counted_while_writing(spark):
    log = [event(), event(), event("pause", seconds=5), event(user=None), event("skip", "bob"), event("skip", "bob", "e9")]
    nobody, nothing = (None, "2024-01-01", "DE"), (None, "p1", "None", "2024-03-01", 600)
    everything = inputs(spark, log, users=[ANN, nobody], episodes=[SHORT, nothing])
    folder = shared_folder(spark, "star")
    stored = Star(everything).write(folder)
    scanned = {(r["check"], r["target"]): r["failing_rows"] for r in quality.check_report(stored).collect()}
    recorded = failing(quality.recorded_report(stored))
    assert recorded == {name: n for name, n in scanned.items() if n and name in quality.RECORDED}
    assert recorded["capped_null_rule", "fct_listening_events"] == 1
    assert recorded["accepted_values", "fct_listening_events.event_type"] == 2
    # Loads add to the counts; days that are measured again do not count twice.
    shorter = ("e1", "p1", "One", "2024-03-01", 300)
    more = inputs(spark, [event("skip", "bob", "e9", at="2024-05-01")], users=[ANN], episodes=[shorter])
    load_increment(more, folder)
    again = failing(quality.recorded_report(StoredStar(folder, more)))
    assert again == {("capped_null_rule", "fct_listening_events"): 1, ("accepted_values", "fct_listening_events.event_type"): 3}


def test_a_file_that_is_gone_fails_the_reconciliation(spark):
    stored = star(spark, [event(), event(user=None)]).write(shared_folder(spark, "star"))
    assert failing(quality.recorded_report(stored)) == {}
    stored.rows_now = lambda: (1, 0)
    assert failing(quality.recorded_report(stored)) == {("reconciliation", "stg_event_logs"): 1}
