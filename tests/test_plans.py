"""Plans that have to hold at scale: what is scanned, shuffled, pushed down - and what must not be."""

import pytest

import __spark_entry__ as entry
from earshot import Star
from earshot.plans import analyses
from earshot.session import settings_for, shared_folder
from earshot.sources.retail import from_retail
from tests.frames import event, inputs, plan_of, star

FOLDER = "/root/testdata/sf0.001"
INCREMENTAL = ("incremental_fact", "incremental_daily_activity", "incremental_mart", "check_derived_tables", "incremental_fact_stream")
WRITING = ("check_report", "csv_round_trip", *INCREMENTAL)
LAZY = [n for n in entry.ORACLE if n not in WRITING]


@pytest.fixture(scope="module")
def retail_star(spark):
    return Star(from_retail(spark, FOLDER))


def tree(df):
    """The initial physical plan as an indented tree."""
    return plan_of(df, "simple")


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = tree(entry.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_staging_shuffles_once_without_sort_or_window(retail_star):
    plan = tree(retail_star.staged)
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    assert "Sort" not in plan and "Window" not in plan


def test_validity_is_filtered_below_the_duplicate_removal(retail_star):
    plan = tree(retail_star.valid)
    exchange = plan.index("Exchange")
    assert "Filter" in plan[exchange:] and "Filter" not in plan[:exchange]


def test_fact_needs_no_second_shuffle(retail_star):
    plan = tree(retail_star.fact)
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_summary_reads_and_shuffles_the_log_once(retail_star):
    plan = tree(analyses.data_quality_summary(retail_star))
    assert plan.count("value#") >= 1 and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("FileScan") == 2  # the log and the episodes


def test_recent_window_is_cut_before_the_shuffle(retail_star):
    plan = tree(analyses.recent(retail_star, 7))
    assert "subquery" in plan[plan.index("Exchange hashpartitioning") :].lower()


def test_top_n_does_not_sort_globally(retail_star):
    plan = tree(analyses.top_completed_episodes(retail_star))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_plain_log_is_filtered_in_the_scan(spark):
    folder = shared_folder(spark, "log")
    made = inputs(spark, [event(), event(user=None)])
    made.event_logs.write.parquet(folder)
    log = spark.read.schema(made.event_logs.schema).parquet(folder)
    plan = plan_of(Star(type(made)(made.users, made.episodes, log)).valid)
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters")]
    assert "IsNotNull(user_id)" in pushed[0] and "IsNotNull(episode_id)" in pushed[0]


def test_written_fact_is_read_by_column_and_by_day(spark):
    s = star(spark, [event(), event(at="2024-03-09", kind="complete")])
    stored = s.write(shared_folder(spark, "star"))
    plan = plan_of(analyses.ltr_by_podcast(stored))
    schema = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "event_id" not in schema and "duration_raw" not in schema and "listen_through_rate" in schema
    recent = plan_of(analyses.top_completed_episodes(stored, days=7))
    assert any("event_date" in line and "subquery" in line.lower() for line in recent.splitlines() if "PartitionFilters" in line)


def test_settings_grow_with_the_log():
    small, large = settings_for(10**9), settings_for(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(large["spark.sql.shuffle.partitions"]) * 256 * 1024**2 >= 100 * 10**12


def test_folders_are_made_where_the_session_says(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
