"""Loading bit by bit ends in the same tables as loading everything, however often it is repeated."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from earshot import Inputs, Star
from earshot.plans import analyses, monitoring, quality
from earshot.plans import star as star_module
from earshot.operators.versions import read_state
from earshot.plans.star import DAILY, StoredStar, write_events
from earshot.session import shared_folder
from earshot.streaming import increment
from earshot.streaming.increment import _within, compact, load_increment, lost_events, refresh_tables, stream_increments
from tests.frames import LONG, MEDIUM, SHORT, event, inputs, plan_of, rows, star

EARLY = [event(), event(), event(user=None), event(kind=None, at=None, seconds=None)]
LATE = [event(at="2024-03-09T08:00:00"), event(user="bob", at="malformed-date"), event(at="2024-03-05T09:00:00")]


def ids(folder, any_inputs):
    stored = StoredStar(folder, any_inputs)
    return rows(stored.events, "event_id"), rows(stored.quarantine, "event_id")


def expected(spark):
    full = star(spark, EARLY + LATE)
    return rows(full.events, "event_id"), rows(full.quarantine, "event_id")


def test_overlapping_loads_and_reruns(spark):
    folder = shared_folder(spark, "inc")
    first, everything = inputs(spark, EARLY), inputs(spark, LATE + EARLY)
    for batch in (first, first, everything, everything):
        load_increment(batch, folder)
    assert ids(folder, everything) == expected(spark)


def test_a_load_that_wrote_only_some_rows_is_repaired(spark):
    folder = shared_folder(spark, "inc")
    everything = inputs(spark, EARLY + LATE)
    write_events(star(spark, EARLY + LATE).counted.where("user_id = 'ann' AND NOT is_rejected"), folder, 1)
    load_increment(everything, folder)
    assert ids(folder, everything) == expected(spark)


def test_late_events_are_loaded_and_counted(spark):
    folder = shared_folder(spark, "inc")
    load_increment(inputs(spark, [event(at="2024-03-09T08:00:00")]), folder)
    late = [event(at="2023-03-06T23:00:00"), event(at="2024-03-07T00:00:00"), event(at="2024-03-10"), event(at="?")]
    load_increment(inputs(spark, late), folder)
    stored = StoredStar(folder, inputs(spark, []))
    assert (stored.events.count(), stored.quarantine.count()) == (4, 1)


def test_days_far_apart_are_searched(spark):
    folder = shared_folder(spark, "inc")
    everything = inputs(spark, EARLY + LATE)
    load_increment(everything, folder)
    load_increment(everything, folder)
    assert ids(folder, everything) == expected(spark)


def test_search_is_pruned_to_the_days_of_the_batch(spark):
    folder = shared_folder(spark, "inc")
    load_increment(inputs(spark, EARLY + LATE), folder)
    days = spark.createDataFrame([(dt.date(2024, 3, 9),), (None,)], "_day date")
    stored = StoredStar(folder, inputs(spark, [])).quarantine.where(_within(days))
    (filters,) = [line for line in plan_of(stored).splitlines() if line.startswith("PartitionFilters")]
    assert "event_date" in filters and "2024-03-09" in filters and "isnull" in filters
    assert stored.count() == 2


def test_derived_tables_follow_every_load(spark):
    folder = shared_folder(spark, "inc")
    load_increment(inputs(spark, EARLY), folder)
    everything = inputs(spark, EARLY + LATE)
    load_increment(everything, folder)
    stored, fresh = StoredStar(folder, everything), star(spark, EARLY + LATE)
    for table in ("dim_users", "dim_episodes", "daily_activity", "engagement"):
        got, want = (getattr(s, table).drop("data_refreshed_on") for s in (stored, fresh))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def table_rows(s, name):
    return sorted(map(tuple, getattr(s, name).drop("data_refreshed_on").collect()), key=repr)


def test_events_follow_an_episode_that_arrives_or_changes(spark):
    folder = shared_folder(spark, "inc")
    log = EARLY + [event(seconds=900), event("complete", "bob", "e3", "2024-03-08T10:00:00", 50), event(episode=None)]
    shorter = ("e1", "p9", "One", "2024-03-06", 200)
    for episodes in ((MEDIUM,), (SHORT, MEDIUM), (shorter, MEDIUM, LONG), (shorter, LONG)):
        load_increment(inputs(spark, log, episodes=episodes), folder)
        stored, fresh = StoredStar(folder, inputs(spark, log, episodes=episodes)), star(spark, log, episodes=episodes)
        for table in ("events", "classified", "daily_activity", "engagement"):
            assert table_rows(stored, table) == table_rows(fresh, table)
        assert stored.stale_days().isEmpty()


def derived_failures(stored):
    return {r["target"]: r["failing_rows"] for r in quality.check_derived_tables(stored).collect()}


def test_derived_tables_follow_a_load_without_being_written(spark):
    folder = shared_folder(spark, "inc")
    star(spark, EARLY).write(folder)
    everything = inputs(spark, EARLY + LATE)
    assert StoredStar(folder, everything).is_written(DAILY)
    load_increment(everything, folder)
    for written in (False, True):
        stored = StoredStar(folder, everything)
        assert stored.is_written(DAILY) == written
        assert set(derived_failures(stored).values()) == {0}
        assert ("user_episode_day" in "".join(stored.daily_activity.inputFiles())) != written
        refresh_tables(everything, folder)


def test_a_derived_table_that_is_wrong_fails_its_check(spark):
    folder = shared_folder(spark, "inc")
    everything = inputs(spark, EARLY + LATE)
    stored = Star(everything).write(folder)
    few = star(spark, EARLY).write(shared_folder(spark, "few"))
    stored.daily_activity, stored.engagement = few.daily_activity, few.engagement
    # Two late listens of one user, on a day that had one and on a new day.
    assert derived_failures(stored) == {"int_user_daily_activity": 2, "mart_user_engagement": 1}


TABLES = ("dim_users", "dim_episodes", "events", "classified", "daily_activity", "engagement")
WRITES = ("write_events", "roll_up", "same_rows", "publish")


@pytest.mark.parametrize("dies_in", WRITES)
def test_a_load_that_dies_shows_nothing_and_a_reader_keeps_its_state(spark, monkeypatch, dies_in):
    """Stopped before any one of its writes, or before the last step, a load leaves a whole old star."""
    folder = shared_folder(spark, "inc")
    shorter = ("e1", "p9", "One", "2024-03-06", 200)
    first, second = inputs(spark, EARLY), inputs(spark, EARLY + LATE, episodes=(shorter, LONG))
    load_increment(first, folder)
    reader = StoredStar(folder, first)

    def die(*_args, **_options):
        raise RuntimeError("the machine is gone")

    modules = {"write_events": star_module, "roll_up": star_module.rollup, "same_rows": star_module, "publish": increment}
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(modules[dies_in], dies_in, die)
        load_increment(second, folder)
    for seen in (reader, StoredStar(folder, second)):
        for table in TABLES:
            assert table_rows(seen, table) == table_rows(Star(first), table)
    load_increment(second, folder)
    for table in TABLES:
        assert table_rows(StoredStar(folder, second), table) == table_rows(Star(second), table)
    assert read_state(spark, folder).version == 2
    # Who began to read before still reads what was there then.
    for table in TABLES:
        assert table_rows(reader, table) == table_rows(Star(first), table)


def test_a_compacted_star_is_the_same(spark):
    folder = shared_folder(spark, "inc")
    everything = inputs(spark, EARLY + LATE)
    for batch in (inputs(spark, EARLY), inputs(spark, LATE[:1]), everything):
        load_increment(batch, folder)
    before = StoredStar(folder, everything).state
    state = compact(everything, folder)
    stored = StoredStar(folder, everything)
    assert (state.first, state.version, state.days) == (4, 4, {}) and state.totals == before.totals
    files = [r[0] for r in stored.events.select(F.input_file_name()).distinct().collect()]
    assert files and all("/load=4/" in f for f in files)
    load_increment(inputs(spark, [event(user="cy", at="2024-03-05")]), folder)
    whole = Star(inputs(spark, EARLY + LATE + [event(user="cy", at="2024-03-05")]))
    for table in TABLES:
        assert table_rows(StoredStar(folder, everything), table) == table_rows(whole, table)


def test_lost_events_are_found(spark):
    folder = shared_folder(spark, "inc")
    load_increment(inputs(spark, EARLY + LATE[:2]), folder)
    everything = inputs(spark, EARLY + LATE)
    assert lost_events(everything, folder).count() == 1
    load_increment(everything, folder)
    assert lost_events(everything, folder).isEmpty()


def rows_read(spark, action):
    """Rows that Spark's scans have read while `action` ran."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()

    def total():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        gateway = spark.sparkContext._gateway
        store = spark.sparkContext._jsc.sc().statusStore()
        quantiles = gateway.new_array(gateway.jvm.double, 0)
        stages = store.stageList(None, False, False, quantiles, gateway.jvm.java.util.ArrayList())
        return sum(stages.apply(i).inputRecords() for i in range(stages.size()))

    before = total()
    action()
    return total() - before


def test_a_load_reads_in_proportion_to_its_batch(spark):
    """The same batch is loaded into a small star and into one with ten times the days."""

    def log(days):
        return [event(user=f"u{i % 9}", at=f"2023-{1 + d // 28:02d}-{1 + d % 28:02d}T10:{i:02d}:00") for d in range(days) for i in range(50)]

    batch = [event(user="bob", at=f"2023-01-02T11:{i:02d}:00") for i in range(40)]
    read = []
    for days in (20, 200):
        folder, source = shared_folder(spark, "inc"), shared_folder(spark, "source")
        load_increment(inputs(spark, log(days)), folder)
        inputs(spark, batch).event_logs.write.parquet(source)
        added = Inputs(*[getattr(inputs(spark, []), n) for n in ("users", "episodes")], spark.read.parquet(source))
        read.append(rows_read(spark, lambda: load_increment(added, folder)))
        stored = StoredStar(folder, added)
        assert stored.events.count() == 50 * days + 40
        assert set(derived_failures(stored).values()) == {0}
    # The days of the batch hold 50 events; the small star has 1,000, the large one 10,000.
    assert max(read) < 500


def test_a_stored_star_reports_from_its_events(spark):
    folder = shared_folder(spark, "inc")
    everything = inputs(spark, EARLY + LATE)
    load_increment(everything, folder)
    stored, fresh = StoredStar(folder, everything), Star(everything)
    for report in (
        monitoring.rejections_by_dimension,
        monitoring.rejection_rate_drift,
        monitoring.ruleset_version,
        analyses.data_quality_summary,
    ):
        assert rows(report(stored), "*") == rows(report(fresh), "*")
        read = plan_of(report(stored), "simple")
        # The raw log is met by the summary only, which counts its rows.
        assert ("ExistingRDD" in read) == (report is analyses.data_quality_summary)


def test_stream_equals_batch_and_survives_a_replay(spark):
    folder, source = shared_folder(spark, "stream"), shared_folder(spark, "source")
    everything = inputs(spark, EARLY + LATE)
    log = everything.event_logs

    def run(checkpoint):
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
        dimensions = Inputs(everything.users, everything.episodes, log)
        stream_increments(stream, dimensions, folder, os.path.join(folder, checkpoint)).awaitTermination()

    inputs(spark, EARLY).event_logs.coalesce(1).write.parquet(source)
    run("_checkpoint")
    inputs(spark, LATE + EARLY).event_logs.coalesce(1).write.mode("append").parquet(source)
    run("_checkpoint")
    assert ids(folder, everything) == expected(spark)
    run("_fresh_checkpoint")
    assert ids(folder, everything) == expected(spark)
