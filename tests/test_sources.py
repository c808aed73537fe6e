"""CSV in and out, parquet, tables."""

import os

import pytest
from pyspark.sql import functions as F

from earshot import Star
from earshot.plans import analyses, quality
from earshot.session import shared_folder
from earshot.sources import inputs as src
from tests.frames import event, inputs, rows

LOG = (
    '"event_type","user_id","episode_id","timestamp","duration"\r\n'
    '"play","ann","e1","2024-03-05T10:00:00","300"\r\n'
    '"pause","ann","e1","2024-03-05T10:01:00",""\r\n'
    '"","","e1","malformed-date",""\r\n'
)
USERS = "user_id,signup_date,country\nann,2024-01-01,DE\nbob,2024-02-10,\n"
EPISODES = 'episode_id,podcast_id,title,release_date,duration_seconds\r\ne1,p1,"One, and ""two""",2024-03-01,600\r\n'


@pytest.fixture
def folder(tmp_path):
    for name, text in (("users", USERS), ("episodes", EPISODES), ("event_logs", LOG)):
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    return str(tmp_path)


def test_csv_files(spark, folder):
    found = src.from_csv(spark, folder)
    assert rows(found.event_logs, "*") == sorted(
        [
            ("play", "ann", "e1", "2024-03-05T10:00:00", 300),
            ("pause", "ann", "e1", "2024-03-05T10:01:00", None),
            (None, None, "e1", "malformed-date", None),
        ],
        key=repr,
    )
    assert rows(found.users, "user_id", "country") == [("ann", "DE"), ("bob", None)]
    assert rows(found.episodes, "title", "duration_seconds") == [('One, and "two"', 600)]
    assert rows(Star(found).rejected, "rejection_reason_summary") == [
        ("missing_event_type, missing_user_id, malformed_timestamp",)
    ]


def test_csv_value_of_the_wrong_type_stops_the_job(spark, tmp_path):
    (tmp_path / "log.csv").write_text(LOG.replace('"300"', '"soon"'))
    with pytest.raises(Exception, match="MALFORMED"):
        src.read_csv(spark, str(tmp_path / "log.csv"), src.EVENT_LOG).collect()


DAMAGED = [
    '"play","ann","e1","2024-03-05T11:00:00","soon"',
    '"play","ann","e1","2024-03-05T11:00:00","300","one too many"',
    '"play","ann"',
]


def test_damaged_lines_are_counted_and_kept(spark, tmp_path, folder):
    """raw = duplicates + fact + quarantine, with three damaged lines, one of them twice."""
    lines = LOG + "".join(line + "\r\n" for line in [*DAMAGED, DAMAGED[0], LOG.splitlines()[1]])
    (tmp_path / "event_logs.csv").write_bytes(lines.encode())
    with pytest.raises(Exception, match="MALFORMED"):
        src.from_csv(spark, folder).event_logs.collect()
    found = Star(src.from_csv(spark, folder, keep_damaged=True))
    rejected = rows(found.rejected.where("rejection_reason_summary = 'damaged_line'"), "event_timestamp_raw", "rejection_reason_count")
    assert rejected == sorted((line, 1) for line in DAMAGED)
    stored = found.write(shared_folder(spark, "star"))
    for s in (found, stored):
        summary = {r["metric"]: r["value"] for r in analyses.data_quality_summary(s).collect()}
        counts = [summary[f"{x}_events"] for x in ("total_raw", "valid", "rejected")]
        assert (counts, summary["duplicate_events_removed"]) == ([8, 2, 4], 2)
        assert summary["malformed_timestamp"] == summary["missing_event_type"] == 1
    assert {r["failing_rows"] for r in quality.check_report(stored).collect()} == {0}
    assert {r["failing_rows"] for r in quality.recorded_report(stored).collect()} == {0}
    # A line that reads like a damaged one, but is none, is another event.
    twin = spark.createDataFrame([(None, None, None, DAMAGED[2], None, False)], found.inputs.event_logs.schema)
    both = Star(src.Inputs(found.inputs.users, found.inputs.episodes, found.inputs.event_logs.union(twin)))
    assert both.rejected.count() == 5 == both.rejected.select("event_id").distinct().count()


def test_a_header_of_another_file_ends_the_load(spark, tmp_path):
    (tmp_path / "log.csv").write_text(LOG.replace("duration", "seconds"))
    with pytest.raises(Exception, match="CSV header"):
        src.read_log(spark, str(tmp_path / "log.csv")).collect()


def test_inputs_of_the_wrong_type_are_refused_by_name(spark):
    made = inputs(spark, [event()])
    log = made.event_logs
    wrong = log.withColumn("duration", F.col("duration").cast("double")).drop("user_id").withColumn("timestamp", F.array("timestamp"))
    with pytest.raises(ValueError) as refused:
        src.conform(wrong, "event_logs")
    assert str(refused.value) == (
        "event_logs.user_id is missing; event_logs.timestamp is array<string>, not string; "
        "event_logs.duration is double, not a whole number"
    )
    narrow = log.withColumn("duration", F.col("duration").cast("int")).withColumn("user_id", F.lit(5)).withColumn("more", F.lit(1))
    kept = src.conform(narrow, "event_logs")
    assert kept.columns == log.columns and dict(kept.dtypes)["duration"] == "bigint"
    dated = made.users.withColumn("signup_date", F.col("signup_date").cast("date"))
    assert src.conform(dated, "users").count() == 3
    folder = shared_folder(spark, "parquet")
    for name in src.NAMES:
        (wrong if name == "event_logs" else getattr(made, name)).write.parquet(os.path.join(folder, f"{name}.parquet"))
    with pytest.raises(ValueError, match="event_logs.duration is double"):
        src.from_parquet(spark, folder)


def test_csv_round_trip(spark):
    log = inputs(spark, [event(), event(user=None), event(kind="pause"), event(at='a "b", c')]).event_logs
    path = shared_folder(spark, "csv")
    src.write_csv(log, path)
    (part,) = [f for f in os.listdir(path) if f.endswith(".csv")][:1]
    with open(os.path.join(path, part)) as lines:
        assert next(lines).strip() == '"event_type","user_id","episode_id","timestamp","duration"'
    assert rows(src.read_csv(spark, path, src.EVENT_LOG), "*") == rows(log, "*")


def test_parquet_and_tables(spark):
    made = inputs(spark, [event(), event(user=None)])
    folder = shared_folder(spark, "parquet")
    for name in src.NAMES:
        getattr(made, name).write.parquet(os.path.join(folder, f"{name}.parquet"))
        getattr(made, name).createOrReplaceTempView(f"source_{name}")
    expected = rows(Star(made).staged, "*")
    assert rows(Star(src.from_parquet(spark, folder)).staged, "*") == expected
    tables = src.from_tables(spark, "source_users", "source_episodes", "source_event_logs")
    assert rows(Star(tables).staged, "*") == expected
