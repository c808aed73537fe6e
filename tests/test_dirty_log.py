"""A made-up log far dirtier than the given one, through every query and its SQL."""

import random

import duckdb
import pytest

import __spark_entry__ as entry
from earshot import Inputs
from earshot.sources.inputs import EPISODES, EVENT_LOG, USERS
from oracle import _STATEMENTS, MODELS
from tests.compare import spark_rows, sql_rows

INCREMENTAL = ("incremental_fact", "incremental_daily_activity", "incremental_mart", "check_derived_tables", "incremental_fact_stream")
FILES = ("csv_round_trip", "damaged_log")
HISTORY = ("dim_users_history", "ltr_by_country_as_of")
OTHER_INPUTS = (*FILES, *HISTORY, "feature_impact", *INCREMENTAL, "ltr_by_region", "rejection_alarm", "mart_under_second_rules")
STAMPS = [None, "", "malformed-date", "2024-02-30", "2024-01", "2024/01/05 10:00:00", "2024-01-06T10:00Z", "2024-01-07"]


def log(rng, n):
    def one():
        day, second = rng.randint(1, 28), rng.randint(0, 3)
        stamp = f"2024-01-{day:02d}T1{second}:00:00" if rng.random() < 0.8 else rng.choice(STAMPS)
        kind = rng.choice(["play", "complete", "pause", "seek", "download", "rewind", None])
        seconds = rng.choice([None, 0, 1, 599, 600, 601, 5000]) if rng.random() < 0.7 else None
        user = rng.choice([None, "", "ghost", *(f"u{i}" for i in range(6))])
        episode = rng.choice([None, "ghost", "zero", *(f"e{i}" for i in range(6))])
        return kind, user, episode, stamp, seconds

    rows = [one() for _ in range(n)]
    return rows + rng.sample(rows, n // 10)


@pytest.fixture(scope="module")
def dirty(spark):
    rng = random.Random(7)
    users = [(f"u{i}", f"2023-{i + 1:02d}-15", rng.choice(["DE", "IE", None])) for i in range(8)]
    episodes = [(f"e{i}", f"p{i % 3}", f"t{i}", f"2024-01-{5 + i:02d}", 600 * (i + 1)) for i in range(7)]
    episodes += [("zero", "p9", "none", "2024-01-01", 0), ("open", None, "open", "2024-01-01", None)]
    events = log(rng, 3000)
    folder_of = Inputs(
        spark.createDataFrame(users, USERS),
        spark.createDataFrame(episodes, EPISODES),
        spark.createDataFrame(events, EVENT_LOG).repartition(3),
    )
    con = duckdb.connect()
    tables = {
        "people": ("user_id VARCHAR, signup_date DATE, country VARCHAR", users),
        "shows": ("episode_id VARCHAR, podcast_id VARCHAR, title VARCHAR, release_date DATE, duration_seconds BIGINT", episodes),
        "log": ("event_type VARCHAR, user_id VARCHAR, episode_id VARCHAR, event_timestamp_raw VARCHAR, duration BIGINT", events),
    }
    for name, (columns, content) in tables.items():
        con.execute(f"CREATE TABLE {name} ({columns})")
        con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(content[0]))})", content)
    return folder_of, con


@pytest.mark.parametrize("name", [n for n in entry.ORACLE if n not in OTHER_INPUTS])
def test_dirty_log(spark, dirty, monkeypatch, name):
    made, con = dirty
    monkeypatch.setattr(entry.retail, "from_retail", lambda *_: made)
    assert spark_rows(entry.QUERIES[name](spark, "unused")) == sql_rows(con, f"WITH {MODELS}{_STATEMENTS[name]}")
