"""The three inputs derived from retail test tables: parts are episodes, customers are users, and
the event stream becomes a log with known faults and duplicates, by fixed arithmetic on its ids."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from earshot.sources.inputs import Inputs

# Declared, not inferred: reading a table opens no file before the job does.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_size int",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(os.path.join(folder, f"{name}.parquet"))


def from_retail(spark: SparkSession, folder: str) -> Inputs:
    return Inputs(
        users=users(table(spark, folder, "customer"), table(spark, folder, "nation")),
        episodes=episodes(table(spark, folder, "part")),
        event_logs=event_logs(table(spark, folder, "events")),
    )


def episodes(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey AS episode_id",
        "p_brand AS podcast_id",
        "p_name AS title",
        "date_add(DATE '2023-07-01', CAST(p_partkey * 37 % 400 AS INT)) AS release_date",
        "CAST(300 + 100 * p_size AS BIGINT) AS duration_seconds",
    )


def users(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).selectExpr(
        "c_custkey AS user_id",
        "date_add(DATE '2023-06-01', CAST(c_custkey * 13 % 200 AS INT)) AS signup_date",
        "n_name AS country",
    )


def regions(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Country to region."""
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).selectExpr(
        "n_name AS country", "r_name AS region"
    )


# An event becomes a log entry; ids leave certain remainders where a field is blanked or spoilt.
KIND = """
    CASE WHEN user_id % 50 = 3 THEN 'seek'
         WHEN event_type = 'view' THEN 'play'
         WHEN event_type = 'purchase' THEN 'complete'
         WHEN event_type = 'click' THEN 'pause'
         WHEN event_type = 'signup' THEN 'seek'
         ELSE 'download' END"""
ENTRY = """
    named_struct(
        'event_type', IF(event_id % 197 = 5, NULL, kind),
        'user_id', IF(event_id % 83 = 5, NULL, user_id),
        'episode_id', CASE WHEN event_id % 109 = 5 THEN NULL
                           WHEN user_id % 50 = 11 THEN user_id % 100
                           ELSE CAST(get_json_object(props, '$.k') AS BIGINT) END,
        'timestamp', CASE WHEN event_id % 181 = 5 OR event_id % 415 = 5 THEN NULL
                          WHEN event_id % 277 = 5 OR event_id % 830 = 88 THEN 'malformed-date'
                          ELSE replace(substr(CAST(ts AS STRING), 1, 19), ' ', 'T') END,
        'duration', IF(kind IN ('play', 'complete') AND event_id % 331 != 6,
                       CAST(1 + floor(20 * value) AS BIGINT), NULL))"""


def event_logs(events: DataFrame) -> DataFrame:
    """Works on a streaming frame too: every rule looks at one row, and a duplicate is the same entry
    emitted twice rather than a second scan. Emitting whole entries also keeps later filters from
    working out these rules again."""
    kinds = events.selectExpr("*", f"{KIND} AS kind")
    return kinds.selectExpr(f"inline(array_repeat({ENTRY}, IF(event_id % 499 = 0, 2, 1)))")
