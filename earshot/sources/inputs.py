"""The three inputs, from CSV, parquet or tables; the models above do not know which."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dates are read as text and cast strictly in staging, so an unreadable one stops the job there
# instead of turning into null here. The log's timestamp is text because it holds unreadable values.
USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("signup_date", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)
EPISODES = T.StructType(
    [
        T.StructField("episode_id", T.StringType()),
        T.StructField("podcast_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("duration_seconds", T.LongType()),
    ]
)
EVENT_LOG = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("episode_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("duration", T.LongType()),
    ]
)
NAMES = {"users": USERS, "episodes": EPISODES, "event_logs": EVENT_LOG}

# Says that a row of the log is a line that could not be read, and holds it as its timestamp.
DAMAGED = "is_damaged_line"

# What a column of a table made elsewhere may be instead of the type declared above: keys may be of any
# simple type, dates may be dates, numbers may be narrower.
KEYS = ("user_id", "episode_id", "podcast_id")
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Inputs:
    users: DataFrame
    episodes: DataFrame
    event_logs: DataFrame


# A quote inside a quoted field is doubled.
QUOTING = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; an empty field, quoted or not, is null; LF or CRLF line ends.

    A field that does not fit its declared type stops the job: turned into null it would look like a
    missing value of the source.
    """
    return (
        spark.read.schema(schema)
        .options(header=True, nullValue="", emptyValue="", mode="FAILFAST", enforceSchema=False, **QUOTING)
        .csv(path)
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A log in CSV of which some lines cannot be read: a number that is none, a field too many or too few.

    Such a line becomes a row whose timestamp is the line as it stands, all else null, marked by the column
    DAMAGED. Staging rejects it under a reason of its own, so it is counted and kept in the quarantine
    instead of ending the load. A header that does not name the log's columns still ends it.
    """
    line = "_line"
    schema = T.StructType([*EVENT_LOG.fields, T.StructField(line, T.StringType())])
    rows = (
        spark.read.schema(schema)
        .options(header=True, nullValue="", emptyValue="", mode="PERMISSIVE", columnNameOfCorruptRecord=line)
        .options(enforceSchema=False, **QUOTING)
        .csv(path)
    )
    damaged = F.col(line).isNotNull()
    kept = {f.name: F.when(~damaged, F.col(f.name)) for f in EVENT_LOG.fields}
    kept["timestamp"] = F.coalesce(line, "timestamp")
    return rows.select(*[c.alias(name) for name, c in kept.items()], damaged.alias(DAMAGED))


def conform(df: DataFrame, name: str) -> DataFrame:
    """The columns that input `name` declares, in order, if `df` has them in a type that fits; otherwise a
    ValueError that names what does not. Whole numbers become long; other columns are left out."""
    wrong, columns = [], []
    for field in NAMES[name].fields:
        found = df.schema[field.name].dataType if field.name in df.columns else None
        if found is None:
            wrong.append(f"{name}.{field.name} is missing")
        elif isinstance(field.dataType, T.LongType):
            if not isinstance(found, WHOLE):
                wrong.append(f"{name}.{field.name} is {found.simpleString()}, not a whole number")
            columns.append(F.col(field.name).cast("long"))
        else:
            day = field.name.endswith("_date") and isinstance(found, T.DateType)
            key = field.name in KEYS and isinstance(found, T.AtomicType)
            if not (isinstance(found, T.StringType) or day or key):
                wrong.append(f"{name}.{field.name} is {found.simpleString()}, not {field.dataType.simpleString()}")
            columns.append(F.col(field.name))
    if wrong:
        raise ValueError("; ".join(wrong))
    return df.select(*columns, *[c for c in (DAMAGED,) if c in df.columns])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, every field quoted, null as an empty field."""
    df.write.options(header=True, quoteAll=True, nullValue="", emptyValue="", **QUOTING).csv(path)


def from_csv(spark: SparkSession, folder: str, keep_damaged: bool = False) -> Inputs:
    """users.csv, episodes.csv and event_logs.csv (each a file or a folder of files). With `keep_damaged`,
    lines of the log that cannot be read go to the quarantine (`read_log`); without, they end the run."""
    paths = {n: os.path.join(folder, f"{n}.csv") for n in NAMES}
    users, episodes = (read_csv(spark, paths[n], NAMES[n]) for n in ("users", "episodes"))
    log = read_log(spark, paths["event_logs"]) if keep_damaged else read_csv(spark, paths["event_logs"], EVENT_LOG)
    return Inputs(users, episodes, log)


def from_parquet(spark: SparkSession, folder: str) -> Inputs:
    """users.parquet, episodes.parquet and event_logs.parquet, held against the declared columns."""
    return Inputs(*[conform(spark.read.parquet(os.path.join(folder, f"{n}.parquet")), n) for n in NAMES])


def from_tables(spark: SparkSession, users: str, episodes: str, event_logs: str) -> Inputs:
    """Catalog tables or views, for a log that is ingested elsewhere, held against the declared columns."""
    return Inputs(*[conform(spark.table(t), n) for t, n in zip((users, episodes, event_logs), NAMES)])
