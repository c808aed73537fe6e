"""Timestamps as text, and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a readable timestamp: a full date, then optionally a time, then optionally a zone.
# Group 1 is the wall-clock part. Spark's own cast is wider (it reads "2025", "now" and padded text),
# which would make the malformed flag depend on the engine and even on the day the job runs.
READABLE_TIMESTAMP = (
    r"^([0-9]{4}([-/])[0-9]{1,2}\2[0-9]{1,2}"
    r"(?:[ T][0-9]{1,2}:[0-9]{1,2}(?::[0-9]{1,2}(?:[.][0-9]*)?)?)?)"
    r"(?:(?<=:[0-9.]{1,12})(?: UTC| ?Z| ?[+-][0-9]{2}(?::?[0-9]{2})?))?$"
)
# The spelling nearly every log uses, which needs no rewriting; part of the grammar above.
USUAL_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}$"


def parse_timestamp(text: Column) -> Column:
    """Zone-free timestamp, or null where the text is not one.

    A zone suffix is accepted and dropped: the wall-clock time of the log is kept as written. The full
    grammar, several times as slow, is tried only on what is not spelt in the usual way; no match
    extracts the empty string, which the cast turns into null.
    """
    wall_clock = F.replace(F.regexp_extract(text, READABLE_TIMESTAMP, 1), F.lit("/"), F.lit("-"))
    return F.when(text.rlike(USUAL_TIMESTAMP), text).otherwise(wall_clock).try_cast("timestamp_ntz")


def year_of(day: Column) -> Column:
    return F.year(day).cast("long")


def month_of(day: Column) -> Column:
    return F.month(day).cast("long")


def hour_of(moment: Column) -> Column:
    return F.hour(moment).cast("long")


def day_name(moment: Column) -> Column:
    """Full English name; Spark's `dayname` gives only three letters."""
    return F.date_format(moment, "EEEE")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("long")


def month_index(day: Column) -> Column:
    """Months since year zero, so that differences count calendar months."""
    return (F.year(day) * 12 + F.month(day)).cast("long")
