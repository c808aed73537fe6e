"""The business definitions of a listen, each written once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event types, which of them are listens, and the length buckets with their upper
# bounds in seconds.
EVENT_TYPES = ("play", "pause", "seek", "complete", "download")
LISTEN_TYPES = ("play", "complete")
COMPLETION = "complete"
SHORT_BELOW = 1200
MEDIUM_BELOW = 2700
LENGTH_BUCKETS = ("short", "medium", "long")


def is_listen(event_type: Column) -> Column:
    return event_type.isin(*LISTEN_TYPES)


def length_bucket(seconds: Column) -> Column:
    """A missing length falls through to the last bucket."""
    short, medium, long_ = LENGTH_BUCKETS
    return F.when(seconds < SHORT_BELOW, short).when(seconds < MEDIUM_BELOW, medium).otherwise(long_)


def bucket_rank(bucket: Column) -> Column:
    """Position in the natural order of the buckets; null for anything else."""
    rank = F.lit(None).cast("int")
    for position, name in reversed(list(enumerate(LENGTH_BUCKETS, start=1))):
        rank = F.when(bucket == name, position).otherwise(rank)
    return rank


def capped(seconds: Column, limit: Column) -> Column:
    """Seconds, at most `limit`. `least` skips nulls, so a missing duration has to be kept missing;
    a missing limit leaves the duration as it is."""
    return F.when(seconds.isNotNull(), F.least(seconds, limit))


def ratio(part: Column, whole: Column) -> Column:
    """Double division; null where the whole is zero or missing."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def mean_rate(rate: str, digits: int = 6) -> Column:
    """Unweighted mean of event-level rates. Rounded, because the last digits of a double mean
    depend on the order in which partitions are added up."""
    return F.round(F.avg(rate), digits)
