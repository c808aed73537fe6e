"""Incremental load of the star, from a batch or from a stream of log files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from earshot.operators.versions import NO_DAY, State, publish, read_state
from earshot.plans.star import (
    COPIES,
    EVENT_COLUMNS,
    OWN_COLUMNS,
    Star,
    StoredStar,
    episode_attributes,
    measure,
    rewrite,
    write_derived,
    write_load,
    write_totals,
)
from earshot.sources.inputs import Inputs


def load_increment(batch: Inputs, folder: str, refresh: bool = False) -> State:
    """Add the events of `batch.event_logs` that `folder` does not hold yet, and show them in one step.

    An event's id is a function of its raw content, and so is its day. Loading the same rows again,
    after a failure or in an overlapping batch, therefore adds nothing, and what is already loaded is
    searched in the days the batch touches: partitions between the first and the last of them are read, and
    joined with the days. Late events are found and added whatever their age.

    Everything follows a load in proportion to it. Events are rolled up by user, episode and day, which adds
    rows to those of earlier loads; daily activity and user mart are merged from there when they are
    read (`refresh_tables` writes them down). Episodes that arrived, changed or went since the last load
    are told by comparing the two dimensions; the days on which they have events, known from a table
    of these, are measured again and take the place of the old ones. The dimensions of the batch
    replace the stored ones if they differ.

    Nothing that readers see is touched: all is written to places of this load and named in one small
    file at the end (`earshot.operators.versions`). A load that dies before shows nothing and is made good
    by running it again. One load at a time.
    """
    star = Star(batch)
    spark = batch.users.sparkSession
    state = read_state(spark, folder)
    if state is None:
        new, days, totals = star.counted, [], {}
    else:
        stored = StoredStar(folder, batch, state=state)
        new, days, totals = unknown_events(star, stored), stale_since(stored, star), {}
        if days:
            again, totals = measured_again(stored, star, days)
            new = new.unionByName(again)
    published = write_load(star, new, folder, state, totals, days)
    publish(spark, folder, published)
    return refresh_tables(batch, folder) if refresh else published


def unknown_events(star: Star, stored: StoredStar) -> DataFrame:
    """Events of a batch that the stored star does not hold, measured, with their copies."""
    days = star.flagged_log.select(F.to_date("event_datetime").alias("_day")).distinct()
    searched = stored.classified.where(_within(days))
    searched = searched.join(days, F.col("event_date").eqNullSafe(F.col("_day")), "left_semi")
    new = star.counted
    return new.join(searched.select("event_id"), "event_id", "left_anti").select(*new.columns)


def lost_events(batch: Inputs, folder: str) -> DataFrame:
    """Events of a batch that is loaded and that the star does not hold: none, unless something went wrong.
    Reads the days of the batch only."""
    star = Star(batch)
    return unknown_events(star, StoredStar(folder, batch)).drop(COPIES)


def stale_since(stored: StoredStar, star: Star) -> list[str]:
    """Days with events of episodes of which the dimension of `star` says something else than the stored one.

    Two dimensions are compared, and the days of those episodes looked up; their list, one line a calendar
    day at most, goes to the driver.
    """
    was, now = (
        episode_attributes(s.dim_episodes).select(
            "episode_id", F.struct(*[c for c in episode_attributes(s.dim_episodes).columns if c != "episode_id"]).alias(name)
        )
        for s, name in ((stored, "was"), (star, "now"))
    )
    changed = was.join(now, "episode_id", "full").where(~F.col("was").eqNullSafe(F.col("now")))
    changed = changed.select("episode_id").distinct()
    if changed.isEmpty():
        return []
    days = stored.episode_days.join(changed, "episode_id", "left_semi").select("event_date").distinct()
    return sorted(str(r["event_date"] or NO_DAY) for r in days.collect())


def measured_again(stored: StoredStar, star: Star, days: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """The stored events of `days`, measured with the episodes of `star`, and what the totals lose when these
    take their place. Their raw rows have been counted already."""
    known = F.coalesce(F.col("event_date").isin(*[F.lit(d).cast("date") for d in days if d != NO_DAY]), F.lit(False))
    old = stored.classified.where(known | F.col("event_date").isNull() if NO_DAY in days else known)
    counts = old.agg(*[c.alias(name) for name, c in write_totals().items()]).first().asDict()
    own = old.select(*OWN_COLUMNS)
    again = measure(star.look_up_episodes(own, profile=own)).select(*EVENT_COLUMNS)
    return again.withColumn(COPIES, F.lit(0).cast("long")), {name: -n for name, n in counts.items()}


def refresh_tables(inputs: Inputs, folder: str) -> State:
    """Write daily activity and user mart down for the state that `folder` shows, where many readers come
    between two loads. They are merged from the roll-up, as readers do otherwise."""
    stored = StoredStar(folder, inputs)
    return write_derived(stored, stored.state.version + 1).state


def compact(inputs: Inputs, folder: str) -> State:
    """Write the events that `folder` shows anew as one load, when many small loads have left many small files."""
    stored = StoredStar(folder, inputs)
    return rewrite(stored, stored.classified).state


def stream_increments(
    log: DataFrame,
    dimensions: Inputs,
    folder: str,
    checkpoint: str,
    available_now: bool = True,
    refresh: bool = False,
) -> StreamingQuery:
    """Run `load_increment` on every micro-batch of a streaming log.

    Duplicates are removed against the loaded tables and not by a streaming state with a watermark: a
    copy that arrives after any watermark is still recognised, events without a readable time need no
    special path, and there is no state that grows. A micro-batch that is replayed after a failure
    adds nothing, so the load is exactly-once although file sinks are not transactional.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        load_increment(Inputs(dimensions.users, dimensions.episodes, batch), folder, refresh)

    writer = log.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _within(days: DataFrame) -> Column:
    """Between the first and the last of the days, or without one if the days have a null: a filter on
    the partitions. One line of the batch goes to the driver."""
    first, last, unknown = days.agg(F.min("_day"), F.max("_day"), F.count_if(F.col("_day").isNull())).first()
    known = F.col("event_date").between(first, last) if first is not None else F.lit(False)
    return known | F.col("event_date").isNull() if unknown else known
