"""Small hand-made inputs."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from earshot import Inputs, Star
from earshot.sources.inputs import EPISODES, EVENT_LOG, USERS

ANN, BOB, CY = ("ann", "2024-01-01", "DE"), ("bob", "2024-02-10", "IE"), ("cy", "2024-03-31", "DE")
SHORT = ("e1", "p1", "One", "2024-03-01", 600)
MEDIUM = ("e2", "p1", "Two", "2024-03-02", 1200)
LONG = ("e3", "p2", "Three", "2024-03-03", 3600)


def event(kind="play", user="ann", episode="e1", at="2024-03-05T10:00:00", seconds=300):
    if kind not in ("play", "complete") and seconds == 300:
        seconds = None
    return kind, user, episode, at, seconds


def inputs(spark, events, users=(ANN, BOB, CY), episodes=(SHORT, MEDIUM, LONG)) -> Inputs:
    return Inputs(
        spark.createDataFrame(list(users), USERS),
        spark.createDataFrame(list(episodes), EPISODES),
        spark.createDataFrame(list(events), EVENT_LOG),
    )


def star(spark, events, **dimensions) -> Star:
    return Star(inputs(spark, events, **dimensions))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan_of(df, mode="formatted"):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()
