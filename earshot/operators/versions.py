"""One visible state of a folder of tables.

A load writes beside what is there, into places of its own number, and names them in one small file that
is replaced last. A reader sees the state that the file named when it looked, whole, however a load that
is under way ends; what a load that died has left is not named anywhere and is written over by the next.
There is one writer at a time.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

POINTER = "current"

#: The key of rows without a day.
NO_DAY = ""


@dataclass(frozen=True)
class State:
    """`version`: the last load. `first`: loads before it were replaced as a whole. `tables`: for tables that
    are written as a whole, the load that wrote them. `days`: for days that were written anew, the load
    from which on their rows count. `totals`: what was counted while writing."""

    version: int
    first: int = 1
    tables: dict[str, int] = field(default_factory=dict)
    days: dict[str, int] = field(default_factory=dict)
    totals: dict[str, int] = field(default_factory=dict)

    def visible(self, load: Column, day: Column) -> Column:
        """A filter on the partitions of a table that grows by loads."""
        shown = load.between(self.first, self.version)
        by_load: dict[int, list[str]] = {}
        for name, since in self.days.items():
            by_load.setdefault(since, []).append(name)
        for since, names in by_load.items():
            among = F.coalesce(day.isin(*[F.lit(n).cast("date") for n in names if n != NO_DAY]), F.lit(False))
            if NO_DAY in names:
                among |= day.isNull()
            shown &= ~(among & (load < since))
        return shown


def _pointer(spark: SparkSession, folder: str):
    """The pointer's path, qualified, and its file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(folder, POINTER))
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(target), system


def read_state(spark: SparkSession, folder: str) -> State | None:
    """The state that `folder` shows now, None before anything was published."""
    target, system = _pointer(spark, folder)
    if not system.exists(target):
        return None
    line = spark.read.text(target.toString(), wholetext=True).first()
    return State(**json.loads(line["value"]))


def publish(spark: SparkSession, folder: str, state: State) -> None:
    """Make `state` the one that readers see: a file is written under another name and renamed over the
    old one, which file systems with a rename do in one step."""
    files, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    target, system = _pointer(spark, folder)
    draft = files.Path(target.getParent(), f"_{POINTER}-{uuid.uuid4().hex}")
    out = system.create(draft, True)
    out.write(json.dumps(asdict(state)).encode())
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(files.Options.Rename, 1)
    overwrite[0] = files.Options.Rename.OVERWRITE
    files.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, overwrite)
