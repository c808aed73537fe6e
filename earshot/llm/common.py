"""What several operators share: written intermediates, Arrow streams, blocks of pairs, components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from earshot.operators.lookup import BROADCAST_LIMIT, lookup_join, measured_bytes
from earshot.session import shared_folder

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed on the executors."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", PACKAGE_ROOT)


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared folder and read back: later steps neither repeat its work nor depend
    on the executor that did it, and the planner knows its size."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """A written table, marked for broadcast if its measured size is within `limit`."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def without(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of `docs` whose `key` is not among `ids`; null keys stay. The ids are written and measured
    first: while they are few, `docs` is not shuffled to drop them."""
    return docs.join(small(stored(ids.select(key).distinct(), "dropped")), key, "left_anti")


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str):
    """`mapInArrow` whose function yields (column, ...) tuples of arrays in the order of `schema`."""
    importable(df.sparkSession)
    fields = T.StructType.fromDDL(schema)
    target = to_arrow_schema(fields)

    def run(batches):
        for columns in function(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, target)], schema=target
            )

    return df.mapInArrow(run, fields)


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose `column` holds about `most_bytes` at most, one row at least."""
    for batch in batches:
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows sorted by `key`, cut into one table for each value of it."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(key))
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, stop in zip(cuts, cuts[1:]):
            if held and keys[start] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = keys[start]
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def by_unit(df: DataFrame, unit: str, *order: str) -> DataFrame:
    """Rows of one `unit` next to each other in one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, unit).sortWithinPartitions(unit, *order)


def with_key(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """`rows` whose key is in `table`, which has one row a key, with its columns. The table is written and measured; while
    it is small the rows stay where they are, beyond that hot keys are cut into pieces."""
    known = stored(table, "keys").withColumn("_known", F.lit(True))
    others = [c for c in rows.columns if c != key]
    return lookup_join(rows, known, key, spread_on=others, profile=rows).where("_known").drop("_known")


def cross_blocks(rows: DataFrame, key: str, main: Column, spread: Column, size: int) -> DataFrame:
    """Units of at most 2 * `size` rows such that two rows of one key meet in exactly one unit, unless
    both are `main`; those need not meet. A group of any size is thereby cut into bounded pieces.

    Adds `unit` (what to gather on) and `side` (two blocks meet: 0 or 1; rows of a block among
    themselves: 2). Keys where no pair has to meet vanish.
    """
    flagged = rows.withColumn("_main", main)
    sizes = flagged.groupBy(key).agg(
        F.sum(F.col("_main").cast("long")).alias("_m"), F.sum((~F.col("_main")).cast("long")).alias("_r")
    )
    sizes = sizes.where((F.col("_r") > 0) & (F.col("_m") + F.col("_r") > 1))
    units = cross_counted(with_key(flagged, sizes, key), key, F.col("_main"), "_m", "_r", spread, size)
    return units.select(*rows.columns, "unit", "side")


def cross_counted(rows: DataFrame, key: str, main: Column, mains: str, rest: str, spread: Column, size: int) -> DataFrame:
    """`cross_blocks` of rows that know how many rows of their key are main (`mains`) and how many are not (`rest`)."""
    # Blocks are numbered with those of the main rows first.
    joined = (
        rows.withColumn("_mb", F.ceil(F.col(mains) / size).cast("long"))
        .withColumn("_rb", F.ceil(F.col(rest) / size).cast("long"))
        .withColumn(
            "_own",
            F.when(main, F.pmod(spread, F.greatest("_mb", F.lit(1)))).otherwise(
                F.col("_mb") + F.pmod(spread, F.greatest("_rb", F.lit(1)))
            ),
        )
    )
    first = F.when(main, F.col("_mb")).otherwise(F.lit(0).cast("long"))
    met = joined.withColumn("_other", F.explode(F.sequence(first, F.col("_mb") + F.col("_rb") - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    return met.select(
        *rows.columns,
        F.xxhash64(F.col(key), low, high).alias("unit"),
        F.when(low == high, 2).when(F.col("_own") == low, 0).otherwise(1).cast("int").alias("side"),
    )


#: Ids of which a task remembers at a time what holds them together.
FOREST = 1 << 18


def forest(edges: DataFrame) -> DataFrame:
    """Edges (x, y), x > y, that hold together what the edges (a, b) do: each task replaces its rows by an edge from
    each id to the smallest one that it reaches over them. No shuffle; a task that has met FOREST ids begins anew."""
    def run(batches):
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = root[up]
                x = root[x]
            return x

        def held():
            joined = [(x, low) for x in root if (low := top(x)) != x]
            return [tuple(zip(*joined))] if joined else []

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                low, high = sorted((top(a), top(b)))
                root[high] = low
            if len(root) > FOREST:
                yield from held()
                root.clear()
        yield from held()

    return map_arrow(edges, run, "x long, y long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over `edges` (a, b), for every id with an edge.

    Each task first joins what its own rows hold together (`forest`), which leaves an id with one smaller id beside
    it for every FOREST ids a task met. In each round these come together by id in one aggregate, merged in
    the map tasks; the id and they go to the smallest of them (small star), or to the smallest one beside
    that (large star), by a lookup that is safe for hubs. It ends when every id has one smaller id beside
    it or only larger ones. Nothing is collected but one number a round.
    """
    current = stored(forest(edges.select("a", "b").where("a != b")), "edges")
    for _ in range(rounds):
        current = stored(forest(current.toDF("a", "b")), "edges")
        ends = current.select(F.col("x").alias("id"), "y", F.lit(False).alias("larger")).union(
            current.select(F.col("y").alias("id"), F.lit(None).cast("long"), F.lit(True))
        )
        ends = ends.groupBy("id").agg(F.collect_set("y").alias("lower"), F.max("larger").alias("larger"))
        ends = stored(ends.withColumn("least", F.array_min("lower")), "ends")
        if not ends.agg(F.count_if(F.expr("size(lower) > 1 or (size(lower) = 1 and larger)"))).first()[0]:
            return ends.select("id", F.coalesce("least", "id").alias("component"))
        small_star = ends.select("id", "least", F.explode("lower").alias("y")).select(
            F.when(F.col("y") == F.col("least"), F.col("id")).otherwise(F.col("y")).alias("x"), F.col("least").alias("y")
        )
        beside = ends.where("larger").select(F.col("id").alias("y"), "least")
        found = lookup_join(small_star, beside, "y", spread_on=["x"], profile=small_star)
        current = found.select("x", F.coalesce("least", "y").alias("y"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")
