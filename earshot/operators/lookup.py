"""Left lookup of a dimension from an event-sized frame, safe for hot keys and null keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 64 * 1024 * 1024
HOT_SHARE = 0.001
NULL_SPREAD = 1000


def measured_bytes(df: DataFrame) -> int:
    """Uncompressed size of `df`, counted by one aggregate: text by its length, the rest by width."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    sums = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in text]
    row = df.agg(F.count(F.lit(1)).alias("n"), *[s.alias(f"b{i}") for i, s in enumerate(sums)]).first()
    return row["n"] * 16 * len(df.columns) + sum(row[1:])


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    spread_on: list[str],
    profile: DataFrame | None = None,
    limit: int = BROADCAST_LIMIT,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """`facts` left join `dim` on `key`.

    A dimension whose measured size is within `limit` is broadcast: the facts stay where they are.

    Beyond that both sides are shuffled on (key, salt). `profile` is a cheap frame with the key column
    (say the raw log) that says which keys are hot: those with more than `hot_share` of its rows, so
    at most 1 / hot_share of them. A hot key is cut into as many pieces as it has times that share,
    and its dimension row is repeated once per piece - 2 / hot_share extra rows at most, over all keys.
    Null keys match nothing and are spread without any repetition. The salt is a hash of `spread_on`
    and not a random number, so a task that is run again after a lost executor writes the same rows.

    The result does not depend on the path taken, nor on `profile`.
    """
    if measured_bytes(dim) <= limit:
        return facts.join(F.broadcast(dim), key, "left")

    spread = F.xxhash64(*spread_on)
    no_key = F.col(key).isNull()
    if profile is None:
        salted = facts.withColumn(
            "_salt", F.when(no_key, F.pmod(spread, F.lit(NULL_SPREAD))).otherwise(0).cast("long")
        )
        pieces = dim.withColumn("_salt", F.lit(0).cast("long"))
    else:
        hot = hot_keys(profile.select(key), key, hot_share)
        salted = (
            facts.join(F.broadcast(hot), key, "left")
            .withColumn(
                "_salt",
                F.pmod(
                    spread, F.when(no_key, NULL_SPREAD).otherwise(F.coalesce("_pieces", F.lit(1))).cast("long")
                ),
            )
            .drop("_pieces")
        )
        pieces = (
            dim.join(F.broadcast(hot), key, "left")
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
            .withColumn("_salt", F.col("_salt").cast("long"))
            .drop("_pieces")
        )
    return salted.join(pieces, [key, "_salt"], "left").drop("_salt")


def hot_keys(profile: DataFrame, key: str, share: float) -> DataFrame:
    """Keys holding more than `share` of the rows, with the number of pieces of that size they fill.

    Counted per map task first, so a hot key costs one row per task in the shuffle.
    """
    total = profile.agg(F.count(F.lit(1))).scalar()
    size = F.greatest(F.lit(1), F.floor(total * share)).cast("long")
    return (
        profile.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > size)
        .select(key, F.ceil(F.col("_n") / size).cast("int").alias("_pieces"))
    )
