"""Mixing sources to target weights, with DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import small, stored

#: Exponents tried in one pass over the sources: as many as four halvings of the interval.
TRIED = 16


def _tokens(text: Column) -> Column:
    """Size of a text in tokens, one for every four bytes, one at least."""
    return F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4)).cast("long")


def _powers(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent a: entropy in bits of the normalised p^a, and the most often a source's
    tokens would be repeated if the least repeated were read once (log2 of that).

    One aggregate over the sources, whose single line goes to the driver.
    """
    columns = []
    for a in exponents:
        power = F.pow("share", F.lit(a))
        repeats = F.log2("share") * (a - 1)
        columns += [F.sum(power), F.sum(power * F.lit(a) * F.log2("share")), F.max(repeats), F.min(repeats)]
    row = list(shares.agg(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())
    found = []
    for z, weighted, most, least in zip(*(row[i::4] for i in range(4))):
        found.append((math.log2(z) - weighted / z, most - least))
    return found


def find_exponent(
    shares: DataFrame,
    entropy: float | None = None,
    max_repeats: float | None = None,
    tolerance: float = 1e-9,
) -> float:
    """The exponent in [0, 1] that brings `shares` (share, sums to 1) to the target, by bisection.

    Entropy falls and repetition falls as the exponent grows from 0 (uniform) to 1 (as it is). With
    `entropy` (bits): the exponent at which the normalised p^a has that entropy. With `max_repeats`:
    the least exponent at which no source is read more than that many times as often as the least
    repeated one. With both, the larger of the two. A target out of reach gives the nearer end.
    """

    def enough(a_value: tuple[float, float]) -> bool:
        h, spread = a_value
        return (entropy is None or h <= entropy) and (
            max_repeats is None or spread <= math.log2(max_repeats) + 1e-12
        )

    low, high = 0.0, 1.0
    if enough(_powers(shares, [low])[0]):
        return low
    while high - low > tolerance:
        tried = [low + (high - low) * i / TRIED for i in range(1, TRIED)]
        met = [enough(x) for x in _powers(shares, tried)]
        first = met.index(True) if True in met else len(tried)
        low, high = tried[first - 1] if first else low, tried[first] if first < len(tried) else high
    return high


def mix(
    docs: DataFrame,
    entropy: float | None = None,
    max_repeats: float | None = None,
    budget: int | None = None,
    block_docs: int = 1000,
    seed: int = 0,
    tokens: Column | None = None,
) -> DataFrame:
    """All columns of `docs`, a row for every time a document is drawn, plus tokens, weight, epoch (from
    0), block, and place (its order in the mixture, 0 to 1, at which all sources start and end together).

    Weights are the sources' token shares raised to an exponent and normalised; the exponent is
    bisected until the weights' entropy or the sources' repetition meets the target (`find_exponent`).
    `tokens` says how many tokens a row has, one at least, where a tokenizer has counted them; without it a row
    has one for every four bytes of its text. A source gets `weight * budget` tokens. Without a `budget` it is the smallest one at which each
    source is read whole at least once, so nothing is lost and the scarce sources repeat.

    Each epoch of a source is a permutation of its blocks, which are about `block_docs` documents dealt
    by hash: whole blocks while the budget lasts, and of the block in which it ends, documents in hash
    order as long as the budget is not yet used up when their turn comes. So only the last block of a source
    is ordered by document and shuffled with its texts (all are if the list of blocks is too large to be broadcast),
    and a source that holds a third of all rows is spread over all tasks.

    The order depends on `seed`, doc_id and text only, not on partitions. Null source: a source of its
    own. Null or empty text: a document of one token. Null doc_id and repeated rows: documents of their
    own (equal rows stand next to each other). Empty table: no rows. Columns of `docs` named tokens,
    weight, epoch, block or place are overwritten.
    """
    added = ("tokens", "weight", "epoch", "block", "place")
    size = _tokens(F.col("text")) if tokens is None else F.greatest(F.lit(1), F.coalesce(tokens, F.lit(1))).cast("long")
    sized = docs.withColumn("tokens", size).drop(*added[1:])
    names = [c for c in sized.columns if c != "tokens"]
    by_source = stored(
        sized.groupBy("source").agg(F.sum("tokens").alias("total"), F.count(F.lit(1)).alias("n")), "sources"
    )
    everything = by_source.agg(F.sum("total")).first()[0]
    if everything is None:
        none = {"weight": "double", "epoch": "long", "block": "long", "place": "double"}
        return sized.withColumns({c: F.lit(None).cast(kind) for c, kind in none.items()})
    shares = by_source.withColumn("share", F.col("total") / F.lit(everything).cast("double"))
    a = find_exponent(shares, entropy, max_repeats)
    z, least = shares.agg(F.sum(F.pow("share", F.lit(a))), F.min(F.log2("share") * (a - 1))).first()
    if budget is None:
        # weight * budget = 2^least' * total for the least repeated source, which is read once.
        budget = everything * z / 2.0**least
    plan = shares.select(
        F.col("source").alias("_source"),
        "total",
        (F.pow("share", F.lit(a)) / z).alias("weight"),
        F.greatest(F.lit(1), F.ceil(F.col("n") / block_docs)).alias("_blocks"),
    ).withColumn("_quota", F.round(F.col("weight") * F.lit(budget)).cast("long"))
    # An error of rounding must not start another epoch, nor cut the last document of a whole one.
    plan = plan.withColumn(
        "_epochs", F.greatest(F.lit(1), F.ceil(F.col("_quota") / F.col("total") - F.lit(1e-9))).cast("long")
    ).withColumn(
        "_quota",
        F.when(
            F.abs(F.col("_quota") / F.col("total") - F.round(F.col("_quota") / F.col("total"))) < 1e-9,
            F.round(F.col("_quota") / F.col("total")).cast("long") * F.col("total"),
        ).otherwise(F.col("_quota")),
    )
    plan = stored(plan, "mixture")

    # A document is dealt to a block anew in each epoch.
    same_source = F.col("source").eqNullSafe(F.col("_source"))
    order = F.xxhash64(F.lit(seed), "epoch", "doc_id", "text")
    drawn = (
        sized.join(plan, same_source)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_epochs") - 1)))
        .withColumn("_order", order)
        .withColumn("block", F.pmod(F.xxhash64("_order"), F.col("_blocks")))
    )
    blocks = drawn.groupBy("_source", "epoch", "block").agg(
        F.sum("tokens").alias("_in_block"),
        F.first("_quota").alias("_q"),
    )
    along = Window.partitionBy("_source").orderBy("epoch", F.xxhash64(F.lit(seed), "epoch", "block"), "block")
    blocks = blocks.select(
        F.col("_source").alias("_s"),
        F.col("epoch").alias("_e"),
        F.col("block").alias("_b"),
        (F.sum("_in_block").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_in_block")).alias("_before"),
        "_in_block",
        "_q",
    )
    blocks = small(stored(blocks.where(F.col("_before") < F.col("_q")), "blocks"))
    chosen = drawn.join(
        blocks,
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("epoch") == F.col("_e")) & (F.col("block") == F.col("_b")),
    )
    # In a block that is read whole, a document stands where its hash lies among all hashes, so texts are
    # not moved to be ordered. Only the block in which a source's budget ends is summed document by document.
    is_whole = F.col("_before") + F.col("_in_block") <= F.col("_q")
    share = F.col("_order") / F.lit(2.0**64) + 0.5
    whole = chosen.where(is_whole).withColumn("_at", F.col("_before") + share * F.col("_in_block"))
    within = Window.partitionBy("_s", "_e", "_b").orderBy("_order", "doc_id")
    summed = F.sum("tokens").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")
    cut = chosen.where(~is_whole).withColumn("_at", (F.col("_before") + summed).cast("double"))
    return whole.union(cut.where(F.col("_at") < F.col("_q"))).select(
        *names, "tokens", "weight", "epoch", "block", (F.col("_at") / F.col("_q")).alias("place")
    )
