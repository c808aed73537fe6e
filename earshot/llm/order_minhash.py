"""Near-duplicate documents by order MinHash, verified by banded alignment."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import by_unit, components, cross_counted, map_arrow, runs, slices, small, stored, with_key, without

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: Bins of the one-permutation signature by which far pairs are told without their texts.
BINS = 512

#: How far below the threshold the signature's estimate of a pair may lie: over four standard errors.
SLACK = 0.08


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def normalized(text: str | None) -> bytes:
    """The words of a text, A-Z lower-cased, with one blank between."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(LOWER).split())


BASE = 0x9E3779B97F4A7C15
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    out = []
    for base in (BASE, pow(BASE, -1, 2**64)):
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def labelled_kmers(joined: bytes, k: int) -> np.ndarray:
    """A 64-bit hash for each run of `k` words of a normalized text, in text order; the hash tells the
    first, second, ... occurrence of a run apart, so no two are equal. A text of fewer words is one run."""
    if not joined:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(joined, np.uint8)
    power, inverse = _powers(1 << max(10, len(raw).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[raw] * power[: len(raw)], dtype=np.uint64)])
    blanks = np.flatnonzero(raw == 32)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.concatenate([blanks, [len(raw)]])
    if len(starts) > k:
        starts, ends = starts[: len(starts) - k + 1], ends[k - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    plain = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    order = np.argsort(plain, kind="stable")
    ranked = plain[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    if new.all():
        return plain
    at = np.arange(len(plain))
    first = np.maximum.accumulate(np.where(new, at, 0))
    label = np.empty(len(plain), np.uint64)
    label[order] = (at - first).astype(np.uint64)
    return np.where(label > 0, mixed(plain + label * np.uint64(BASE)), plain)


def sketch(kmers: np.ndarray, sketches: int, length: int) -> np.ndarray:
    """Order MinHash: for each of `sketches` orders the `length` smallest labelled k-mers, hashed
    together in the order in which they stand in the text."""
    chosen = np.zeros((length, sketches), np.uint64)
    for s in range(sketches):
        if len(kmers) > length:
            ranks = mixed(kmers ^ np.uint64((s + 1) * 0xD6E8FEB86659FD93 & (2**64 - 1)))
            chosen[:, s] = kmers[np.sort(np.argpartition(ranks, length - 1)[:length])]
        else:
            chosen[: len(kmers), s] = kmers
    out = np.arange(1, sketches + 1, dtype=np.uint64)
    for values in chosen:
        out = mixed(out * np.uint64(BASE) + values)
    return out


def signature(kmers: np.ndarray) -> bytes:
    """The smallest hash of each of BINS bins as a byte from 1 to 255, 0 for an empty bin."""
    hashed = np.sort(mixed(kmers ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    bins = (hashed >> np.uint64(55)).astype(np.int64)
    first = np.append(True, bins[1:] != bins[:-1])
    out = np.zeros(BINS, np.uint8)
    out[bins[first]] = hashed[first] % np.uint64(255) + np.uint64(1)
    return out.tobytes()


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the k-mers, estimated from signatures row by row."""
    filled = ((a > 0) | (b > 0)).sum(axis=1)
    return ((a == b) & (a > 0)).sum(axis=1) / np.maximum(filled, 1)


def alignment(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Share of the labelled k-mers of either text that a banded alignment matches in the same order.

    With n and m k-mers, M of them matched, it is M / (n + m - M): the Jaccard similarity if the order is
    the same. Reaching `least` leaves (n + m) (1 - least) / (1 + least) k-mers unmatched at most, and
    two matched ones stand no farther apart than that, which bounds the band. A result below `least`
    is only known to be below it.
    """
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return 0.0
    common, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(common) < least * (n + m - len(common)):
        return 0.0
    band = int((n + m) * (1 - least) / (1 + least)) + 1
    inside = np.abs(at_a - at_b) <= band
    order = np.argsort(at_a[inside], kind="stable")
    path = at_b[inside][order]
    # Each k-mer is matched with one place at most, so the best alignment is the longest rising chain.
    if len(path) and (path[1:] > path[:-1]).all():
        matched = len(path)
    else:
        tails: list[int] = []
        for x in path.tolist():
            at = bisect_left(tails, x)
            tails[at : at + 1] = [x]
        matched = len(tails)
    return matched / (n + m - matched)


def _sketched(docs: DataFrame, k: int, sketches: int, length: int) -> DataFrame:
    """(doc_id, digest, keys, signature): keys and signature null for a text without words."""
    def run(batches):
        for batch in slices(batches, "text", 4 << 20):
            digests, keys, signatures = [], [], []
            for text in batch.column("text").to_pylist():
                joined = normalized(text)
                kmers = labelled_kmers(joined, k)
                some = len(kmers) > 0
                digests.append(hashlib.blake2b(joined, digest_size=16).digest() if some else None)
                keys.append(sketch(kmers, sketches, length).view(np.int64) if some else None)
                signatures.append(signature(kmers) if some else None)
            yield batch.column("doc_id"), digests, keys, signatures

    return map_arrow(
        docs.select("doc_id", "text"), run, "doc_id long, digest binary, keys array<long>, signature binary"
    )


def _verified(asked: DataFrame, texts: DataFrame, k: int, least: float) -> DataFrame:
    """Of the pairs `asked` (a, b) those whose texts align, as (a, b, similarity).

    All pairs of one b meet in pieces of some hundred, each with b's text once, so a text that very many
    others are compared with is spread over tasks.
    """
    piece = 256
    counted = asked.groupBy("b").agg(F.count(F.lit(1)).alias("_n")).withColumn("_n", F.ceil(F.col("_n") / piece))
    members = asked.join(counted, "b").select(
        F.col("a").alias("_id"),
        F.xxhash64("b", F.pmod(F.xxhash64("a"), F.col("_n"))).alias("unit"),
        F.lit(1).alias("side"),
    )
    leaders = counted.withColumn("_slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).select(
        F.col("b").alias("_id"), F.xxhash64("b", "_slot").alias("unit"), F.lit(0).alias("side")
    )
    # Both sides grow with the input, so neither is broadcast.
    both = members.union(leaders).hint("merge")
    rows = texts.select(F.col("doc_id").alias("_id"), "text").join(both, "_id")

    def run(batches):
        for table in runs(batches, "unit"):
            ids, sides = table.column("_id").to_pylist(), table.column("side").to_pylist()
            leader, own = [], None
            found: list[tuple] = []
            for id_, side, text in zip(ids, sides, table.column("text")):
                kmers = labelled_kmers(normalized(text.as_py()), k)
                if side == 0:
                    own = id_
                    leader.append(kmers)
                    continue
                share = max((alignment(kmers, x, least) for x in leader), default=0.0)
                if share >= least:
                    found.append((id_, own, share))
            if found:
                yield tuple(zip(*found))

    return map_arrow(by_unit(rows, "unit", "side"), run, "a long, b long, similarity double")


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    least: float = 0.8,
    sketches: int = 16,
    length: int = 3,
    block: int = 512,
) -> DataFrame:
    """(doc_id, class_id): the smallest doc_id of each document's group of near duplicates.

    Two documents are linked if their alignment (see there) over runs of `k` words reaches `least`.
    Candidates share one of `sketches` order MinHashes of `length` occurrence-labelled k-mers in text
    order: at a similarity s of the k-mers a pair is missed with probability (1 - s^length)^sketches,
    2 in 100,000 at 0.8. Candidates are reduced without losing a link between groups:

    1. Documents equal after normalizing are one.
    2. In every bucket all members are compared with the smallest; groups follow from the links found.
    3. In a bucket whose members are in several groups, signatures of members of different groups are
       compared, in blocks of bounded size. Pairs whose signature of 512 bins puts them far below
       `least` need no texts. Of the others a block names those that would join its groups with the
       fewest comparisons, the likeliest first; they are aligned, and groups follow.
    4. What still lies in different groups is aligned, pair by pair.

    So a group of copies costs about one comparison a copy, not one a pair.

    Null, empty and blank texts have no words and are groups of their own. Texts of fewer than `k` words
    are compared whole. Rows with equal doc_id are one document. Null doc_id: class_id is null, the
    row is compared with nothing. Empty table: no rows. Other columns are ignored. One row comes out for
    each row of `docs`.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    drawn = stored(_sketched(known, k, sketches, length), "sketches")
    worded = drawn.where(F.col("digest").isNotNull())
    # Keys and signature of equal texts are equal.
    copies = worded.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys"), F.first("signature").alias("signature")
    )
    copies = stored(copies, "copies")
    repeated = small(copies.where(F.col("n") > 1).select("digest", "rep"))
    same = worded.select("doc_id", "digest").join(repeated, "digest").where("doc_id != rep")
    same = same.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    reps = copies.select("rep", "keys", "signature")
    entries = reps.select("rep", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).where("first != last")
    members = stored(entries.join(shared.select("key", "first"), "key"), "buckets")

    asked = members.select(F.col("rep").alias("doc_id")).distinct().hint("merge")
    texts = stored(known.select("doc_id", "text").join(asked, "doc_id", "left_semi"), "texts")
    star = members.where("rep != first").select(F.col("rep").alias("a"), F.col("first").alias("b")).distinct()
    star = stored(star, "star")
    links = stored(_verified(star, texts, k, least).select("a", "b"), "links")
    groups = components(links.union(same))
    tested = star
    for spanning in (True, False):
        pairs = _across_groups(members, groups, reps, tested, least, block, spanning)
        links = stored(_verified(pairs, texts, k, least).select("a", "b"), "links")
        # Each id with the smallest of its group stands for all links found before.
        groups = components(links.union(groups.select("id", "component").where("id != component")))
        tested = tested.union(pairs)
    every = groups.select(F.col("id").alias("_id"), "component")
    return (
        docs.select("doc_id")
        .join(every, F.col("doc_id") == F.col("_id"), "left")
        .select("doc_id", F.coalesce("component", "doc_id").alias("class_id"))
    )


def _joining(order: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Of the pairs (a, b), taken in `order`, those that join what no pair before them has joined."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = root[x]
        return x

    taken = []
    for at in order.tolist():
        low, high = top(int(a[at])), top(int(b[at]))
        if low != high:
            root[high] = low
            taken.append(at)
    return taken


def _across_groups(
    members: DataFrame,
    groups: DataFrame,
    reps: DataFrame,
    tested: DataFrame,
    least: float,
    block: int,
    spanning: bool,
) -> DataFrame:
    """(a, b): candidates of different groups that share a bucket and were not `tested`, as far as their
    signatures allow `least`; with `spanning` only those that would join the groups of a block."""
    grouped = members.select("key", "rep").join(groups, F.col("rep") == F.col("id"), "left")
    grouped = stored(grouped.select("key", "rep", F.coalesce("component", "rep").alias("grp")), "grouped")
    # A key's largest group, and how many rows are in it and in its other groups.
    counted = grouped.groupBy("key", "grp").agg(F.count(F.lit(1)).alias("n")).groupBy("key")
    counted = counted.agg(F.max(F.struct("n", "grp")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("groups"))
    split = counted.where("groups > 1").select(
        "key", F.col("top.grp").alias("top"), F.col("top.n").alias("mains"), (F.col("n") - F.col("top.n")).alias("rest")
    )
    rows = with_key(grouped, split, "key")
    units = cross_counted(rows, "key", F.col("grp") == F.col("top"), "mains", "rest", F.xxhash64("rep"), block)
    marks = reps.select(F.col("rep").alias("_rep"), "keys", "signature")
    rows = units.join(marks, F.col("rep") == F.col("_rep")).select("unit", "side", "key", "rep", "grp", "keys", "signature")

    def run(batches):
        for table in runs(batches, "unit"):
            side = np.asarray(table.column("side"))
            rep, grp = (np.asarray(table.column(c)) for c in ("rep", "grp"))
            keys = np.stack([np.asarray(x.values) for x in table.column("keys").combine_chunks()])
            marks = np.stack([np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("signature").combine_chunks()])
            here = int(np.flatnonzero((keys == table.column("key")[0].as_py()).all(axis=0))[0])
            chosen: list[tuple[np.ndarray, ...]] = []
            for i in np.flatnonzero(side != 1):
                right = np.flatnonzero(side == 1) if side[i] == 0 else np.flatnonzero((side == 2) & (rep > rep[i]))
                right = right[grp[right] != grp[i]]
                # A pair is looked at in the first bucket that it shares.
                right = right[~(keys[right, :here] == keys[i, :here]).any(axis=1)]
                likely = estimate(marks[right], marks[i : i + 1])
                near = likely >= least - SLACK
                if near.any():
                    chosen.append((likely[near], np.full(near.sum(), i), right[near]))
            if chosen:
                likely, i, j = (np.concatenate(x) for x in zip(*chosen))
                if spanning:
                    take = _joining(np.argsort(-likely, kind="stable"), grp[i], grp[j])
                    i, j = i[take], j[take]
                yield np.maximum(rep[i], rep[j]), np.minimum(rep[i], rep[j])

    pairs = map_arrow(by_unit(rows, "unit"), run, "a long, b long").distinct()
    return stored(pairs.join(tested, ["a", "b"], "left_anti"), "rest")


def duplicate_classes(docs: DataFrame, **options) -> DataFrame:
    """A row per document: doc_id, class_id, and kept for the one document of each group that stays."""
    return near_duplicates(docs, **options).withColumn("kept", F.col("class_id").eqNullSafe(F.col("doc_id")))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """`docs` without the documents of which a near duplicate with a smaller doc_id stays.

    Rows with a null doc_id stay; of equal rows with one doc_id all stay.
    """
    return without(docs, duplicate_classes(docs, **options).where(~F.col("kept")), "doc_id")
