"""Removal of lines that many documents share, through a sharded minimal perfect hash."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import by_unit, map_arrow, runs, slices, stored

#: What is stripped from both ends of a line, and which letters are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: Bits a level of the hash has for each of its keys.
ROOM = 2.0


def line_key(line: str, least: int) -> tuple[int, int] | None:
    """128 bits of the line's key as two signed numbers, None if the key is shorter than `least`."""
    key = line.strip(BLANKS)
    if len(key) < least:
        return None
    both = xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").translate(LOWER))
    return int.from_bytes(both[:8], "little", signed=True), int.from_bytes(both[8:], "little", signed=True)


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_hash(keys: np.ndarray) -> list[np.ndarray]:
    """A minimal perfect hash of distinct 64-bit keys: a bit array for each level.

    A key takes the bit its hash names; keys that meet on a bit go to the next level. The number of
    set bits before a key's own is its place, 0 to n - 1.
    """
    levels = []
    while len(keys):
        room = max(64, int(len(keys) * ROOM) + 7 & ~7)
        at = (_mixed(keys, len(levels)) % np.uint64(room)).astype(np.int64)
        hits = np.bincount(at, minlength=room)
        levels.append(np.packbits(hits == 1))
        keys = keys[hits[at] > 1]
        if len(levels) > 200:
            raise ValueError("the keys are not distinct")
    return levels


def places(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Place of every key; -1 for some that were not among those hashed, any place for the others."""
    out = np.full(len(keys), -1, dtype=np.int64)
    left = np.arange(len(keys))
    before = 0
    for level, packed in enumerate(levels):
        if not len(left):
            break
        bits = np.unpackbits(packed)
        at = (_mixed(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
        found = bits[at] == 1
        rank = np.cumsum(bits, dtype=np.int64) - 1
        out[left[found]] = before + rank[at[found]]
        before += int(rank[-1]) + 1
        left = left[~found]
    return out


def line_keys(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, key, print): a row for each distinct key of at least `least` code points in a row's text."""

    def run(batches):
        for batch in slices(batches, "text", 8 << 20):
            rows, keys = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                own = {k for line in (text or "").split("\n") if len(line) >= least and (k := line_key(line, least))}
                rows += [row] * len(own)
                keys += own
            yield (
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                [k[0] for k in keys],
                [k[1] for k in keys],
            )

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, key long, print long")


def build_index(keys: DataFrame, least_docs: int, shard_keys: int = 20_000) -> tuple[DataFrame, int]:
    """A row per shard: levels of its hash, and by place the fingerprint, the number of documents and
    the largest doc_id of each key found in at least `least_docs` documents; and the number of shards.

    Keys are dealt to shards by their hash, so shards are even and as many as the keys need. Copies of
    a key merge in the map tasks first, so that a line in every document costs a row a task.
    """
    spark = keys.sparkSession
    common = stored(
        keys.groupBy("key", "print")
        .agg(F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("owner"))
        .where(F.col("n_docs") >= least_docs),
        "lines",
    )
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_shards = max(4 * least, -(-common.count() // shard_keys))

    def run(batches):
        for table in runs(batches, "shard"):
            key, *rest = (np.asarray(table.column(c)) for c in ("key", "print", "n_docs", "owner"))
            # Two keys that share 64 bits go by the larger count: once in 2^64 pairs, and the print decides.
            order = np.lexsort((-rest[1], key))
            order = order[np.append(True, key[order][1:] != key[order][:-1])]
            hashed = key[order].view(np.uint64)
            levels = build_hash(hashed)
            at = places(levels, hashed)
            arrays = []
            for values, kind in zip(rest, ("<i8", "<u4", "<i8")):
                array = np.empty(len(order), kind)
                array[at] = values[order]
                arrays.append([array.tobytes()])
            yield [table.column("shard")[0].as_py()], [[x.tobytes() for x in levels]], *arrays

    dealt = by_unit(common.withColumn("shard", F.pmod("print", F.lit(n_shards))), "shard")
    schema = "shard long, levels array<binary>, prints binary, counts binary, owners binary"
    return stored(map_arrow(dealt, run, schema), "line-index"), n_shards


def probe(keys: DataFrame, index: DataFrame, n_shards: int, most: int = 100_000) -> DataFrame:
    """(doc_id, drops): per document the keys that the index gives to another document.

    A document's keys go to their shards; a shard that many documents ask is copied for every quarter of a
    task's even share of the askers, and for every `most` of them, as the counts in its own array tell. So no shard
    and no line, however common, is met by more than about that many rows in a task.
    """
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    piece = max(100, min(most, keys.count() // (4 * tasks)))

    def slots(batches):
        for batch in batches:
            sums = [int(np.frombuffer(x, "<u4").sum(dtype=np.int64)) for x in batch.column("counts").to_pylist()]
            yield batch.column("shard"), [1 + n // piece for n in sums]

    # A row of two numbers for each 20,000 common keys.
    copies = map_arrow(index.select("shard", "counts"), slots, "shard long, copies long")
    spread = F.pmod(F.xxhash64("doc_id"), F.col("copies"))
    asked = (
        keys.withColumn("shard", F.pmod("print", F.lit(n_shards)))
        .join(copies, "shard")
        .select(F.xxhash64("shard", spread).alias("unit"), F.lit(1).alias("asks"), "doc_id", "key", "print")
    )
    held = (
        index.join(copies, "shard")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .select(F.xxhash64("shard", "copy").alias("unit"), F.lit(0).alias("asks"), "levels", "prints", "owners")
    )

    def run(batches):
        for table in runs(batches, "unit"):
            table = table.combine_chunks()
            if table.column("asks")[0].as_py() or table.num_rows == 1:
                continue
            levels, prints, owners = (table.column(c)[0].as_py() for c in ("levels", "prints", "owners"))
            table = table.slice(1)
            docs = table.column("doc_id")
            key = np.asarray(table.column("key"))
            at = places([np.frombuffer(x, np.uint8) for x in levels], key.view(np.uint64))
            known = at >= 0
            known[known] = np.frombuffer(prints, "<i8")[at[known]] == np.asarray(table.column("print"))[known]
            owner = np.frombuffer(owners, "<i8")[np.where(known, at, 0)]
            mine = pa.compute.fill_null(pa.compute.equal(docs, pa.array(owner)), False)
            lost = known & ~np.asarray(mine)
            if lost.any():
                yield docs.combine_chunks().filter(pa.array(lost)), key[lost]

    both = asked.unionByName(held, allowMissingColumns=True)
    return map_arrow(by_unit(both, "unit", "asks"), run, "doc_id long, key long")


def dedup_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """All columns of `docs` with the lines that many documents share dropped from `text`, plus
    n_lines (before) and n_dropped.

    Lines are split at \\n. A line's key is the line without the white space of ASCII at either end,
    A-Z lower-cased. A key of at least `least_chars` code points found in at least `least_docs`
    documents loses all its lines except in the largest doc_id that holds it.

    Null or empty text: one empty line, text stays as it is. Rows with equal doc_id count as one
    document and are treated alike. Null doc_id: counts as no document and never keeps a common line.
    Empty table: no rows. Columns `drops`, `n_lines` and `n_dropped` of `docs` are overwritten.
    """
    docs = docs.drop("drops", "n_lines", "n_dropped")
    keys = stored(line_keys(docs, least_chars), "line-keys")
    index, n_shards = build_index(keys, least_docs)
    drops = (
        probe(keys, index, n_shards)
        .groupBy("doc_id")
        .agg(F.collect_set("key").alias("drops"))
        .select(F.col("doc_id").alias("_doc_id"), "drops")
    )
    joined = docs.join(drops, F.col("doc_id").eqNullSafe(F.col("_doc_id")), "left").drop("_doc_id")
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        for batch in slices(batches, "text", 8 << 20):
            texts, lines, lost = [], [], []
            for text, drop in zip(batch.column("text").to_pylist(), batch.column("drops").to_pylist()):
                if not drop:
                    texts.append(text)
                    lines.append((text or "").count("\n") + 1)
                    lost.append(0)
                    continue
                gone = set(drop)
                split = (text or "").split("\n")
                kept = [x for x in split if not ((k := line_key(x, least_chars)) and k[0] in gone)]
                texts.append("\n".join(kept))
                lines.append(len(split))
                lost.append(len(split) - len(kept))
            yield (*(texts if c == "text" else batch.column(c) for c in names), lines, lost)

    return map_arrow(joined.select(*names, "drops"), run, f"{schema}, n_lines long, n_dropped long")


def lines_digest(deduped: DataFrame) -> DataFrame:
    """The texts that are left as checksums."""
    return deduped.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def reference_digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
