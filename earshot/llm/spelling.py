"""Spelling variants: edits of every word probed against Bloom filters, and the hits joined exactly."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import by_unit, map_arrow, runs, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of this length and longer share their filters.
LONG = 64
#: Bits of a block, bits of a block that a word sets, and bits that a filter has for each word.
BLOCK, SET, PER_WORD = 512, 6, 16

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)


def corpus_words(docs: DataFrame, least_chars: int = 7, least_count: int = 2, damage: int = 0) -> DataFrame:
    """(word, n): the words of whole texts of `docs` (doc_id, text) and how often they come.

    Words are maximal runs of `[A-Za-zÀ-ÿ]`, A-Z lower-cased, of `least_chars` code points or more that
    come `least_count` times or more. With `damage`, one in so many runs loses a letter, chosen by the
    crc32 of `<doc_id>:<run>` (a null doc_id is empty there), before it is counted: known errors to find.
    Null text: no words. Words are counted in the map tasks first.
    """
    # Deleting makes a run shorter only, so shorter runs need not be looked at.
    pattern = F.lit(f"[A-Za-zÀ-ÿ]{{{least_chars},}}")
    run = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), pattern, F.lit(0)))
    words = docs.select("doc_id", run.alias("word"))
    if damage:
        hashed = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")))
        shorter = "concat(substring(word, 1, int(h % length(word))), substring(word, int(h % length(word)) + 2))"
        words = words.withColumn("h", hashed).select(
            F.when(F.col("h") % damage == 0, F.expr(shorter)).otherwise(F.col("word")).alias("word")
        )
    words = words.where(F.char_length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(size: int, base: int = BASE) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def letters(words: list[str], length: int) -> np.ndarray:
    """A row of code points for each word; all have `length`."""
    raw = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    return raw.reshape(len(words), length).astype(np.uint64)


def finished(sums: np.ndarray, length: int) -> np.ndarray:
    """Hashes of words from the sums of their letters times powers of BASE."""
    return mixed(sums + np.uint64(length * 0xD6E8FEB86659FD93 & (2**64 - 1)))


def word_hashes(words: list[str], length: int) -> np.ndarray:
    return finished((letters(words, length) * _powers(length)).sum(axis=1, dtype=np.uint64), length)


def of_length(words: list[str]) -> dict[int, np.ndarray]:
    """Length -> places in `words`."""
    sizes = np.array([len(w) for w in words], np.int64)
    return {int(n): np.flatnonzero(sizes == n) for n in np.unique(sizes)}


class Filters:
    """Blocked Bloom filters, one for each (length, part): `shards` maps these to their bits. A word is
    looked for in one block of one filter; words of filters that are not there are reported as absent."""

    def __init__(self, parts: dict[int, int], shards: dict[tuple[int, int], bytes]):
        self.parts = parts
        self.first = {n: np.full(p, -1, np.int64) for n, p in parts.items()}
        self.blocks = {n: np.zeros(p, np.uint64) for n, p in parts.items()}
        at = 0
        for (n, part), bits in shards.items():
            self.first[n][part], self.blocks[n][part] = at, len(bits) * 8 // BLOCK
            at += len(bits) * 8 // BLOCK
        self.bits = np.frombuffer(b"".join(shards.values()), np.uint8)

    def may_have(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Places in `hashes` (of words of `length`) that the filters do not rule out."""
        n = min(length, LONG)
        if n not in self.parts:
            return np.zeros(0, np.int64)
        part = part_of(hashes, self.parts[n])
        first = self.first[n][part]
        left = np.flatnonzero(first >= 0)
        if not len(left):
            return left
        if len(left) < len(hashes):
            hashes, part, first = hashes[left], part[left], first[left]
        start = (first + block_of(hashes, self.blocks[n][part])) * BLOCK
        inside = mixed(hashes ^ np.uint64(BASE))
        for i in range(SET):
            bit = start + bit_of(inside, i)
            hit = np.flatnonzero((self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
            left, start, inside = left[hit], start[hit], inside[hit]
        return left


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)


def block_of(hashes: np.ndarray, blocks) -> np.ndarray:
    return (((hashes & np.uint64(0xFFFFFFFF)) * blocks) >> np.uint64(32)).astype(np.int64)


def bit_of(inside: np.ndarray, i: int) -> np.ndarray:
    return ((inside >> np.uint64(9 * i)) & np.uint64(BLOCK - 1)).astype(np.int64)


def build(hashes: np.ndarray) -> bytes:
    """The bits of a filter that has `hashes`."""
    blocks = max(1, -(-len(hashes) * PER_WORD // BLOCK))
    bits = np.zeros(blocks * BLOCK, bool)
    start, inside = block_of(hashes, np.uint64(blocks)) * BLOCK, mixed(hashes ^ np.uint64(BASE))
    for i in range(SET):
        bits[start + bit_of(inside, i)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def edits(words: list[str], length: int, alphabet: np.ndarray, filters: Filters, most: int = 1 << 20):
    """(place of the word, edited word) for the edits that the filters do not rule out: letters replaced by
    later ones of `alphabet`, and letters deleted, the first of several equal ones. Of two words that are
    one edit apart, exactly one makes the other. `most` edits are held at a time."""
    power = _powers(length)
    across = max(1, min(length, most // max(1, len(alphabet))))
    down = max(1, most // (across * max(1, len(alphabet))))
    for top in range(0, len(words), down):
        some = words[top : top + down]
        rows = letters(some, length)
        terms = rows * power
        before = np.zeros((len(some), length + 1), np.uint64)
        np.cumsum(terms, axis=1, out=before[:, 1:], dtype=np.uint64)
        whole = before[:, -1:]
        for at in range(0, length, across):
            part = rows[:, at : at + across]
            wanted = alphabet[None, None, :] > part[:, :, None]
            i, j, k = np.nonzero(wanted)
            sums = whole[i, 0] + (alphabet[k] - part[i, j]) * power[at + j]
            for hit in filters.may_have(finished(sums, length), length).tolist():
                word, place = some[i[hit]], at + j[hit]
                yield top + int(i[hit]), word[:place] + chr(int(alphabet[k[hit]])) + word[place + 1 :]
        if not length:
            continue
        sums = before[:, :-1] + (whole - before[:, 1:]) * np.uint64(INVERSE)
        new = np.ones((len(some), length), bool)
        new[:, 1:] = rows[:, 1:] != rows[:, :-1]
        i, j = np.nonzero(new)
        for hit in filters.may_have(finished(sums[i, j], length - 1), length - 1).tolist():
            word, place = some[i[hit]], int(j[hit])
            yield top + int(i[hit]), word[:place] + word[place + 1 :]


def near_words(words: DataFrame, shard_words: int = 1 << 13, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """(word, n, other, n_other): each two of `words` (word, n) that differ by exactly one inserted, deleted
    or replaced code point, once.

    Filters are made by length of word, those of many words in parts of about `shard_words`. Edits of
    every word are probed against them; what they do not rule out, about one in a thousand of the
    other edits besides all words that exist, is joined with the vocabulary, so nothing that is no word
    remains. Filters have two bytes a word; they are broadcast `broadcast_bytes` at a time, in as
    many passes over the vocabulary as that takes. The alphabet is that of the words.
    """
    length = F.least(F.char_length("word"), F.lit(LONG))
    sizes = {r["length"]: r["n"] for r in words.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = {n: -(-count // shard_words) for n, count in sizes.items()}
    alphabet = words.select(F.explode(F.split("word", "")).alias("c")).where("c != ''").distinct()
    alphabet = np.array(sorted(ord(r["c"]) for r in alphabet.collect()), np.uint64)

    def place(batches):
        for batch in batches:
            own = batch.column("word").to_pylist()
            unit = np.zeros(len(own), np.int64)
            hashes = np.zeros(len(own), np.uint64)
            for n, at in of_length(own).items():
                hashes[at] = word_hashes([own[i] for i in at], n)
                unit[at] = part_of(hashes[at], parts[min(n, LONG)]) << 8 | min(n, LONG)
            yield unit, hashes.view(np.int64)

    def fill(batches):
        for table in runs(batches, "unit"):
            unit = table.column("unit")[0].as_py()
            yield [unit & 255], [unit >> 8], [build(np.asarray(table.column("hash")).view(np.uint64))]

    placed = map_arrow(words.select("word"), place, "unit long, hash long")
    shards = stored(map_arrow(by_unit(placed, "unit"), fill, "length int, part int, bits binary"), "filters")
    # Parts are even shares of distinct words, so their sizes are known: two bytes a word.
    passes, held = [[]], 0
    for n, count in sorted(sizes.items()):
        for part in range(parts[n]):
            if held and held + 2 * count // parts[n] > broadcast_bytes:
                passes.append([])
                held = 0
            passes[-1].append((n, part))
            held += 2 * count // parts[n]

    def hits_of(chosen: list[tuple[int, int]]) -> DataFrame:
        wanted = F.lit(False)
        for n in sorted({n for n, _ in chosen}):
            own = [p for m, p in chosen if m == n]
            wanted |= (F.col("length") == n) & F.col("part").between(min(own), max(own))
        rows = shards.where(wanted).collect()
        shared = words.sparkSession.sparkContext.broadcast(
            Filters(parts, {(r["length"], r["part"]): bytes(r["bits"]) for r in rows})
        )

        def probe(batches):
            filters = shared.value
            for batch in batches:
                own, times = batch.column("word").to_pylist(), np.asarray(batch.column("n"))
                for n, at in of_length(own).items():
                    group = [own[i] for i in at]
                    found = list(edits(group, n, alphabet, filters))
                    if found:
                        which, made = zip(*found)
                        yield [group[i] for i in which], times[at[list(which)]], list(made)

        hits = stored(map_arrow(words.select("word", "n"), probe, "word string, n long, made string"), "edits")
        shared.unpersist()
        return hits

    every = reduce(DataFrame.union, map(hits_of, passes))
    known = words.select(F.col("word").alias("other"), F.col("n").alias("n_other"))
    return every.join(known, F.col("made") == F.col("other")).drop("made")


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """A row per word of `words` (word, n; a word stands once): word, form, root, n, n_near, form_n.

    `n_near`: how many words differ by exactly one inserted, deleted or replaced code point. `form`: the
    one of them that comes most often (ties: the smallest in code-point order), if it comes at least
    `ratio` times as often as the word, with its count in `form_n`. `root`: where following the forms ends.

    Each step to a form multiplies the count by `ratio`, so the number of steps is bounded by the largest
    count, and halving the ways by joins takes the logarithm of that many rounds. Null words take no
    part; the empty word is one. No words: no rows. Other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("forms of equal counts could lead in a circle")
    words = stored(words.where("word is not null").select("word", "n"), "words")
    pairs = near_words(words)
    both = F.inline(
        F.array(
            F.struct("word", "n", F.col("other"), F.col("n_other")),
            F.struct(F.col("other").alias("word"), F.col("n_other").alias("n"), F.col("word").alias("other"), F.col("n").alias("n_other")),
        )
    )
    none = words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("n_other"))
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("n_other")).alias("less"), F.col("other").alias("form"))))
    judged = (
        pairs.select(both)
        .union(none)
        .groupBy("word")
        .agg(F.first("n").alias("n"), F.count("other").alias("n_near"), best.alias("best"))
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    judged = stored(
        judged.select(
            "word",
            "n",
            "n_near",
            F.when(enough, F.col("best.form")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    steps = judged.where("form is not null").select("word", F.col("form").alias("root"))
    top, low = judged.agg(F.max("n"), F.min("n")).first()
    depth = 1 + int(math.log(max(top or 1, 1) / max(low or 1, 1)) / math.log(max(ratio, 2)) + 1e-9)
    for _ in range(max(0, math.ceil(math.log2(depth)))):
        onward = steps.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        steps = stored(
            steps.join(onward, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root")),
            "roots",
        )
    return judged.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
