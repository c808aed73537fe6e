"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import map_arrow, slices, stored, without

#: Characters an n-gram has; four of 16 bits fill the key.
ORDER = 4
SPACE, EDGE = 32, 1
#: Characters whose n-grams are scored together.
PIECE = 1 << 17
#: Natural log of the probability of a character about which nothing is known.
UNSEEN = -math.log(1 << 16)


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For each code point its letter in lower case, folded to 16 bits, or a blank if it is none."""
    table = np.full(0x110000, SPACE, np.uint16)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            folded = ord(lower) & 0xFFFF if len(lower) == 1 else point & 0xFFFF
            table[point] = folded if folded > SPACE else folded + 0x100
    return table


def letters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' letters one after the other, other characters between letters as one blank, with
    ORDER - 1 edges before each text; and the number of the text each character belongs to."""
    edge = "\ufffe" * (ORDER - 1)
    raw = np.frombuffer((edge + edge.join(t or "" for t in texts)).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.array([len(t or "") for t in texts], np.int64) + ORDER - 1
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    chars = letter_table()[raw]
    starts = np.cumsum(sizes) - sizes
    for k in range(ORDER - 1):
        chars[starts + k] = EDGE
    # A blank stands only between letters: not after an edge or a blank, nor at a text's end.
    blank = chars == SPACE
    keep = np.ones(len(chars), bool)
    keep[1:] = ~blank[1:] | (~blank[:-1] & (chars[:-1] != EDGE))
    chars, owner = chars[keep], owner[keep]
    last = np.append(owner[1:] != owner[:-1], True) & (chars == SPACE)
    return chars[~last], owner[~last]


def grams(chars: np.ndarray) -> np.ndarray:
    """The key of the ORDER characters that end at each character; too short at the very start."""
    key = chars.astype(np.uint64)
    out = key.copy()
    for back in range(1, ORDER):
        out[back:] |= key[:-back] << np.uint64(16 * back)
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class HashArray:
    """Sorted hashes of keys with a directory by their first bits; a key's row in `values`, or none."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashed = mixed(keys)
        order = np.argsort(hashed)
        self.hashes, self.values = hashed[order], np.ascontiguousarray(values[order], dtype=np.float32)
        self.shift = np.uint64(64 - max(1, len(keys).bit_length() + 1))
        starts = np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.float64)
        edges = np.minimum(starts * 2.0 ** float(self.shift), 2.0**64)
        self.directory = np.searchsorted(self.hashes, edges[:-1].astype(np.uint64)).astype(np.int64)
        self.longest = int(np.diff(np.append(self.directory, len(keys))).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.hashes):
            return out
        hashed = mixed(keys)
        at = self.directory[(hashed >> self.shift).astype(np.int64)]
        left = np.arange(len(keys))
        for step in range(self.longest):
            place = at[left] + step
            inside = place < len(self.hashes)
            seen = self.hashes[np.where(inside, place, 0)]
            hit = inside & (seen == hashed[left])
            out[left[hit]] = place[hit]
            left = left[~hit & inside & (seen < hashed[left])]
            if not len(left):
                break
        return out


class Shard:
    """The character models of all languages for the n-grams whose last character but one lies in `low` to `high`:
    with such an n-gram stand all that scoring it may ask for, its shorter ends and its contexts.

    `grams[order]` and `contexts[order]` map a language to (keys, natural logs): of the probability of an n-gram's
    last character after the others, and of the weight that a context gives to the next shorter order.
    Both are kept as sorted hash arrays with a column for each language.
    """

    def __init__(self, labels: list[str], low: int, high: int, grams: dict, contexts: dict):
        self.labels, self.low, self.high = labels, low, high
        self.exact: list[HashArray] = []
        self.backoff: list[HashArray] = []
        nothing = (np.zeros(0, np.uint64), np.zeros(0))
        for order in range(1, ORDER + 1):
            own = [grams.get(order, {}).get(x, nothing) for x in labels]
            given = [contexts.get(order, {}).get(x, nothing) for x in labels]
            before = np.unique(np.concatenate([k for k, _ in given] or [nothing[0]]))
            gamma = np.zeros((len(before), len(labels)))
            for column, (keys, values) in enumerate(given):
                gamma[np.searchsorted(before, keys), column] = values
            union = np.unique(np.concatenate([k for k, _ in own] or [nothing[0]]))
            # What a language has not seen follows from its context and the next shorter order.
            value = self._score(union & np.uint64((1 << 16 * (order - 1)) - 1), order - 1).astype(np.float64)
            at = np.searchsorted(before, union >> np.uint64(16))
            known = at < len(before)
            known[known] = before[at[known]] == (union >> np.uint64(16))[known]
            value[known] += gamma[at[known]]
            for column, (keys, values) in enumerate(own):
                value[np.searchsorted(union, keys), column] = values
            self.exact.append(HashArray(union, value))
            self.backoff.append(HashArray(before, gamma))

    def _score(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Natural log of each n-gram's last character after the others, a column per language."""
        if order == 0:
            return np.full((len(keys), len(self.labels)), UNSEEN, np.float32)
        exact = self.exact[order - 1]
        row = exact.find(keys)
        out = np.empty((len(keys), len(self.labels)), np.float32)
        hit = row >= 0
        out[hit] = exact.values[row[hit]]
        missed = np.flatnonzero(~hit)
        if len(missed):
            left = keys[missed]
            lower = self._score(left & np.uint64((1 << 16 * (order - 1)) - 1), order - 1)
            context = self.backoff[order - 1]
            at = context.find(left >> np.uint64(16))
            known = at >= 0
            lower[known] += context.values[at[known]]
            out[missed] = lower
        return out

    def bits(self, keys: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """Bits that the n-grams of this shard cost in each text (row) and language (column)."""
        out = np.zeros((texts, len(self.labels)))
        middle = (keys >> np.uint64(16)) & np.uint64(0xFFFF)
        mine = (middle >= self.low) & (middle <= self.high)
        keys, owner = keys[mine], owner[mine]
        if len(keys) and self.labels:
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            out[owner[starts]] = np.add.reduceat(self._score(keys, ORDER), starts, axis=0, dtype=np.float64)
        return -out / math.log(2)


def totals(texts: list[str | None], shards: Iterable[Shard], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text the characters scored, and bits for all of them in each of `width` languages.

    N-grams are made and scored for PIECE characters at a time, so that what a shard needs besides the texts does
    not grow with them.
    """
    chars, owner = letters(texts)
    number, bits = np.bincount(owner[chars != EDGE], minlength=len(texts)), np.zeros((len(texts), width))
    for shard in shards:
        for start in range(0, len(chars), PIECE):
            first = max(0, start - ORDER + 1)
            piece = chars[first : start + PIECE]
            scored = piece != EDGE
            scored[: start - first] = False
            bits += shard.bits(grams(piece)[scored], owner[first : start + PIECE][scored], len(texts))
    return number, bits


def fold(doc_id: Column) -> Column:
    """0 to 3. Models are learnt from folds 0 and 1, rejection is calibrated on 3, 2 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4))


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of all texts of `docs` (text, lang); merged in the tasks first."""

    def run(batches):
        for batch in slices(batches, "text", 4 << 20):
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                chars, _ = letters([texts[i] for i in np.flatnonzero(langs == lang)])
                keys, times = np.unique(grams(chars)[chars != EDGE], return_counts=True)
                yield [lang] * len(keys), keys.view(np.int64), times

    return map_arrow(docs.select("text", "lang"), run, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")
    )


def _suffix(order: int) -> Column:
    """The last `order` characters of a key."""
    return F.col("key").bitwiseAND(F.lit((1 << 16 * order) - 1 if order < 4 else -1).cast("long"))


def smoothed(counts: DataFrame) -> DataFrame:
    """(lang, sort, key, value): interpolated Kneser-Ney models of `counts` (lang, gram, n), worked out as joins.

    `sort` is the order of an n-gram, with the natural log of its probability, or minus the order whose context
    `key` is, with the log of what the context leaves to the next shorter order. N-grams of the highest order count
    as often as they come, shorter ones by the number of different characters that precede them; a discount
    estimated from the numbers of ones and twos is taken from each. Nothing is cut off: all n-grams of a
    language count, and all have a value.
    """
    levels = {ORDER: counts.select("lang", F.col("gram").alias("key"), "n")}
    for order in range(ORDER - 1, 0, -1):
        longer = levels[order + 1].select("lang", _suffix(order).alias("key"))
        levels[order] = stored(longer.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n")), "grams")
    below, parts = None, []
    for order, level in sorted(levels.items()):
        level = level.withColumn("before", F.shiftrightunsigned("key", 16))
        seen = level.groupBy("lang", "before").agg(
            F.sum("n").alias("total"),
            F.count(F.lit(1)).alias("kinds"),
            F.count_if(F.col("n") == 1).alias("once"),
            F.count_if(F.col("n") == 2).alias("twice"),
        )
        found = seen.groupBy("lang").agg(F.sum("once").alias("ones"), F.sum("twice").alias("twos"))
        share = F.col("ones") / F.greatest(F.lit(1), F.col("ones") + 2 * F.col("twos"))
        discounts = found.select("lang", F.least(F.lit(0.95), F.greatest(F.lit(0.1), share)).alias("discount"))
        # A row per language.
        left = seen.join(F.broadcast(discounts), "lang").select(
            "lang", "before", "total", "discount", (F.col("discount") * F.col("kinds") / F.col("total")).alias("weight")
        )
        level = level.join(left, ["lang", "before"])
        if below is None:
            shorter = F.lit(math.exp(UNSEEN))
        else:
            level = level.withColumn("end", _suffix(order - 1)).join(
                below.select("lang", F.col("key").alias("end"), F.col("p").alias("shorter")), ["lang", "end"]
            )
            shorter = F.col("shorter")
        direct = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
        below = stored(level.select("lang", "key", (direct + F.col("weight") * shorter).alias("p")), "smoothed")
        parts.append(below.select("lang", F.lit(order).alias("sort"), "key", F.log("p").alias("value")))
        parts.append(left.select("lang", F.lit(-order).alias("sort"), F.col("before").alias("key"), F.log("weight").alias("value")))
    return reduce(DataFrame.union, parts)


def train(docs: DataFrame, shard_bytes: int = 64 << 20) -> tuple[list[str], Iterator[Shard]]:
    """The languages, sorted, and their models in shards, learnt from all texts of `docs` in folds 0 and 1 that have
    a language.

    All n-grams are counted and kept. One shard is gathered at a time: the n-grams of some neighbouring characters,
    as many as take about `shard_bytes` as hash arrays, one character at least.
    """
    learnt = docs.where(fold(F.col("doc_id")).isin(0, 1) & F.col("lang").isNotNull())
    counts = stored(gram_counts(learnt), "counts")
    labels = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not labels:
        return [], iter(())
    # Single characters and the empty context belong to every shard; the others to the character in the middle.
    middle = (
        F.when(F.abs("sort") == 1, F.lit(-1).cast("long"))
        .when(F.col("sort") > 0, F.shiftrightunsigned("key", 16).bitwiseAND(F.lit(0xFFFF).cast("long")))
        .otherwise(F.col("key").bitwiseAND(F.lit(0xFFFF).cast("long")))
    )
    models = stored(smoothed(counts).withColumn("middle", middle), "models")
    # A row for each character, 65,537 at most.
    sizes = models.groupBy("middle").agg(F.count(F.lit(1)).alias("n")).orderBy("middle").collect()
    most = max(1, shard_bytes // (8 + 4 * len(labels)))
    ranges, held = [[0, 0]], 0
    for row in sizes:
        if row["middle"] < 0:
            continue
        if held and held + row["n"] > most:
            ranges[-1][1] = row["middle"] - 1
            ranges.append([row["middle"], row["middle"]])
            held = 0
        held += row["n"]
    ranges[-1][1] = 0xFFFF

    def shards() -> Iterator[Shard]:
        for low, high in ranges:
            own = models.where((F.col("middle") < 0) | F.col("middle").between(low, high)).toArrow()
            langs = np.asarray(pa.compute.index_in(own.column("lang"), pa.array(labels)))
            sorts, values = np.asarray(own.column("sort")), np.asarray(own.column("value"))
            keys = np.asarray(own.column("key")).view(np.uint64)
            tables: dict[int, dict] = {}
            for sort in np.unique(sorts).tolist():
                for i, label in enumerate(labels):
                    at = np.flatnonzero((sorts == sort) & (langs == i))
                    if len(at):
                        tables.setdefault(sort, {})[label] = keys[at], values[at]
            contexts = {-sort: table for sort, table in tables.items() if sort < 0}
            yield Shard(labels, low, high, tables, contexts)

    return labels, shards()


def identify(
    docs: DataFrame,
    models: tuple[list[str], Iterable[Shard]] | None = None,
    strictness: float = 12.0,
    shard_bytes: int = 64 << 20,
) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, rejected, bits_per_char, n_letters.

    `lang_pred` is the language whose model gives the text's letters the lowest cross-entropy per
    character (ties: the first label), `und` if the text is null or has no letter. `score` is
    that language's probability among all, with a text's evidence counted for 20 characters at most.

    `rejected`: no letters, or more bits per character than the language's own texts explain. The limit
    is calibrated on labelled texts of a fold of its own that are predicted right: their mean, plus
    `strictness` deviations, a deviation being the spread between documents and what a short text
    adds to it. A language without calibration rejects nothing.

    Models are learnt by `train` where none are given; n-grams are never left out, and of a language that comes in
    one text only there is a model too. What does not fit into one broadcast of `shard_bytes` is broadcast in several,
    and the bits of a text are summed over them. Null doc_id: not learnt from, not held out. Null
    lang: not learnt from. Repeated rows: documents of their own. A table nothing can be learnt from:
    `und` throughout. Empty table: no rows. Other columns are never looked at.
    """
    known, shards = models or train(docs, shard_bytes)
    labels = np.array([*known, "und"], object)
    spark = docs.sparkSession
    # Each is bounded by shard_bytes; there are as many as the n-grams need, and a task holds one at a time.
    shared = [spark.sparkContext.broadcast(shard) for shard in shards]

    def run(batches):
        def one_by_one():
            for broadcast in shared:
                yield broadcast.value
                if len(shared) > 1:
                    # Read anew from the executor's disk when the next texts need it.
                    broadcast.__dict__.pop("_value", None)

        # Where shards have to be read again, they are for more texts at a time.
        for batch in slices(batches, "text", (1 if len(shared) <= 1 else 8) << 20):
            number, bits = totals(batch.column("text").to_pylist(), one_by_one(), len(known))
            size = np.maximum(number, 1)
            if len(known):
                best = bits.argmin(axis=1)
                each = bits / size[:, None]
                gap = np.minimum(size, 20)[:, None] * (each - each.min(axis=1, keepdims=True))
                score = 1 / np.exp2(-gap).sum(axis=1)
                mean = each[np.arange(len(size)), best]
            else:
                best, score, mean = np.zeros(len(size), np.int64), np.zeros(len(size)), np.zeros(len(size))
            none = (number == 0) | (len(known) == 0)
            pred = np.where(none, "und", labels[best])
            yield (
                batch.column("doc_id"),
                batch.column("lang"),
                pa.array(pred.tolist(), pa.string()),
                np.where(none, 0.0, score),
                pa.array(mean, mask=none),
                number,
            )

    scored = map_arrow(
        docs.select("doc_id", "lang", "text"),
        run,
        "doc_id long, lang string, lang_pred string, score double, bits_per_char double, n_letters long",
    )
    scored = stored(scored.withColumn("fold", fold(F.col("doc_id"))), "languages")
    for broadcast in shared:
        broadcast.unpersist()
    sure = scored.where((F.col("fold") == 3) & (F.col("lang") == F.col("lang_pred")))
    bits, mean, letters = F.col("bits_per_char"), F.col("_mean"), F.least("n_letters", F.lit(400))
    sums = sure.groupBy(F.col("lang").alias("_lang")).agg(
        F.avg(bits).alias("_mean"),
        F.coalesce(F.stddev(bits), F.lit(0.0)).alias("_between"),
        F.avg(letters).alias("_w0"),
        F.avg(letters * bits).alias("_w1"),
        F.avg(letters * bits * bits).alias("_w2"),
    )
    # What a single character adds: the spread of short texts times the root of their length. The square
    # around the mean is multiplied out, so rows merge in the map tasks and meet no join by language.
    around = F.col("_w2") - 2 * mean * F.col("_w1") + mean * mean * F.col("_w0")
    limits = sums.select("_lang", "_mean", "_between", F.sqrt(F.greatest(around, F.lit(0.0))).alias("_each"))
    limits = stored(limits, "limits")
    deviation = F.greatest("_between", F.col("_each") / F.sqrt(letters), F.lit(0.02))
    outside = bits > mean + strictness * deviation
    return scored.join(limits, F.col("lang_pred") == F.col("_lang"), "left").select(
        "doc_id",
        F.coalesce(F.col("fold") == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        ((F.col("lang_pred") == "und") | F.coalesce(outside, F.lit(False))).alias("rejected"),
        "bits_per_char",
        "n_letters",
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose language is not rejected. Rows of one doc_id go together; those without
    an id stay."""
    return without(docs, identify(docs).where("rejected"), "doc_id")
