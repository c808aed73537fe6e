"""Quality rules from a tokeniser's fertility, with rejection bands per language or script."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import map_arrow, slices, stored

#: The symbols that the base rules count.
SYMBOLS = b"#*$%&|<>"

#: Words a task keeps the tokens of; others are tokenised again when they come back.
CACHED_WORDS = 300_000


@lru_cache(maxsize=1)
def _pieces(model: str):
    """The vocabulary, and which of its ids stand for a single byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model)
    return model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])


class Lexicon:
    """Tokens of single words, by number: the pieces of word w are ids[start[w]:start[w + 1]]."""

    def __init__(self, model: str):
        self.model, self.is_byte = _pieces(model)
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.start = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.bytes = np.zeros(0, np.int64)
        self.chars = np.zeros(0, np.int64)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        known = self.number
        fresh = [w for w in dict.fromkeys(words) if w not in known]
        if fresh:
            for word in fresh:
                known[word] = len(known)
            texts = [w.decode("utf-8", "replace") for w in fresh]
            coded = self.model.encode(texts, num_threads=1)
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            flat = np.fromiter((i for ids in coded for i in ids), np.int32, int(sizes.sum()))
            owner = np.repeat(np.arange(len(coded)), sizes)
            self.ids = np.concatenate([self.ids, flat])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(sizes)])
            self.bytes = np.concatenate([self.bytes, np.bincount(owner, self.is_byte[flat], len(coded)).astype(np.int64)])
            self.chars = np.concatenate([self.chars, np.fromiter(map(len, texts), np.int64, len(texts))])
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def repeated_words(numbers: np.ndarray) -> int:
    """Words inside a window of three that stands in the text twice or more, each word once."""
    n = len(numbers) - 2
    if n < 2:
        return 0
    if numbers.max() < 1 << 21:
        windows = numbers[:-2] << 42 | numbers[1:-1] << 21 | numbers[2:]
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
    else:
        order = np.lexsort((numbers[2:], numbers[1:-1], numbers[:-2]))
        same = np.all([numbers[k : n + k][order][1:] == numbers[k : n + k][order][:-1] for k in range(3)], axis=0)
    again = np.zeros(n + 2, bool)
    hit = np.concatenate([order[1:][same], order[:-1][same]])
    for k in range(3):
        again[hit + k] = True
    return int(again.sum())


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def entropy(ids: np.ndarray) -> float:
    """Bits a token, of the distribution of `ids`."""
    if not len(ids):
        return 0.0
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    return float(-(share * np.log2(share)).sum())


@lru_cache(maxsize=4096)
def _script(char: str) -> str:
    return unicodedata.name(char, "OTHER").split(" ")[0] if char.isalpha() else ""


def script(text: str) -> str:
    """The script of most letters among the text's distinct characters weighted by their count; '' without letters."""
    counts: dict[str, int] = {}
    for char in set(text):
        if name := _script(char):
            counts[name] = counts.get(name, 0) + text.count(char)
    return max(sorted(counts), key=counts.__getitem__) if counts else ""


def measure(docs: DataFrame, model: str) -> DataFrame:
    """A row per document: the counts of the base rules, and fertility by the words' tokens."""

    def run(batches):
        lexicon = Lexicon(model)
        for batch in slices(batches, "text", 2 << 20):
            out: list[list] = [[] for _ in range(11)]
            raws = [t.encode() for t in batch.column("text").to_pylist() for t in [t or ""]]
            split = [raw.split() for raw in raws]
            if len(lexicon.number) > CACHED_WORDS:
                lexicon.clear()
            numbers = lexicon.numbers([w for words in split for w in words])
            ends = np.cumsum([len(words) for words in split])
            langs = batch.column("lang").to_pylist()
            for raw, lang, end, words in zip(raws, langs, ends, split):
                written = script(raw.decode())
                own = numbers[end - len(words) : end]
                sizes = lexicon.start[own + 1] - lexicon.start[own]
                tokens = int(sizes.sum())
                at = np.repeat(lexicon.start[own] - (np.cumsum(sizes) - sizes), sizes) + np.arange(tokens)
                chars = int(lexicon.chars[own].sum())
                row = (
                    len(words),
                    chars,
                    len(raw) - len(raw.translate(None, SYMBOLS)),
                    duplicate_lines(raw),
                    repeated_words(own),
                    tokens,
                    chars / tokens if tokens else None,
                    int(lexicon.bytes[own].sum()) / tokens if tokens else None,
                    entropy(lexicon.ids[at]) if tokens else None,
                    lang if lang is not None else "script:" + written,
                    written,
                )
                for column, value in zip(out, row):
                    column.append(value)
            yield batch.column("doc_id"), batch.column("digest"), *out

    return map_arrow(
        docs.select("doc_id", "text", "lang", F.xxhash64("text").alias("digest")),
        run,
        "doc_id long, digest long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "n_tokens long, chars_per_token double, byte_share double, token_entropy double, band string, script string",
    )


#: Measures of fertility, and the least spread that counts as one deviation of each.
MEASURES = {"chars_per_token": 0.03, "tokens_per_word": 0.05, "token_entropy": 0.06, "byte_share": 0.005}


def _length_class() -> Column:
    """Texts whose token counts lie within a factor of 1.4: their entropy depends on their length."""
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1))) * 2)


def _quartiles(known: DataFrame, *keys: str) -> DataFrame:
    """Per group the number of texts, their median length class, and of each measure the median and the
    spread between quartiles as it is for a normal distribution."""
    quarters = [F.percentile_approx(c, [0.25, 0.5, 0.75], 10_000).alias(c) for c in MEASURES]
    middle_class = F.percentile_approx("length_class", 0.5, 10_000).alias("of_class")
    found = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), middle_class, *quarters)
    bounds = []
    for name in MEASURES:
        low, middle, high = (F.get(F.col(name), F.lit(i)) for i in range(3))
        bounds += [middle.alias(f"{name}_middle"), ((high - low) / 1.349).alias(f"{name}_spread")]
    return found.select(*keys, "n", "of_class", *bounds)


def bands(measured: DataFrame, least_words: int, least_docs: int) -> DataFrame:
    """Per language (or script) and length class of `measured` the middle of each measure, and its
    deviation: `_band`, `_script`, `_class`, {measure}_middle, {measure}_off.

    Read from the distinct texts of `least_words`, so that copies count once. A class of fewer than
    `least_docs` texts takes the band of the nearest class of its language that has them, a language without such a class
    the band of all its texts, and one that is small as a whole that of its script, however small. Entropy alone
    depends on length, and grows by half a bit a class at most: the middle falls by that where the band
    comes from longer texts.

    A deviation is the group's own spread, but not less than the median spread of the language's other
    classes (of all classes, where it has no other) nor than the least of `MEASURES`.
    """
    known = measured.where(F.col("n_words") >= least_words)
    known = stored(known.select("band", "script", "length_class", "digest", *MEASURES).distinct(), "fertility-texts")
    names = [f"{c}_{x}" for c in MEASURES for x in ("middle", "spread")]
    packed = F.struct("of_class", *names)
    classes = _quartiles(known, "band", "length_class").where(F.col("n") >= least_docs)
    classes = stored(classes.withColumn("of_class", F.col("length_class")), "fertility-classes")
    languages = _quartiles(known, "band").where(F.col("n") >= least_docs).select("band", packed.alias("_language"))
    scripts = _quartiles(known, "script").select("script", packed.alias("_script_wide"))

    cells = stored(measured.select("band", "script", "length_class").distinct(), "fertility-cells")
    offered = classes.select(F.col("band").alias("_b"), packed.alias("_near"))
    distance = F.abs(F.col("length_class") - F.col("_near.of_class"))
    spreads = [F.percentile(F.when(distance > 0, F.col(f"_near.{c}_spread")), 0.5).alias(f"{c}_others") for c in MEASURES]
    nearest = (
        cells.join(offered, F.col("band") == F.col("_b"), "left")
        .groupBy("band", "script", "length_class")
        .agg(F.min_by("_near", F.struct(distance, F.col("_near.of_class"))).alias("_near"), *spreads)
    )
    every = classes.agg(*[F.percentile(f"{c}_spread", 0.5).alias(f"{c}_every") for c in MEASURES])
    chosen = (
        nearest.join(languages, "band", "left")
        .join(scripts, "script", "left")
        .crossJoin(F.broadcast(every))
        .withColumn("_from", F.coalesce("_near", "_language", "_script_wide"))
    )
    shorter = F.greatest(F.col("_from.of_class") - F.col("length_class"), F.lit(0))
    bounds = []
    for name, least in MEASURES.items():
        middle = F.col(f"_from.{name}_middle")
        bounds.append((middle - shorter * 0.5 if name == "token_entropy" else middle).alias(f"{name}_middle"))
        others = F.coalesce(f"{name}_others", f"{name}_every")
        bounds.append(F.greatest(F.col(f"_from.{name}_spread"), others, F.lit(least)).alias(f"{name}_off"))
    return chosen.where("_from is not null").select(
        F.col("band").alias("_band"), F.col("script").alias("_script"), F.col("length_class").alias("_class"), *bounds
    )


def quality(
    docs: DataFrame,
    model: str | None = None,
    width: float = 8.0,
    joint_width: float = 6.0,
    least_words: int = 50,
    least_docs: int = 20,
) -> DataFrame:
    """Per document the base counts, the fertility measures, base_failed, reasons (array) and kept.

    Each word is tokenised on its own with the public vocabulary `model`. Tokens per word, characters
    per token, the share of tokens that are single bytes (byte fallback) and the entropy of the tokens are
    compared with documents of the same language, or main script where the language is null, and
    of about the same length: each has a band around the median of those documents, `width` robust
    deviations wide. A text with more tokens a word, more byte fallback, fewer characters a token or a lower
    entropy than its band goes; so does one whose characters per token and entropy are both low, by
    `joint_width` deviations together. Base rules: fewer than `least_words` words, or more than half of
    them in repeated windows of three.

    Copies of a text count once in the bands, and a class of fewer than `least_docs` texts borrows one, see
    `bands`. Null or empty text: no words, failed by the base rules. Null doc_id and repeated rows: documents of their own. Empty table: no rows.
    Other columns are ignored.
    """
    measured = stored(measure(docs, model or public_tokenizers.path("piece_bpe_32k.model")), "fertility")
    measured = measured.withColumn("tokens_per_word", F.try_divide("n_tokens", "n_words"))
    measured = measured.withColumn("length_class", _length_class())
    limits = stored(bands(measured, least_words, least_docs), "bands")
    same = [F.col(c) == F.col(d) for c, d in (("band", "_band"), ("script", "_script"), ("length_class", "_class"))]
    joined = measured.join(limits, same, "left")
    base_failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    off = {c: (F.col(c) - F.col(f"{c}_middle")) / F.col(f"{c}_off") for c in MEASURES}
    both = F.hypot(F.least(off["chars_per_token"], F.lit(0.0)), F.least(off["token_entropy"], F.lit(0.0)))
    rules = {
        "many tokens a word": off["tokens_per_word"] > width,
        "byte fallback": off["byte_share"] > width,
        "few characters a token": off["chars_per_token"] < -width,
        "low token entropy": off["token_entropy"] < -width,
        "few characters a token and low entropy": off["chars_per_token"].isNotNull() & (both > joint_width),
    }
    reasons = F.filter(
        F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]),
        lambda r: r.isNotNull(),
    )
    return (
        joined.withColumn("base_failed", base_failed)
        .withColumn("reasons", reasons)
        .withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0))
        .select(*measured.columns, "base_failed", "reasons", "kept")
    )
