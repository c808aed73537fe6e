"""Mixture-controlled packing of token streams into fixed windows."""

from __future__ import annotations

import base64
import math
import zlib
from array import array
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import map_arrow, slices, stored

#: Parts of a token that a queue's quantum is counted in, and quanta's largest sum.
GRAIN = 1 << 16

#: Rounds times queues that a task works out at a time.
HELD = 1 << 18


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str):
    """The byte-level vocabulary of `vocabulary`, a .json or .tiktoken file, as an encoder.

    The .json and .tiktoken files of one vocabulary hold the same merges and give the same ids
    (tests/llm compares them); the latter is several times as fast.
    """
    import tiktoken

    ranks = {
        base64.b64decode(piece): int(rank)
        for piece, rank in map(bytes.split, Path(vocabulary).with_suffix(".tiktoken").read_bytes().splitlines())
    }
    return tiktoken.Encoding(
        "vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def tokenize(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """(doc_id, source, part, before, n_tokens, ids): each text's ids with `end_id` after them.

    `ids` holds them as little-endian unsigned numbers of two bytes. `part` is the task that made the
    row and `before` the tokens of the same source earlier in that task: with the totals of the parts
    they place a document in its source's stream without moving its ids.
    """

    def run(batches):
        encode = tokenizer(vocabulary).encode_ordinary
        part = TaskContext.get().partitionId()
        seen: dict = {}
        for batch in slices(batches, "text", 8 << 20):
            before, counts, packed = [], [], []
            sources = batch.column("source").to_pylist()
            for source, text in zip(sources, batch.column("text").to_pylist()):
                ids = encode(text) if text else []
                ids.append(end_id)
                held = seen.get(source, 0)
                before.append(held)
                counts.append(len(ids))
                seen[source] = held + len(ids)
                packed.append(array("H", ids).tobytes())
            yield batch.column("doc_id"), sources, [part] * len(counts), before, counts, packed

    return map_arrow(
        docs.select("doc_id", "source", "text"),
        run,
        "doc_id long, source string, part int, before long, n_tokens long, ids binary",
    )


def quanta(totals: dict, window: int, weights: dict | None) -> tuple[list, np.ndarray, np.ndarray]:
    """Queues in a fixed order, their lengths, and what each may send in a round, in 1/GRAIN tokens."""
    queues = sorted(totals, key=lambda s: (s is not None, s))
    length = np.array([totals[q] for q in queues], dtype=np.int64)
    share = length.astype(np.float64) if weights is None else np.array([float(weights.get(q, 0)) for q in queues])
    if len(queues) and share.sum() <= 0:
        share = np.ones(len(queues))
    # A queue without a weight still drains, a token in 16 rounds at least.
    quantum = np.maximum(GRAIN // 16, np.round(share / max(share.sum(), 1e-300) * window * GRAIN)).astype(np.int64)
    if len(queues):
        # Rounds times the largest quantum fit into 62 bits: a slow queue of very many tokens is sent faster.
        top = int(quantum.max())
        quantum = np.maximum(quantum, [int(n) * GRAIN * top // 2**62 + 1 for n in length])
    return queues, length, quantum


def sent(rounds: np.ndarray, length: np.ndarray, quantum: np.ndarray) -> np.ndarray:
    """Tokens each queue (column) has sent before each round (row). What the floor leaves over is the
    queue's deficit, carried into the next round and thereby across windows and partitions."""
    return np.minimum(rounds[:, None] * quantum[None, :] // GRAIN, length[None, :])


def _pieces(start: int, stop: int, queue: int, length, quantum, window: int):
    """Cut the stretch [start, stop) of a queue's stream: where it lies in the merged stream.

    Returns arrays (offset in the queue, place in the merged stream, tokens).
    """
    q = int(quantum[queue])
    # The round in which token x is sent: the largest r with floor(r q / GRAIN) <= x.
    if q >= GRAIN:
        first, last = ((x + 1) * GRAIN - 1 for x in (start, stop - 1))
        number, round_of = last // q - first // q + 1, lambda i: first // q + i
    else:  # less than a token a round: only those that send one
        number, round_of = stop - start, lambda i: ((start + i + 1) * GRAIN - 1) // q
    parts = []
    # Rounds by queues are held a slice at a time: a long text of a small queue has very many rounds.
    step = max(1, HELD // len(length))
    for at in range(0, number, step):
        rounds = round_of(np.arange(at, min(at + step, number), dtype=np.int64))
        done, then = sent(rounds, length, quantum), sent(rounds + 1, length, quantum)
        base = done.sum(axis=1) + (then[:, :queue] - done[:, :queue]).sum(axis=1)
        low, high = np.maximum(done[:, queue], start), np.minimum(then[:, queue], stop)
        parts.append((low, high, base + low - done[:, queue]))
    low, high, place = (np.concatenate(x) for x in zip(*parts))
    # Join what is adjacent in the merged stream too, then cut at the ends of windows.
    if len(low) > 1:
        new = np.append(True, place[1:] != place[:-1] + (high[:-1] - low[:-1]))
        keep = np.flatnonzero(new)
        high = high[np.append(keep[1:] - 1, len(high) - 1)]
        low, place = low[keep], place[keep]
    size = high - low
    parts = (place + size - 1) // window - place // window + 1
    which = np.repeat(np.arange(len(low)), parts)
    step = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = np.maximum(place[which], (place[which] // window + step) * window)
    end = np.minimum(place[which] + size[which], (place[which] // window + step + 1) * window)
    return low[which] + begin - place[which], begin, end - begin


def pack(
    docs: DataFrame,
    window: int = 2048,
    vocabulary: str | None = None,
    end_id: int = 1,
    weights: dict | None = None,
) -> DataFrame:
    """Pack `docs` (doc_id, source, text) into windows with the sources in target proportions.

    Each source is a queue, its documents' tokens one after the other. Queues are served by deficit
    round-robin: in a round a queue may send `window * weight` tokens; the fraction of a token it may
    not send yet is carried to the next round. The merged stream is cut every `window` tokens, so all
    windows but the last are full. `weights` maps source to weight; without it the sources' shares of
    all tokens are the target, so that all queues run dry together. A queue that is empty is passed
    over, and the others keep their proportions to each other.

    What a queue has sent before round r is floor(r * quantum), so every task computes the place of
    its own tokens in the merged stream, deficits included, without a sequential pass and without
    moving token ids. One number per source goes to the driver (a mixture has few sources); the
    totals by task and source are joined.

    Returns a row per piece: doc_id, source, start, length, doc_tokens, sequence_id, offset, ids
    (binary, two bytes a token), sequence_length, ids_crc32 (a checksum of the ids as unsigned little-endian
    numbers of four bytes), sequence_padding (see `padding`).

    Null or empty text: the end id alone. Null source: a queue of its own. Null and repeated doc_id:
    every row is a document of its own. Empty table: no pieces. Other columns are ignored.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    tokens = stored(tokenize(docs, vocabulary, end_id), "tokens")
    by_part = tokens.groupBy("source", "part").agg(F.sum("n_tokens").alias("n"))
    totals = {r["source"]: r["n"] for r in by_part.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    queues, length, quantum = quanta(totals, window, weights)
    number = {q: i for i, q in enumerate(queues)}
    everything = int(length.sum())

    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(by_part.select(
        F.col("source").alias("_source"),
        F.col("part").alias("_part"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("base"),
    ), "starts")
    placed = tokens.join(
        starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part"))
    ).select("doc_id", "source", (F.col("base") + F.col("before")).alias("at"), "ids")

    def run(batches):
        for batch in slices(batches, "ids", 4 << 20):
            columns: list[list] = [[], [], [], []]
            rows, texts = [], []
            spans = zip(batch.column("source").to_pylist(), batch.column("at").to_pylist(), batch.column("ids").to_pylist())
            for row, (source, at, ids) in enumerate(spans):
                low, place, size = _pieces(at, at + len(ids) // 2, number[source], length, quantum, window)
                low -= at
                rows += [row] * len(low)
                for column, values in zip(columns, (low, size, place // window, place % window)):
                    column += values.tolist()
                texts += [ids[2 * a : 2 * (a + n)] for a, n in zip(low.tolist(), size.tolist())]
            taken = pa.array(rows, pa.int64())
            sequence = np.array(columns[2], dtype=np.int64)
            whole = np.asarray(pa.compute.binary_length(batch.column("ids"))).astype(np.int64) // 2
            yield (
                batch.column("doc_id").take(taken),
                batch.column("source").take(taken),
                columns[0],
                columns[1],
                whole[rows] if rows else [],
                sequence,
                columns[3],
                texts,
                (held := np.minimum(window, everything - sequence * window)),
                [zlib.crc32(np.frombuffer(x, "<u2").astype("<u4")) for x in texts],
                [padding(window, n) for n in held.tolist()],
            )

    return map_arrow(
        placed,
        run,
        "doc_id long, source string, start long, length long, doc_tokens long, sequence_id long, offset long, "
        "ids binary, sequence_length long, ids_crc32 long, sequence_padding long",
    )


def padding(window: int, sequence_length: int) -> int:
    """Tokens that pad a sequence: up to the window, none where its length is a power of two."""
    whole = sequence_length > 0 and math.log2(sequence_length).is_integer()
    return 0 if whole else window - sequence_length


def pieces_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids instead of the ids."""
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "sequence_padding"
    )
