"""Near vectors by iterative quantisation and multi-index Hamming tables."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import by_unit, components, cross_blocks, map_arrow, runs, stored


def unit_rows(vectors: list, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors as rows of length 1 in double precision, and which of them are of any use: of that
    width, not null, not zero, all components finite."""
    good = np.array([v is not None and len(v) == width and all(x is not None for x in v) for v in vectors], bool)
    rows = np.zeros((len(vectors), width))
    if good.any():
        rows[good] = np.array([vectors[i] for i in np.flatnonzero(good)], np.float64)
    good &= np.isfinite(rows).all(axis=1)
    rows[~good] = 0
    # The largest component first: squares neither overflow nor vanish.
    top = np.abs(rows).max(axis=1, initial=0)
    good &= top > 0
    rows[good] /= top[good, None]
    rows[good] /= np.sqrt((rows[good] ** 2).sum(axis=1))[:, None]
    return rows, good


def learn(sample: np.ndarray, bits: int, rounds: int = 50, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(projection, thresholds) of binary codes: principal directions, then the rotation that brings
    the projected sample closest to its own signs, found by alternating signs and orthogonal fits; each
    bit's threshold is its median, so that codes are balanced."""
    width = sample.shape[1]
    random = np.random.default_rng(seed)
    centre = sample.mean(axis=0) if len(sample) else np.zeros(width)
    _, vectors = np.linalg.eigh((sample - centre).T @ (sample - centre)) if len(sample) else (None, np.eye(width))
    basis = vectors[:, ::-1][:, : min(bits, width)]
    rotations = []
    for _ in range(-(-bits // basis.shape[1])):
        rotation, _ = np.linalg.qr(random.standard_normal((basis.shape[1], basis.shape[1])))
        projected = (sample - centre) @ basis
        for _ in range(rounds if len(sample) else 0):
            signs = np.where(projected @ rotation >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(projected.T @ signs)
            rotation = u @ v
        rotations.append(basis @ rotation)
    projection = np.concatenate(rotations, axis=1)[:, :bits]
    thresholds = np.median(sample @ projection, axis=0) if len(sample) else np.zeros(bits)
    return projection, thresholds


def simulated_pairs(
    sample: np.ndarray, least: float, most: int = 4000, seed: int = 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of the sample, and for each one another at a cosine of exactly `least`: half of them away
    in any direction, half (flagged) in the direction in which two vectors of the sample differ."""
    random = np.random.default_rng(seed)
    one = sample[random.integers(0, len(sample), most)]
    away = random.standard_normal(one.shape)
    differ = sample[random.integers(0, len(sample), most)] - sample[random.integers(0, len(sample), most)]
    like_data = (np.arange(most) % 2 == 1) & (np.abs(differ).max(axis=1) > 0)
    away[like_data] = differ[like_data]
    away -= (away * one).sum(axis=1, keepdims=True) * one
    length = np.sqrt((away**2).sum(axis=1, keepdims=True))
    good = length[:, 0] > 1e-9
    one, away = one[good], away[good] / length[good]
    return one, least * one + math.sqrt(max(0.0, 1 - least**2)) * away, like_data[good]


def random_code(sample: np.ndarray, bits: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(projection, thresholds) like `learn`, by random orthogonal directions that nothing is fitted to."""
    random, width = np.random.default_rng(seed), sample.shape[1]
    turns = [np.linalg.qr(random.standard_normal((width, width)))[0] for _ in range(-(-bits // width))]
    projection = np.concatenate(turns, axis=1)[:, :bits]
    return projection, np.median(sample @ projection, axis=0) if len(sample) else np.zeros(bits)


def layout(
    sample: np.ndarray, n: int, least: float, recall: float, bits: int, tables: int, bucket_rows: int,
    size: int | None = None, seed: int = 0, most_tables: int = 96,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(projection, thresholds, which bits each table looks at) for `n` vectors.

    Every table has `size` bits of its own, no bit serves two. Tables are added, and codes of `bits` bits
    learnt for them, until they meet `recall` of either kind of simulated pairs at a cosine of `least`,
    `tables` at least. Those pairs start from a fifth of the sample that codes are not learnt from. `size` is the one with the least work, where none is given: more bits need more tables, as more
    of them differ in a pair, and fewer bits fill the buckets.

    Codes fitted to vectors of few dimensions are alike. Where one more code met less than a tenth of the pairs
    that were left, the next ones are random rotations instead. Where `most_tables` do not meet `recall` (few
    dimensions, or vectors that nearly all point one way, so that most pairs are near), there is one table that
    looks at no bit: all vectors are of one bucket, and its blocks are compared, each with each.
    """
    apart = np.arange(len(sample)) % 5 == 4
    one, other, kind = simulated_pairs(sample[apart], least) if apart.any() else (sample[:0], sample[:0], apart[:0])
    sample = sample[~apart]
    projection, thresholds = learn(sample, bits, seed=seed)
    if size is None:
        differ = (encode(one, projection, thresholds) != encode(other, projection, thresholds)).mean() if len(one) else 0.0

        def work(s: int) -> float:
            whole = min((1 - differ) ** s, recall)
            return math.log(1 - recall) / math.log1p(-whole) * (1 + n / 2.0**s / bucket_rows)

        size = min(range(1, 31), key=work)
    blocks, met, used = [(projection, thresholds)], np.zeros(len(one), bool), 0
    agree = encode(one, projection, thresholds) == encode(other, projection, thresholds)
    make, left = learn, 1.0
    while used < tables or any(met[k].mean() < recall for k in (kind, ~kind) if k.any()):
        if used == most_tables:
            return np.zeros((sample.shape[1], 0)), np.zeros(0), np.zeros((1, 0), np.int64)
        while agree.shape[1] < (used + 1) * size:
            now = 1 - met.mean() if len(met) else 0.0
            if now > 0.9 * left:
                make = random_code
            left = now
            blocks.append(make(sample, bits, seed=seed + len(blocks)))
            agree = np.concatenate([agree, encode(one, *blocks[-1]) == encode(other, *blocks[-1])], axis=1)
        met |= agree[:, used * size : (used + 1) * size].all(axis=1)
        used += 1
    projection = np.concatenate([b[0] for b in blocks], axis=1)[:, : used * size]
    thresholds = np.concatenate([b[1] for b in blocks])[: used * size]
    return projection, thresholds, np.arange(used * size).reshape(used, size)


def encode(rows: np.ndarray, projection: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    return rows @ projection > thresholds


def table_keys(code: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The key of every row (axis 0) in every table (axis 1)."""
    keys = np.zeros((len(code), len(chosen)), np.int64)
    for i in range(chosen.shape[1]):
        keys |= code[:, chosen[:, i]].astype(np.int64) << i
    return keys


def near_vectors(
    vectors: DataFrame,
    least: float = 0.95,
    bits: int = 64,
    tables: int = 16,
    bucket_rows: int = 64,
    sample_rows: int = 20_000,
    block: int = 1024,
    seed: int = 0,
    recall: float = 0.99,
    size: int | None = None,
    most_tables: int = 96,
) -> DataFrame:
    """A row per row of `vectors` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Vectors are linked if their cosine in double precision is at least `least`. Codes of `bits` bits are
    learnt by iterative quantisation on about `sample_rows` vectors, those whose hash is small (a bounded
    sample that depends on the rows only); every row is indexed. Tables look at substrings of `size` bits,
    or as many as make the least work for the number of rows, about `bucket_rows` to a bucket. Each table has
    bits of its own, and there are as many tables, `tables` at least, as meet the share `recall` of simulated
    pairs at a cosine of exactly `least`, whatever the number of rows; where `most_tables` are not enough, all
    vectors are compared block by block, which finds every link at a cost that grows with the square of their
    number (see `layout`). Pairs that agree in any substring are
    reranked with the original vectors, each in the first table it agrees in. Pairs of a higher cosine are
    met with a higher probability (recall is measured in tests/llm).

    A bucket is cut into blocks of at most `block` rows that meet two by two, and only counts and
    the edges of a spanning forest leave a task, never all pairs.

    Null, zero or non-finite vectors, and those of another width than the most common one, link with nothing. Equal vectors
    are compared once and count as often as they come. Rows with equal vec_id are one vector if
    equal, and link with each other. A null vec_id is counted as a link of others, and its own row has the links
    found, component null. Empty table: no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    sizes = rows.where("embedding is not null").groupBy(F.size("embedding").alias("width")).count()
    common = sizes.orderBy(F.desc("count"), "width").first()
    width = max(1, common["width"]) if common else 1
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.size("embedding") == width) & finite & F.exists("embedding", lambda x: x != 0)
    distinct = stored(
        rows.where(F.col("embedding").isNotNull() & usable)
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
        "vectors",
    )
    n = max(1, distinct.count())
    share = min(1.0, sample_rows / n)
    drawn = distinct.where(F.pmod(F.xxhash64("embedding"), F.lit(1 << 32)) < int(share * (1 << 32)))
    sample, good = unit_rows(drawn.select("embedding").toArrow().column("embedding").to_pylist(), width)
    projection, thresholds, chosen = layout(sample[good], n, least, recall, bits, tables, bucket_rows, size, seed, most_tables)

    def index(batches):
        for batch in batches:
            embeddings = batch.column("embedding").to_pylist()
            flat, good = unit_rows(embeddings, width)
            keys = table_keys(encode(flat, projection, thresholds), chosen)
            number = np.arange(len(chosen), dtype=np.int64) << 32
            yield batch.column("rep"), batch.column("copies"), [_packed(x) for x in embeddings], list(keys + number), good

    coded = map_arrow(
        distinct.select("rep", "copies", "embedding"),
        index,
        "rep long, copies long, vector binary, buckets array<long>, good boolean",
    )
    coded = stored(coded.where("good and rep is not null").drop("good"), "codes")
    entries = coded.select("rep", "copies", F.explode("buckets").alias("bucket"))
    units = cross_blocks(entries, "bucket", F.lit(False), F.xxhash64("rep"), block)
    placed = units.join(coded.select(F.col("rep").alias("_rep"), "vector"), F.col("rep") == F.col("_rep"))

    def compare(batches):
        for table in runs(batches, "unit"):
            rows, _ = unit_rows([_unpacked(x, width) for x in table.column("vector").to_pylist()], width)
            keys = table_keys(encode(rows, projection, thresholds), chosen)
            yield from _compared(table, rows, keys, least)

    # One line per vector and block: the links met there, and the vector that joins it to their group.
    met = stored(
        map_arrow(by_unit(placed.drop("_rep"), "unit"), compare, "a long, n long, b long"), "links"
    )
    groups = components(met.where("b is not null and a != b").select("a", "b"))
    counts = met.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    result = (
        distinct.select("embedding", "rep", "copies")
        .join(counts, F.col("rep") == F.col("id"), "left")
        .drop("id")
        .join(groups, F.col("rep") == F.col("id"), "left")
        .select(
            F.col("embedding").alias("_embedding"),
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
            F.coalesce("component", "rep").alias("group"),
        )
    )
    linked = rows.join(result, F.col("embedding") == F.col("_embedding"), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("group", "vec_id"))
    return linked.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _packed(vector: list[float]) -> bytes:
    """The components, in four bytes each where that loses nothing."""
    wide = np.array(vector, np.float64)
    narrow = wide.astype(np.float32)
    return narrow.tobytes() if (narrow == wide).all() else wide.tobytes()


def _unpacked(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, np.float32 if len(raw) == 4 * width else np.float64)


def _compared(table, rows: np.ndarray, keys: np.ndarray, least: float):
    """Links within one unit: (vector, number of links, another vector of its group or null)."""
    side = np.asarray(table.column("side"))
    rep, copies = (np.asarray(table.column(c)) for c in ("rep", "copies"))
    own = table.column("bucket")[0].as_py() >> 32
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side == 1) if (side == 0).any() else left
    if not len(left) or not len(right):
        return
    near = rows[left] @ rows[right].T >= least
    if right is left:
        near &= np.arange(len(left))[:, None] < np.arange(len(left))[None, :]
    i, j = np.nonzero(near)
    i, j = left[i], right[j]
    first = np.ones(len(i), bool)
    for t in range(own):
        first &= keys[i, t] != keys[j, t]
    i, j = i[first], j[first]
    if not len(i):
        return
    links = np.bincount(i, copies[j], len(rep)) + np.bincount(j, copies[i], len(rep))
    root = list(range(len(rep)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    joined = 0
    for a, b in zip(i.tolist(), j.tolist()):
        a, b = top(a), top(b)
        if a != b:
            root[b] = a
            joined += 1
            if joined == len(rep) - 1:
                break
    some = np.flatnonzero(links)
    yield rep[some], links[some].astype(np.int64), np.array([rep[top(x)] for x in some.tolist()])
