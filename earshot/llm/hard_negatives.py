"""Hard negatives by threshold joins over an inverted index, after the manner of L2AP."""

from __future__ import annotations

from functools import reduce
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from earshot.llm.common import map_arrow, stored

#: Largest squared length of a vector of whole numbers: inner products are then exact in doubles.
LARGEST = 2.0**52

#: Dimensions that stand together in a list of the index.
STEP = 8

#: Scores are whole numbers, so bounds computed in doubles may be off by this and decide nothing wrong.
SLACK = 0.5

#: Rows indexed together, and pairs of an anchor and a row that are accumulated at a time.
ROWS, PAIRS = 4096, 1 << 21

#: How many more scores each lower threshold is expected to reach, and how often it is lowered before
#: it falls to the end of the window.
WIDER, LOWERED = 16, 3


def _floor(x: Column) -> Column:
    """The largest whole number not above `x`, as a double of any size."""
    whole = F.rint(x)
    return F.when(whole > x, whole - 1).otherwise(whole)


def whole_vectors(vectors: DataFrame, label: Column, scale: float = 256.0) -> DataFrame:
    """(vec_id, label, vector): the rows that take part, each component x as floor(scale * x)."""
    wide = vectors.select("vec_id", label.alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite
    scaled = wide.where(good).withColumn("vector", F.transform("vector", lambda x: _floor(x * scale)))
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    return scaled.where(length <= LARGEST)


class Asked:
    """Anchors with the windows they ask for. A window wants the `most` first rows, by falling score and
    rising vec_id, whose score lies from `low` to `high`."""

    def __init__(self, ids, labels, vectors: np.ndarray, order: np.ndarray, most: int):
        self.ids, self.labels, self.most, self.order = ids, labels, most, order
        self.vectors = vectors[:, order]
        self.rest = rest_norms(self.vectors)

    def ask(self, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, tags: list[np.ndarray]) -> "Asked":
        """These windows, in the order of their anchors; `tags` come back with what is found."""
        by_anchor = np.argsort(anchor, kind="stable")
        self.anchor, self.low, self.high = anchor[by_anchor], low[by_anchor], high[by_anchor]
        self.tags = [t[by_anchor] for t in tags]
        self.same = same
        self.asking, self.start = np.unique(self.anchor, return_index=True)
        self.many = np.diff(np.append(self.start, len(self.anchor)))
        self.least = np.minimum.reduceat(self.low, self.start) if len(self.low) else np.zeros(0)
        return self


def rest_norms(vectors: np.ndarray) -> np.ndarray:
    """Length of what each row has from dimension g * STEP on, in column g; 0 in a last column."""
    cuts = np.arange(0, vectors.shape[1], STEP)
    squares = np.add.reduceat(vectors**2, cuts, axis=1) if len(cuts) else np.zeros((len(vectors), 0))
    rest = np.zeros((len(vectors), len(cuts) + 1))
    rest[:, :-1] = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(rest)


class Index:
    """An inverted index of a block of rows, its lists by STEP dimensions, for scores of at least `floor`
    times the length of the vector asked with.

    What a row has from some dimension on is omitted if its length is below `floor`: a pair that meets only
    there cannot reach the threshold. Rows stand in the order of what is indexed of them, so the list of
    each dimension is the first rows of the block.
    """

    def __init__(self, vectors: np.ndarray, floor: float):
        rest = rest_norms(vectors)
        indexed = (rest[:, :-1] >= floor).sum(axis=1)
        self.order = np.argsort(-indexed, kind="stable")
        self.vectors, self.rest, self.indexed = vectors[self.order], rest[self.order], indexed[self.order]
        self.listed = [int((indexed > g).sum()) for g in range(rest.shape[1] - 1)]

    def reach(self, asked: np.ndarray, rest: np.ndarray, least: np.ndarray, fits: np.ndarray):
        """(i, j, score) for the pairs of the `asked` vectors and rows where `fits` holds and the score is
        `least[i]` or more.

        Partial scores are accumulated list by list. Now and then the pairs that cannot reach `least` any
        more, because their partial score and the lengths of their rests, what is omitted included, fall
        short, are dropped; few that remain are finished one by one.
        """
        lists = len(self.listed)
        partial, alive = np.zeros(fits.shape), fits
        for g in range(lists + 1):
            if g in (0, lists // 4, lists // 2, 3 * lists // 4, lists):
                done = np.minimum(self.indexed, g)
                bound = rest[:, done] * self.rest[np.arange(len(done)), done]
                alive = fits & (partial + bound >= least[:, None] - SLACK)
                if alive.sum() * 32 < alive.size:
                    break
            if g < lists:
                n, d = self.listed[g], slice(g * STEP, (g + 1) * STEP)
                partial[:, :n] += asked[:, d] @ self.vectors[:n, d].T
        # Scores are sums of whole numbers, exact in any order.
        i, j = np.nonzero(alive)
        score = np.empty(len(i))
        for at in range(0, len(i), 1 << 15):
            part = slice(at, at + (1 << 15))
            score[part] = np.einsum("ij,ij->i", asked[i[part]], self.vectors[j[part]])
        enough = score >= least[i]
        return i[enough], self.order[j[enough]], score[enough]


def _first(window: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` first of each window."""
    order = np.lexsort((ids, -score, window))
    ranked = window[order]
    start = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, np.int64)
    at = np.arange(len(ranked)) - np.repeat(start, np.diff(np.append(start, len(ranked))))
    return order[at < most]


def block_answers(asked: Asked, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
    """(window, place in the block, score): what a block of rows has for the windows asked for."""
    vectors = vectors[:, asked.order]
    lengths = np.maximum(asked.rest[asked.asking, 0], 1e-9)
    # Anchors whose thresholds are alike are asked together, so that the lists omit the more.
    floors = (asked.least - SLACK) / lengths
    ranked = np.argsort(-floors, kind="stable")
    across = max(1, PAIRS // max(1, len(ids)))
    found = []
    for top in range(0, len(ranked), across):
        some = ranked[top : top + across]
        anchors = asked.asking[some]
        index = Index(vectors, float(floors[some].min()))
        fits = (asked.labels[anchors][:, None] == labels[index.order][None, :]) == asked.same
        fits &= asked.ids[anchors][:, None] != ids[index.order][None, :]
        i, j, score = index.reach(asked.vectors[anchors], asked.rest[anchors], asked.least[some], fits)
        # Each pair is offered to every window of its anchor.
        times = asked.many[some][i]
        pair = np.repeat(np.arange(len(i)), times)
        window = np.repeat(asked.start[some][i], times) + np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
        inside = (score[pair] >= asked.low[window]) & (score[pair] <= asked.high[window])
        window, j, score = window[inside], j[pair[inside]], score[pair[inside]]
        keep = _first(window, score, ids[j], asked.most)
        found.append((window[keep], j[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _matrix(column, width: int) -> np.ndarray:
    """A list column without nulls as rows of doubles."""
    return np.asarray(column.flatten(), np.float64).reshape(-1, width)


def _search(rows: DataFrame, asked: Asked, width: int) -> DataFrame:
    """(window, anchor_id, tag0, tag1, last, vec_id, score, rank, n): the first rows of each window of `asked` and
    their number. All rows are looked at, in blocks that each make their own index."""
    shared = rows.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        ask = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids, labels = np.asarray(batch.column("vec_id")), np.asarray(batch.column("label"))
                window, j, score = block_answers(ask, ids, labels, _matrix(batch.column("vector"), width))
                yield (
                    window,
                    ask.ids[ask.anchor[window]],
                    *(t[window] for t in ask.tags),
                    ids[j],
                    score.astype(np.int64),
                )

    found = map_arrow(
        rows,
        run,
        "window long, anchor_id long, tag0 long, tag1 long, last boolean, vec_id long, score long",
    )
    # A block sends the first few of a window only, and a task again only the first few of its blocks.
    order = Window.partitionBy("window").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= asked.most)
    ranked = ranked.withColumn("n", F.max("rank").over(Window.partitionBy("window")))
    out = stored(ranked, "windows")
    shared.unpersist()
    return out


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column | None = None,
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    sample_rows: int = 2000,
    anchor_bytes: int = 8 << 20,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of `vectors`
    (vec_id, embedding) that are `anchors`, against all rows.

    Components are taken as floor(scale * x), scores are inner products. An anchor's positives are the
    first `positives` other rows of its label, higher scores first, ties by smaller vec_id. For each of
    them, negatives are the first `negatives` rows of another label whose score is at most the positive's
    and at least `least_percent` hundredths of it. `label` defaults to the column of that name
    (labels that are no whole numbers are told apart by their 64-bit hash).

    Method: all rows are indexed in blocks, dimensions of much weight first; the index omits of each row
    the rest whose length cannot reach the threshold, scores are accumulated list by list and pairs
    dropped once the lengths of their rests cannot make up for what is missing (`Index`). Thresholds
    start where the mean and spread of an anchor's scores, taken from about `sample_rows` rows, lead to
    expect some rows more than a window holds, and are lowered for the windows that did not fill, in the
    end to where the window ends; so the sample decides how fast the answer comes, never what it is.
    Anchors are broadcast in parts of about `anchor_bytes`, each asked against all rows by a scan, which is the
    search of a stated set in blocks: rows are never joined with rows.

    Null vec_id, label or vector, null or non-finite components, and vectors of another width than the
    most common one (ties: the smaller) take no part; neither do those whose components are so large (squares summing to
    more than 2^52, about 2^18 before scaling) that scores would not be exact. Rows with one vec_id are
    different rows, but never each other's positives; equal anchors are asked once. Anchors without
    positives, and positives of a negative score, have no rows. Empty table: no rows. Other columns are
    ignored.
    """
    spark = vectors.sparkSession
    taking = whole_vectors(vectors, F.col("label") if label is None else label, scale)
    widths = taking.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    common = widths.orderBy(F.desc("n"), "width").first()
    columns = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if common is None:
        return spark.createDataFrame([], columns)
    width = common["width"]
    chosen = taking.where(F.size("vector") == width)
    whole = isinstance(chosen.schema["label"].dataType, IntegralType)
    number = F.col("label").cast("long") if whole else F.xxhash64("label")
    rows = stored(chosen.select("vec_id", number.alias("label"), "vector"), "vectors")
    n = rows.count()
    weight = rows.select(F.posexplode("vector").alias("d", "x")).groupBy("d").agg(F.sum(F.col("x") * F.col("x")).alias("w"))
    order = np.array([r["d"] for r in weight.orderBy(F.desc("w"), "d").collect()], np.int64)
    drawn = rows.where(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 32)) < int(min(1.0, sample_rows / n) * (1 << 32)))
    sample = _matrix(drawn.select("vector").limit(4 * sample_rows).toArrow().column("vector").combine_chunks(), width)
    mean = sample.mean(axis=0) if len(sample) else np.zeros(width)
    spread = np.cov(sample, rowvar=False).reshape(width, width) if len(sample) > 1 else np.eye(width)

    sizes = rows.groupBy(F.col("label").alias("_label")).agg(F.count(F.lit(1)).alias("n_same"))
    asking = rows.where(anchors).distinct().join(sizes, F.col("label") == F.col("_label"))
    asking = stored(asking.select("vec_id", "label", "vector", "n_same"), "anchors")
    parts = max(1, -(-asking.count() * (width + 4) * 8 // anchor_bytes))
    answers = []
    for part in range(parts):
        own = asking.where(F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(parts)) == part).toArrow()
        if not own.num_rows:
            continue
        asked = Asked(
            np.asarray(own.column("vec_id")),
            np.asarray(own.column("label")),
            _matrix(own.column("vector").combine_chunks(), width),
            order,
            positives,
        )
        plain = _matrix(own.column("vector").combine_chunks(), width)
        guess = Guess(plain @ mean, np.sqrt(np.maximum(np.einsum("ij,ij->i", plain @ spread, plain), 1e-9)))
        every = np.arange(own.num_rows)
        lowest, highest = np.full(len(every), -np.inf), np.full(len(every), np.inf)
        share = 1 / np.maximum(1.0, np.asarray(own.column("n_same"), np.float64))
        anchor, positive, score = [], [], []
        zeros = np.zeros(len(every), np.int64)
        for found in _lowered(rows, asked, every, lowest, highest, True, share, guess, [every, zeros], width):
            table = found.select("tag0", "vec_id", "score").toArrow()
            anchor.append(np.asarray(table.column("tag0")))
            positive.append(np.asarray(table.column("vec_id")))
            score.append(np.asarray(table.column("score")))
        anchor, positive, score = (np.concatenate(x) for x in (anchor, positive, score))
        some = score >= 0
        anchor, positive, score = anchor[some], positive[some], score[some]
        lowest = -(-least_percent * score // 100)
        asked.most = negatives
        share = np.full(len(anchor), 1 / n)
        answers += _lowered(rows, asked, anchor, lowest, score, False, share, guess, [positive, score], width)
    if not answers:
        return spark.createDataFrame([], columns)
    return reduce(DataFrame.union, answers).select(
        "anchor_id",
        F.col("tag0").alias("positive_id"),
        "rank",
        F.col("vec_id").alias("negative_id"),
        F.col("tag1").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


class Guess:
    """Where an anchor's scores may be expected, from their mean and deviation."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        self.mean, self.deviation = mean, deviation

    def below(self, anchor: np.ndarray, high: np.ndarray, share: np.ndarray) -> np.ndarray:
        """The scores between which and `high` that share of all scores should lie."""
        normal = NormalDist()
        mean, deviation = self.mean[anchor], self.deviation[anchor]
        above = [1 - normal.cdf(x) for x in np.clip((high - mean) / deviation, -9, 9).tolist()]
        tail = np.minimum(np.array(above) + share, 1 - 1e-9)
        return np.floor(mean + deviation * np.array([-normal.inv_cdf(max(x, 1e-18)) for x in tail.tolist()]))


def _lowered(rows, asked: Asked, anchor, lowest, high, same: bool, share, guess: Guess, tags, width: int) -> list[DataFrame]:
    """What windows from `lowest` to `high` hold, one frame a round: those that filled in it, or ended. A
    window is asked with a threshold at which about `share` a row wanted is expected, and once more with a lower one
    until it fills."""
    answers, open_, expected = [], np.arange(len(anchor)), 4.0 * asked.most
    for turn in range(LOWERED + 1):
        if not len(open_):
            break
        own, top = anchor[open_], high[open_]
        low = lowest[open_].astype(np.float64)
        if turn < LOWERED:
            low = np.maximum(low, np.minimum(guess.below(own, top, share[open_] * expected), top))
        last = low <= lowest[open_]
        asked.ask(own, low, top, same, [*(t[open_] for t in tags), last])
        found = _search(rows, asked, width)
        answers.append(found.where((F.col("n") == asked.most) | F.col("last")))
        full = found.where((F.col("rank") == 1) & (F.col("n") == asked.most)).select("window").toArrow()
        done = last.copy()
        # Windows are numbered in the order of their anchors.
        by_anchor = np.argsort(own, kind="stable")
        done[by_anchor[np.asarray(full.column("window"))]] = True
        open_, expected = open_[~done], expected * WIDER
    return answers
