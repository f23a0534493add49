"""Quality by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are labelled good rows outside the held-out fold; unlabelled text is all
documents, whatever they are. The share of good text in the latter is estimated from how the two
score, a linear model minimises the non-negative risk for that share, and its threshold is the
score that keeps positives and unlabelled text furthest apart. Only the gradient steps take a
sample of unlabelled text; scaling, share and threshold come from passes over all of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridspark.llm.common import Block, blocks, held_out, staged, words_of

# Bounds of the fit: trusted positives, and unlabelled texts of the gradient steps.
POSITIVES = UNLABELLED = 5000
THRESHOLD = 0.7
# Cells of the histogram of scores; parts of 1 in which features are summed, exactly in any order.
CELLS, PARTS = 4096, 1024
STEPS, RATE, DECAY = 400, 0.05, 1e-4

# Byte classes: letters of either case, digits, blanks, line ends, other scripts, and each ASCII mark by itself.
MARKS = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
CLASS = np.full(256, 6, dtype=np.int64)
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[[32, 9]], CLASS[[10, 11, 12, 13]], CLASS[128:] = 0, 1, 2, 3, 4, 5
CLASS[MARKS] = 7 + np.arange(len(MARKS))
CLASSES = 7 + len(MARKS)
LAGS = (1, 2, 3, 5, 8)
LONG = (1, 2, 4, 6, 8, 12, 16)
WIDTH = CLASSES * CLASSES + len(LAGS) + len(LONG) + 2


def vectors(block: Block) -> np.ndarray:
    """A text's style: neighbouring byte classes, repeats of words at short distances, word lengths,
    and size. The language and the words themselves are not looked at."""
    out = np.zeros((block.rows, WIDTH), np.float32)
    kinds = CLASS[block.data]
    words = words_of(block, lower=True)
    rows, sizes = words.rows, np.diff(words.bounds)
    lengths = words.ends - words.starts
    at = CLASSES * CLASSES
    for i, (begin, end) in enumerate(zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist())):
        if end - begin > 1:
            pairs = np.bincount(kinds[begin:end - 1] * CLASSES + kinds[begin + 1:end], minlength=at)
            out[i, :at] = np.log1p(pairs * (1000.0 / (end - begin)))
    n = np.maximum(sizes, 1)
    for k, lag in enumerate(LAGS):
        same = np.flatnonzero((words.hashes[lag:] == words.hashes[:-lag]) & (rows[lag:] == rows[:-lag])) if len(rows) > lag else np.zeros(0, np.int64)
        out[:, at + k] = np.bincount(rows[same], minlength=block.rows) / n * 10
    at += len(LAGS)
    for k, least in enumerate(LONG):
        out[:, at + k] = np.bincount(rows[lengths > least], minlength=block.rows) / n * 3
    out[:, -2] = np.log1p(sizes)
    out[:, -1] = sizes == 0
    return out


def sample_vectors(rows: DataFrame) -> np.ndarray:
    """Vectors of a bounded sample, in the order of ids."""

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(block.first, block.rows), pa.array([v.tobytes() for v in vectors(block).astype(np.float16)], pa.binary()),
                ], names=["doc_id", "vector"])

    found = sorted(rows.mapInArrow(embed, "doc_id long, vector binary").collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"], bytes(r["vector"])))
    return np.frombuffer(b"".join(r["vector"] for r in found), np.float16).astype(np.float32).reshape(-1, WIDTH)


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each feature over all rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, one, two = 0, np.zeros(WIDTH, np.int64), np.zeros(WIDTH, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                parts = np.rint(vectors(block) * PARTS).astype(np.int64)
                n, one, two = n + block.rows, one + parts.sum(axis=0), two + (parts * parts).sum(axis=0)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(WIDTH, dtype=np.int32)), pa.array(np.full(WIDTH, n)), pa.array(one), pa.array(two)], names=["at", "n", "one", "two"])

    found = rows.select("text").mapInArrow(add, "at int, n long, one long, two long").groupBy("at").agg(
        F.sum("n").alias("n"), F.sum("one").alias("one"), F.sum("two").alias("two")).orderBy("at").collect()
    n, one, two = (np.array([r[x] for r in found], np.float64) for x in ("n", "one", "two"))
    mean = one / n
    return mean / PARTS, np.sqrt(np.maximum(0, two / n - mean * mean)) / PARTS


def scaled(x: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((x - centre) / spread, -8, 8).astype(np.float32)


def histogram(rows: DataFrame, centre: np.ndarray, spread: np.ndarray, weights: np.ndarray, offset: float,
              low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Middles of cells between two scores and how many of all rows score there; the outermost cells
    take what lies beyond."""
    wide = max(high - low, 1e-9) / CELLS

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(CELLS, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                scores = scaled(vectors(block), centre, spread) @ weights + offset
                count += np.bincount(np.clip((scores - low) / wide, 0, CELLS - 1).astype(np.int64), minlength=CELLS)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some])], names=["cell", "n"])

    found = rows.select("text").mapInArrow(add, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").collect()
    return low + (np.array([r["cell"] for r in found], np.float64) + 0.5) * wide, np.array([r["n"] for r in found], np.float64)


def share_above(scores: np.ndarray, cuts: np.ndarray, count: np.ndarray | None = None) -> np.ndarray:
    """Share of scores, each counted so many times, that are not below each cut."""
    order = np.argsort(scores)
    below = np.concatenate([[0], np.cumsum(np.ones(len(scores)) if count is None else count[order])])
    return 1 - below[np.searchsorted(scores[order], cuts)] / below[-1]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and offset of least non-negative risk with the logistic loss, by Adam.

    Risk: prior * loss(positive, +) + max(0, loss(unlabelled, -) - prior * loss(positive, -)). Where
    the second part falls below 0 its gradient is reversed, as the non-negative estimator demands.
    """
    w, m, v = (np.zeros(positive.shape[1] + 1) for _ in range(3))
    p, u = (np.hstack([x, np.ones((len(x), 1), np.float32)]) for x in (positive, unlabelled))
    for step in range(1, STEPS + 1):
        fp, fu = p @ w, u @ w
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        toward = -prior * (sigmoid(-fp) @ p) / len(p)
        away = (sigmoid(fu) @ u) / len(u) - prior * (sigmoid(fp) @ p) / len(p)
        slope = (toward + away if negative >= 0 else -away) + DECAY * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, count: np.ndarray | None = None) -> float:
    """Largest share of the positives' scores that the unlabelled scores leave room for: the least
    ratio of upper tails, each with its sampling error (best-bin estimate)."""
    if not len(positive) or not len(unlabelled):
        return 0.5
    cuts = np.quantile(positive, np.linspace(0, 0.5, 51))
    up, uu = share_above(positive, cuts), share_above(unlabelled, cuts, count)
    error = np.sqrt(np.log(20) / 2 / len(positive)) + np.sqrt(np.log(20) / 2 / (len(unlabelled) if count is None else count.sum()))
    best = np.argmin((uu + error) / np.maximum(up, 1e-9))
    return float(np.clip(uu[best] / up[best], 0.02, 0.98))


class Model:
    """Scaling, weights and offset; a fixed size."""

    def __init__(self, centre: np.ndarray, spread: np.ndarray, weights: np.ndarray, offset: float, prior: float) -> None:
        self.centre, self.spread, self.weights, self.offset, self.prior = centre, spread, weights, offset, prior

    def score(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(((rows - self.centre) / self.spread) @ self.weights + self.offset)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Learn from good rows outside the held-out fold and from documents without their labels."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = F.xxhash64("doc_id")
    good = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label")).filter(
        "label = 1 AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id"))).select("doc_id").distinct().orderBy(order, "doc_id").limit(POSITIVES)
    # Another order than the positives', so that the samples overlap by chance only.
    other = rows.select("doc_id").filter("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(UNLABELLED)
    picked = good.withColumn("trusted", F.lit(True)).unionByName(other.withColumn("trusted", F.lit(False)))
    sample = staged(rows.join(F.broadcast(picked), "doc_id"), "sample")
    positive, unlabelled = (sample_vectors(sample.filter(x).select("doc_id", "text")) for x in ("trusted", "NOT trusted"))
    width = np.zeros(WIDTH)
    if not len(positive) or not len(unlabelled):
        return Model(width, width + 1, width, 0.0, 0.5)
    centre, spread = moments(rows)
    spread = spread + 0.05
    positive, unlabelled = (scaled(x, centre, spread) for x in (positive, unlabelled))

    def everywhere(weights: np.ndarray, offset: float) -> tuple[np.ndarray, np.ndarray]:
        seen = np.concatenate([positive, unlabelled]) @ weights + offset
        return histogram(rows, centre, spread, weights, offset, float(seen.min()), float(seen.max()))

    # One half of the positives is learnt from for the estimate, the other half is compared.
    half = len(positive) // 2
    weights, offset = minimise(positive[:max(1, half)], unlabelled, 0.5)
    prior = estimate_prior(positive[half:] @ weights + offset, *everywhere(weights, offset))
    weights, offset = minimise(positive, unlabelled, prior)
    cut = threshold(positive @ weights + offset, *everywhere(weights, offset))
    return Model(centre, spread, weights, offset - cut + float(np.log(THRESHOLD / (1 - THRESHOLD))), prior)


def threshold(positive: np.ndarray, unlabelled: np.ndarray, count: np.ndarray | None = None) -> float:
    """The score that separates best. The share of positives above a cut less that of unlabelled text
    is (1 - prior) times the cut's true less its false positive rate, so its largest value needs no
    labels of bad text; of the cuts within the sampling error of it, the one
    where unlabelled scores are rarest is taken."""
    cuts = np.unique(np.concatenate([positive, unlabelled]))
    above = [share_above(positive, cuts), share_above(unlabelled, cuts, count)]
    total = len(unlabelled) if count is None else count.sum()
    gain = above[0] - above[1]
    good = cuts[gain >= gain.max() - 0.5 * np.sqrt(1 / len(positive) + 1 / total)]
    if good[0] == good[-1]:
        return float(good[0])
    held, edges = np.histogram(unlabelled, bins=np.linspace(good[0], good[-1], 21), weights=count)
    bare = int(held.argmin())
    return float((edges[bare] + edges[bare + 1]) / 2)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null and empty texts are scored as texts without any byte. Without trusted positives or
    documents every score is 0.5. Null or repeated ids and repeated rows are scored as they are; an
    empty table gives no rows; further columns are ignored.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(block.first, block.rows), pa.array(model.score(vectors(block)).astype(np.float64)),
                ], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
