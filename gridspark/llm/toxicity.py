"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

A bounded sample of labelled rows gives the vocabulary (features that depend on the label) and the
examples. Document frequencies are counted over all documents. The index is an inverted file in
blocks of examples; each feature has its largest weight in each block, and a block is opened only
while its bound can still reach the K nearest, so the neighbours are exact. Their votes, weighted
by distance, are calibrated on the examples themselves, each voted on without itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridspark.llm.common import blocks, held_out, signed, staged
from gridspark.llm.features import distinct, features, lookup

# Bounds of the fit: labelled examples of each class, and features kept.
EXAMPLES_PER_CLASS, VOCABULARY = 4000, 4096
# A feature must be this unlikely to be independent of the label (likelihood ratio, 1 degree of freedom).
LEAST_RATIO = 24.0
BLOCK, K = 64, 15
THRESHOLD = 0.3
EVIDENCE = 3


def sampled(docs: DataFrame, labels: DataFrame, label: str) -> tuple[DataFrame, dict[int, int]]:
    """Texts and labels of at most EXAMPLES_PER_CLASS rows of each class outside the held-out fold,
    smallest hashes of ids first, and the number of labelled rows of each class."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter(
        "doc_id IS NOT NULL AND label IN (0, 1)").filter(~held_out(F.col("doc_id")))
    counts = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    ids = known.filter("label = 0").orderBy(order, "doc_id").limit(EXAMPLES_PER_CLASS).unionByName(
        known.filter("label = 1").orderBy(order, "doc_id").limit(EXAMPLES_PER_CLASS)).dropDuplicates(["doc_id"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return staged(rows.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]), "examples"), counts


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """feature, examples of class 0 and of class 1 that have it, combined per block of texts."""
    for batch in batches:
        label = batch.column(1).to_numpy()
        for block in blocks(batch.column(0)):
            rows, hashes, _ = distinct(*features(block))
            toxic = label[block.first:block.first + block.rows][rows]
            names, place = np.unique(hashes, return_inverse=True)
            n = np.bincount(place, minlength=len(names))
            ones = np.bincount(place, weights=toxic, minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed(names)), pa.array(n - ones), pa.array(ones)], names=["feature", "n0", "n1"])


def vocabulary(examples: DataFrame) -> np.ndarray:
    """Sorted hashes of the features that depend on the label most."""
    totals = {row["label"]: row["n"] for row in examples.groupBy("label").agg(F.count("*").alias("n")).collect()}
    all0, all1 = totals.get(0, 0), totals.get(1, 0)
    if not all0 or not all1:
        return np.zeros(0, np.uint64)
    seen = examples.select("text", "label").mapInArrow(counted, "feature long, n0 long, n1 long").groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).filter("n0 + n1 >= 5")

    def part(n: str, total: int) -> str:
        expected = f"((n0 + n1) * {total}D / {all0 + all1})"
        return f"if({n} > 0, {n} * ln({n} / {expected}), 0D) + if({total} > {n}, ({total} - {n}) * ln(({total} - {n}) / ({total} - {expected})), 0D)"

    ratio = F.expr(f"2 * ({part('n0', all0)} + {part('n1', all1)})")
    top = seen.withColumn("ratio", ratio).filter(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "feature").limit(VOCABULARY)
    return np.sort(np.array([row["feature"] for row in top.select("feature").collect()], np.int64).view(np.uint64))


def document_counts(docs: DataFrame, words: np.ndarray) -> tuple[np.ndarray, int]:
    """Over all documents: how many have each feature of the vocabulary, and how many there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(words), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for block in blocks(batch.column(0)):
                rows, places = lookup(words, *features(block))
                total += np.bincount(np.unique(rows * len(words) + places) % max(1, len(words)), minlength=len(words))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(-1, len(words))), pa.array(np.concatenate([[n], total]))], names=["place", "n"])

    sums = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    found = {row["place"]: row["n"] for row in sums}
    return np.array([found.get(i, 0) for i in range(len(words))], np.int64), found.get(-1, 0)


class Sparse:
    """Rows of (feature, weight), flat."""

    def __init__(self, bounds: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
        self.bounds, self.place, self.value = bounds, place, value

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.bounds))

    def take(self, rows: np.ndarray) -> "Sparse":
        sizes = np.diff(self.bounds)[rows]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.bounds[rows] - bounds[:-1], sizes) + np.arange(bounds[-1])
        return Sparse(bounds, self.place[at], self.value[at])


class Vectors:
    """TF-IDF vectors of unit length over the vocabulary."""

    def __init__(self, words: np.ndarray, frequency: np.ndarray, documents: int) -> None:
        self.words = words
        self.weight = np.log((1 + documents) / (1 + frequency)) + 1

    def of(self, block) -> Sparse:
        rows, places = lookup(self.words, *features(block))
        key, count = np.unique(rows * len(self.words) + places, return_counts=True)
        row, place = key // max(1, len(self.words)), key % max(1, len(self.words))
        value = (1 + np.log(count)) * self.weight[place]
        length = np.sqrt(np.bincount(row, weights=value * value, minlength=block.rows))
        return Sparse(np.searchsorted(row, np.arange(block.rows + 1)), place, value / length[row])


class Index:
    """Inverted lists in blocks of examples, with each feature's largest weight in each block."""

    def __init__(self, vectors: Sparse, size: int) -> None:
        # Examples with the same strongest feature lie in one block, so that bounds are tight.
        strongest = np.full(len(vectors), size)
        by = np.lexsort((-vectors.value, vectors.rows))
        full = np.flatnonzero(np.diff(vectors.bounds))
        strongest[full] = vectors.place[by][vectors.bounds[full]]
        self.order = np.lexsort((np.arange(len(vectors)), strongest))
        self.vectors, self.size, self.blocks = vectors.take(self.order), size, -(-len(vectors) // BLOCK)
        self.lists: list[tuple[np.ndarray, np.ndarray]] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"lists": None}

    def open(self) -> None:
        """Lay out the lists of each block: its features, and their weights in its examples."""
        self.lists, self.bound = [], np.zeros((self.size, self.blocks))
        for b in range(self.blocks):
            own = self.vectors.take(np.arange(b * BLOCK, min((b + 1) * BLOCK, len(self.vectors))))
            names, at = np.unique(own.place, return_inverse=True)
            weights = np.zeros((len(names), BLOCK))
            weights[at, own.rows] = own.value
            self.lists.append((names, weights))
            self.bound[names, b] = weights.max(axis=1) if len(names) else 0

    def nearest(self, queries: Sparse, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each query the K examples of largest cosine above 0, ties by example, and their cosines;
        -1 and 0 where there are fewer. Queries open their blocks by falling bound, all their next
        ones at a time, until the bound is below their K-th cosine."""
        if self.lists is None:
            self.open()
        n = len(queries)
        dense = np.zeros((n, self.size))
        dense[queries.rows, queries.place] = queries.value
        bounds = dense @ self.bound
        turns = np.argsort(-bounds, axis=1, kind="stable")
        near, cosine = np.full((n, K), -1), np.zeros((n, K))
        active = np.arange(n)
        for turn in range(self.blocks):
            block = turns[active, turn]
            reach = bounds[active, block]
            keep = (reach > 0) & (reach >= cosine[active, -1] - 1e-9)
            active, block = active[keep], block[keep]
            if not len(active):
                break
            found = np.zeros((len(active), BLOCK))
            for b in np.unique(block):
                own = np.flatnonzero(block == b)
                names, weights = self.lists[b]
                found[own] = dense[np.ix_(active[own], names)] @ weights
            # Equal cosines must tie whatever the order of their sums.
            found = np.round(found, 9)
            place = block[:, None] * BLOCK + np.arange(BLOCK)
            example = np.where(found > 0, self.order[np.minimum(place, len(self.order) - 1)], -1)
            if without is not None:
                example[example == without[active][:, None]] = -1
            found[example < 0] = 0
            some = np.flatnonzero(found.max(axis=1) >= np.maximum(cosine[active, -1], 1e-9))
            rows = active[some]
            both, names = np.hstack([cosine[rows], found[some]]), np.hstack([near[rows], example[some]])
            best = np.lexsort((names, -both), axis=1)[:, :K]
            near[rows], cosine[rows] = np.take_along_axis(names, best, 1), np.take_along_axis(both, best, 1)
        near[cosine <= 0] = -1
        return near, cosine


def vote(labels: np.ndarray, near: np.ndarray, cosine: np.ndarray, alone: float) -> np.ndarray:
    """Share of toxic neighbours, the nearer the heavier; the rate of unmatched examples pulls it
    towards itself where cosines are small."""
    weight = cosine / (1.05 - np.minimum(cosine, 1))
    toxic = labels[near] if len(labels) else np.zeros(near.shape)
    return ((weight * toxic).sum(axis=1) + 0.2 * alone) / (weight.sum(axis=1) + 0.2)


def monotone(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling: vote and calibrated probability at the middle of each pool."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []
    for r, y, w in zip(raw[order], labels[order], weights[order]):
        pools.append([r * w, y * w, w])
        while len(pools) > 1 and (pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2] or pools[-2][0] / pools[-2][2] >= pools[-1][0] / pools[-1][2]):
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([(p[1] + 0.5 * w0) / (p[2] + w0) for p in pools for w0 in [weights.mean()]])


class Model:
    """All that scoring needs; its size is bounded by the sample and the vocabulary."""

    def __init__(self, vectors: Vectors, index: Index, ids: np.ndarray, labels: np.ndarray, alone: float, knots: tuple[np.ndarray, np.ndarray]) -> None:
        self.vectors, self.index, self.ids, self.labels, self.alone, self.knots = vectors, index, ids, labels, alone, knots

    def score(self, block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score of each text, its nearest examples and their cosines."""
        near, cosine = self.index.nearest(self.vectors.of(block))
        raw = vote(self.labels, near, cosine, self.alone)
        calibrated = np.interp(raw, *self.knots) if len(self.knots[0]) else raw
        return np.clip(0.999 * calibrated + 0.001 * raw, 0, 1), near, cosine


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Learn from labelled rows outside the held-out fold."""
    examples, counts = sampled(docs, labels, label)
    words = vocabulary(examples)
    vectors = Vectors(words, *document_counts(docs, words))

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                own = vectors.of(block)
                ends = pa.array(own.bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(block.first, block.rows), batch.column(1).slice(block.first, block.rows),
                    pa.ListArray.from_arrays(ends, pa.array(own.place)), pa.ListArray.from_arrays(ends, pa.array(own.value)),
                ], names=["doc_id", "label", "place", "value"])

    rows = sorted(examples.select("doc_id", "label", "text").mapInArrow(
        embed, "doc_id long, label int, place array<long>, value array<double>").collect(), key=lambda r: r["doc_id"])
    flat = Sparse(np.concatenate([[0], np.cumsum([len(r["place"]) for r in rows])]).astype(np.int64),
                  np.array([x for r in rows for x in r["place"]], np.int64), np.array([x for r in rows for x in r["value"]], np.float64))
    truth = np.array([r["label"] for r in rows], np.float64)
    # The sample takes classes alike; weights give each class its share among labelled rows.
    share = np.array([counts.get(int(y), 0) / max(1, (truth == y).sum()) for y in truth])
    none = np.diff(flat.bounds) == 0
    total = share[none].sum() if none.any() else 0.0
    alone = float((share[none] @ truth[none]) / total) if total else float(counts.get(1, 0) / max(1, sum(counts.values())))
    index = Index(flat, len(words))
    raw = [vote(truth, *index.nearest(flat.take(own), without=own), alone) for own in np.array_split(np.arange(len(rows)), 1 + len(rows) // 500)]
    knots = monotone(np.concatenate(raw), truth, share) if len(rows) else (np.zeros(0), np.zeros(0))
    return Model(vectors, index, np.array([r["doc_id"] for r in rows], np.int64), truth, alone, knots)


SCORED = "doc_id long, score double, neighbours array<struct<doc_id: long, label: int, cosine: double>>"


def scorer(model: Model):
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                scores, near, cosine = model.score(block)
                top, heavy = near[:, :EVIDENCE], cosine[:, :EVIDENCE]
                some = top >= 0
                chosen = top[some]
                evidence = pa.StructArray.from_arrays([
                    pa.array(model.ids[chosen]), pa.array(model.labels[chosen].astype(np.int32)), pa.array(heavy[some])], fields=list(kind.value_type))
                ends = np.concatenate([[0], np.cumsum(some.sum(axis=1))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(block.first, block.rows), pa.array(scores), pa.ListArray.from_arrays(pa.array(ends), evidence),
                ], names=["doc_id", "score", "neighbours"])

    return score


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted and the nearest examples of every row.

    Null and empty texts, and texts without any feature of the vocabulary, get the calibrated rate
    of such examples; without labels of both classes every score is the rate of toxic labels (0
    without any). Null or repeated ids and repeated rows are scored as they are; an empty table
    gives no rows; further columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scorer(model), SCORED).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "neighbours")


def keep_harmless(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` below the threshold, with their columns, in one pass without a shuffle."""
    schema = docs.schema
    text = schema.fieldNames().index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = [model.score(block)[0] < THRESHOLD for block in blocks(batch.column(text))]
            yield batch.filter(pa.array(np.concatenate(stay) if stay else np.zeros(0, bool)))

    return docs.mapInArrow(keep, schema)
