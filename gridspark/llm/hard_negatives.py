"""Hard negatives by windows of scores, from blocks of candidates along a Hilbert curve.

Candidates are sorted by the Hilbert key of a projection and stored as blocks of neighbours, each
with a zone map: the least and greatest value of every component, and the labels it holds. Interval
arithmetic bounds what any row of a block can score with an anchor, so an anchor reads only blocks
that may hold rows of one of its windows of scores. A few likely blocks are read first; if they fill
a window, its lower end rises to the last row found, which rules further blocks out.

Scores are integer inner products. They are computed in floating point only where every sum is an
exact integer there, else with 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gridspark.llm.common import mix, ship, staged
from gridspark.llm.packing import hilbert

POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100
# Rows of a block, anchors that are asked together, zone maps that are read together.
BLOCK, PACK, PAGE = 512, 64, 128
SEEDS = 2
DIMENSIONS, BITS = 4, 10
FAR = 1 << 62
KINDS = (np.int8, np.int16, np.int32, np.int64)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers in the narrowest form that holds them; its width follows from the length."""
    least, most = (int(values.min()), int(values.max())) if values.size else (0, 0)
    kind = next(k for k in KINDS if np.iinfo(k).min <= least and most <= np.iinfo(k).max)
    return np.ascontiguousarray(values, kind).tobytes()


def unpacked(raw: bytes, rows: int, dimensions: int) -> np.ndarray:
    size = rows * dimensions
    kind = {np.dtype(k).itemsize: k for k in KINDS}[len(raw) // size] if size else np.int64
    return np.frombuffer(raw, kind).reshape(rows, dimensions).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of rows; components that only one side has count as zero."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    reach = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(d, 1)
    if reach < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def limit_of(dimensions: int) -> int:
    """Components up to this size cannot make a sum that 64 bits do not hold."""
    return int(((1 << 62) // max(dimensions, 1)) ** 0.5)


def rows_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and the matrix of a batch; shorter vectors end in zeros."""
    column = batch.column("vector")
    sizes = np.diff(column.offsets.to_numpy())
    matrix = np.zeros((batch.num_rows, int(sizes.max(initial=0))), np.int64)
    matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = column.flatten().to_numpy()
    reach = limit_of(matrix.shape[1])
    return batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), matrix.clip(-reach, reach)


def curve_key(matrix: np.ndarray) -> np.ndarray:
    """Hilbert key of each row's direction along a few fixed random axes."""
    d = matrix.shape[1]
    hashes = mix(np.arange(1, d * DIMENSIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    axes = ((hashes >> np.uint64(11)).astype(np.float64) / (1 << 53) - 0.5).reshape(d, DIMENSIONS)
    length = np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))
    places = matrix.astype(np.float64) @ axes / np.maximum(length, 1e-9)[:, None]
    return hilbert(((np.tanh(2 * places) + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64), BITS)


def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, _, matrix = rows_of(batch)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(curve_key(matrix), pa.int64())], names=["vec_id", "label", "vector", "curve"])


BLOCKS = "block long, n int, ids binary, labels binary, vectors binary, dimensions int, low binary, high binary, kinds array<long>"


def blocked(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows of a partition as blocks with their zone maps."""
        block = TaskContext.get().partitionId() << 33
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= size:
                table = pa.Table.from_batches(held).combine_chunks()
                whole = table.num_rows // size * size
                for begin in range(0, whole, size):
                    yield block_of(block, table.slice(begin, size))
                    block += 1
                held = table.slice(whole).to_batches() if whole < table.num_rows else []
        if held:
            yield block_of(block, pa.Table.from_batches(held))

    return run


def block_of(block: int, table: pa.Table) -> pa.RecordBatch:
    ids, labels, matrix = rows_of(pa.RecordBatch.from_struct_array(table.combine_chunks().to_struct_array().combine_chunks()))
    low, high = (matrix.min(axis=0), matrix.max(axis=0)) if matrix.shape[1] else (np.zeros(0, np.int64),) * 2
    row = (block, len(ids), ids.astype(np.int64).tobytes(), labels.astype(np.int64).tobytes(), packed(matrix), matrix.shape[1],
           low.tobytes(), high.tobytes(), np.unique(labels).tolist())
    return record(BLOCKS, [row])


TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def record(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(x, TYPES[k]) for x, k in zip(zip(*rows), kinds)], names=list(names))


ANCHORS = "anchor_no long, pack long, anchor_id long, label long, block long, place long, vector binary"


def anchors_of(every: int, pack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The anchors among a task's blocks, numbered and dealt into packs of neighbours."""
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                ids, labels = (np.frombuffer(x[name], np.int64) for name in ("ids", "labels"))
                matrix = unpacked(x["vectors"], x["n"], x["dimensions"])
                for place in np.flatnonzero(ids % every == 0).tolist():
                    rows.append((number, number // pack, int(ids[place]), int(labels[place]), x["block"], place, matrix[place].tobytes()))
                    number += 1
            if rows:
                yield record(ANCHORS, rows)

    return run


REQUESTS = "block long, nos binary, labels binary, blocks binary, places binary, vectors binary, dimensions int, lows binary, highs binary"


def chooser(same: bool, seeds: int | None):
    """Which blocks the anchors of a pack ask for, by the bounds of their zone maps; with `seeds`,
    for each window only so many whose middle lies closest to the window's upper end."""

    def choose(anchors: list[dict], zones: list[dict]) -> list[tuple]:
        d = max(len(x["vector"]) // 8 for x in anchors)
        matrix = np.zeros((len(anchors), d), np.int64)
        for i, x in enumerate(anchors):
            matrix[i, :len(x["vector"]) // 8] = np.frombuffer(x["vector"], np.int64)
        wide = max(len(x["low"]) // 8 for x in zones)
        low, high = np.zeros((2, len(zones), wide), np.int64)
        for j, x in enumerate(zones):
            low[j, :len(x["low"]) // 8], high[j, :len(x["high"]) // 8] = (np.frombuffer(x[k], np.int64) for k in ("low", "high"))
        plus, minus = np.maximum(matrix, 0), np.minimum(matrix, 0)
        upper, lower = products(plus, high) + products(minus, low), products(plus, low) + products(minus, high)
        labels = np.array([x["label"] for x in anchors])
        kinds = [set(x["kinds"]) for x in zones]
        fits = {label: np.array([label in k if same else k != {label} for k in kinds]) for label in set(labels.tolist())}
        able = np.array([fits[label] for label in labels.tolist()])
        lows, highs = (np.array([x[k] for x in anchors], np.int64) for k in ("lows", "highs"))
        chosen = np.zeros(able.shape, dtype=bool)
        for w in range(lows.shape[1]):
            a, b = lows[:, w, None], highs[:, w, None]
            may = able & (a <= b) & (upper >= a) & (lower <= b)
            if seeds is not None and len(zones) > seeds:
                away = np.where(may, np.abs(lower / 2 + upper / 2 - b), np.inf)
                near = np.argpartition(away, seeds - 1, axis=1)[:, :seeds]
                first = np.zeros(may.shape, dtype=bool)
                np.put_along_axis(first, near, True, axis=1)
                may &= first
            chosen |= may
        out = []
        for j in np.flatnonzero(chosen.any(axis=0)).tolist():
            own = np.flatnonzero(chosen[:, j])
            out.append((zones[j]["block"], *(np.array([anchors[i][k] for i in own], np.int64).tobytes() for k in ("anchor_no", "label", "block", "place")),
                        packed(matrix[own]), d, lows[own].tobytes(), highs[own].tobytes()))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                anchors, zones = (batch.column(i)[row].as_py() for i in range(2))
                rows = choose(anchors, zones)
                if rows:
                    yield record(REQUESTS, rows)

    return run


FOUND = "anchor_no long, window int, score long, vec_id long, block long, place long"


def reader(same: bool, wanted: int):
    """The first rows of each window that a block holds, for the anchors that ask for it."""

    def read(x: dict) -> Iterator[tuple]:
        nos, labels, blocks, places = (np.frombuffer(x[k], np.int64) for k in ("nos", "labels", "blocks", "places"))
        asked = unpacked(x["vectors"], len(nos), x["dimensions"])
        lows, highs = (np.frombuffer(x[k], np.int64).reshape(len(nos), -1) for k in ("lows", "highs"))
        ids, kinds = (np.frombuffer(x[k], np.int64) for k in ("ids", "kinds_of"))
        scores = products(asked, unpacked(x["rows"], x["n"], x["wide"]))
        alike = (labels[:, None] == kinds) == same
        own = np.flatnonzero(blocks == x["block"])
        alike[own, places[own]] = False
        for i in range(len(nos)):
            may = np.flatnonzero(alike[i] & (scores[i] >= lows[i].min()) & (scores[i] <= highs[i].max()))
            order = may[np.lexsort((may, ids[may], -scores[i][may]))]
            held = scores[i][order]
            for w in range(lows.shape[1]):
                # Scores fall, so a window's rows are neighbours.
                begin = int(np.searchsorted(-held, -highs[i, w], "left"))
                end = min(int(np.searchsorted(-held, -lows[i, w], "right")), begin + wanted)
                for at in order[begin:end].tolist():
                    yield int(nos[i]), w, int(scores[i, at]), int(ids[at]), x["block"], at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = list(read(batch.slice(row, 1).to_pylist()[0]))
                if found:
                    yield record(FOUND, found)

    return run


class Candidates:
    """The stored blocks, their zone maps in pages, and the anchors among them."""

    def __init__(self, vectors: DataFrame, every: int, block: int = BLOCK, pack: int = PACK, page: int = PAGE) -> None:
        ship(vectors.sparkSession)
        keys = vectors.select("vec_id", F.col("label").cast("long").alias("label"), "vector").mapInArrow(
            keyed, "vec_id long, label long, vector array<long>, curve long")
        ordered = keys.repartitionByRange("curve", "vec_id").sortWithinPartitions("curve", "vec_id").drop("curve")
        self.blocks = staged(ordered.mapInArrow(blocked(block), BLOCKS), "blocks")
        self.page_count = max(-(-self.blocks.count() // page), 1)
        place = F.pmod(F.xxhash64("block"), F.lit(self.page_count).cast("long"))
        zones = self.blocks.select(place.alias("page"), F.struct("block", "low", "high", "kinds").alias("zone"))
        self.pages = staged(zones.groupBy("page").agg(F.collect_list("zone").alias("zones")), "zones")
        self.anchors = staged(self.blocks.select("block", "n", "ids", "labels", "vectors", "dimensions").mapInArrow(anchors_of(every, pack), ANCHORS), "anchors")

    def requests(self, asked: DataFrame, same: bool, seeds: int | None) -> DataFrame:
        packs = asked.groupBy("pack").agg(F.collect_list(F.struct(
            "anchor_no", "label", "block", "place", "vector", "lows", "highs")).alias("anchors"))
        # Every pack meets every page of zone maps: the stated queries against all blocks' bounds.
        spread = packs.select("anchors", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.page_count - 1).cast("long"))).alias("page"))
        return spread.join(self.pages, "page").select("anchors", "zones").mapInArrow(chooser(same, seeds), REQUESTS)

    def read(self, requests: DataFrame, same: bool, wanted: int) -> DataFrame:
        stored = self.blocks.select("block", "n", "ids", F.col("labels").alias("kinds_of"), F.col("vectors").alias("rows"), F.col("dimensions").alias("wide"))
        found = requests.join(stored, "block").mapInArrow(reader(same, wanted), FOUND)
        order = Window.partitionBy("anchor_no", "window").orderBy(F.desc("score"), "vec_id", "block", "place")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)

    def search(self, asked: DataFrame, same: bool, wanted: int, seeds: int = SEEDS) -> DataFrame:
        """anchor_no, window, rank, score, vec_id: the first `wanted` rows of every window, exactly.

        `asked` has the anchors' columns and their windows as equally long arrays lows and highs.
        """
        first = staged(self.read(self.requests(asked, same, seeds), same, wanted), "first")
        full = first.filter(F.col("rank") == wanted).groupBy("anchor_no").agg(
            F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("reached"))
        # A full window cannot lose its last row to one that scores less.
        raised = asked.join(full, "anchor_no", "left").withColumn("lows", F.transform(
            "lows", lambda low, w: F.coalesce(F.try_element_at("reached", w), low))).drop("reached")
        return self.read(self.requests(raised, same, None), same, wanted).select("anchor_no", "window", "rank", "score", "vec_id")


def quantised(embeddings: DataFrame, scale: int = 256, vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label and vector, each component x as floor(scale * x) of the double.

    Rows without id, label or vector, or with a null or non-finite component, take no part.
    """
    x = F.col(f"`{vector}`").cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & F.col(f"`{label}`").isNotNull() & x.isNotNull() & ~odd)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("long").alias("label"),
                       F.transform(x, lambda v: F.floor(v * scale)).alias("vector"))


def mine(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         block: int = BLOCK, pack: int = PACK, page: int = PAGE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `vectors` has vec_id, label and vector (whole numbers). Anchors are the rows whose vec_id is
    divisible by `every`; their positives are the first other rows of their label, and for each of
    those the negatives are the first rows of another label that score from `low` to `high` percent
    of it. Higher scores come first, then smaller ids. A row that repeats is another row, and a
    repeated anchor is answered as often. Vectors of unequal length are compared as if the shorter
    one ended in zeros; components beyond 2**31 / sqrt(length) are taken as that bound, which keeps
    scores within 64 bits. An empty table gives no rows; further columns are ignored.
    """
    stored = Candidates(vectors, every, block, pack, page)
    whole = stored.anchors.withColumns({"lows": F.array(F.lit(-FAR)), "highs": F.array(F.lit(FAR))})
    found = staged(stored.search(whole, True, positives), "positives")
    score = F.col("score").cast("decimal(38,0)")
    bounds = F.struct("rank", F.ceil(score * low / 100).cast("long").alias("low"), F.floor(score * high / 100).cast("long").alias("high"))
    windows = found.groupBy("anchor_no").agg(F.sort_array(F.collect_list(bounds)).alias("w"))
    # Anchors with fewer positives get empty windows for the rest.
    pad = F.array_repeat(F.lit(1).cast("long"), positives)
    lows = F.slice(F.concat(F.transform("w", lambda x: x["low"]), pad), 1, positives)
    highs = F.slice(F.concat(F.transform("w", lambda x: x["high"]), F.transform(pad, lambda x: x - 1)), 1, positives)
    asked = staged(stored.anchors.join(windows, "anchor_no").select(*stored.anchors.columns, lows.alias("lows"), highs.alias("highs")), "windows")
    hard = stored.search(asked, False, negatives)
    pairs = found.select("anchor_no", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = stored.anchors.select("anchor_no", "anchor_id")
    return hard.join(pairs, ["anchor_no", "window"]).join(named, "anchor_no").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
