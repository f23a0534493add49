"""Staged tables, batches of texts as byte arrays, and word hashes shared by the operators."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.session import shared_folder

BLOCK_BYTES = 1 << 19
BATCH_BYTES = 4 << 20
SHIPPED: set[str] = set()
# Label folds: rows of the remainder HELD_OUT are never learnt from.
FOLDS, HELD_OUT = 4, 2

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def stable_splits(spark: SparkSession) -> None:
    """Fix what the cutting of files into splits otherwise takes from the executors present just now,
    so that each scan of a table numbers its rows alike."""
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: it is computed once, cuts the
    lineage, and survives lost executors. The folder goes when the application ends."""
    spark = df.sparkSession
    stable_splits(spark)
    place = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(place)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(place)


def free_name(df: DataFrame, name: str = "__row_no") -> str:
    """A column name that the table does not have."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def ship(spark: SparkSession) -> None:
    """Prepare a session: send this package to the executors' Python once per application, as they
    may not have it, and bound the bytes of texts that go to Python at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in SHIPPED:
        return
    package, data = Path(__file__).resolve().parent.parent, io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    place = f"{shared_folder(spark)}/gridspark-{uuid.uuid4().hex}.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(path)
    out.write(bytearray(data.getvalue()))
    out.close()
    files.deleteOnExit(path)
    context.addPyFile(place)
    SHIPPED.add(context.applicationId)


def held_out(doc_id: Column) -> Column:
    """Whether a row belongs to the fold that is never learnt from; a null id counts as text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


@dataclass(frozen=True)
class Block:
    """Whole texts of neighbouring rows as bytes; text i is data[offsets[i]:offsets[i + 1]]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Views of a string column of about `limit` bytes each; a longer text is a block of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, ends, body = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None and len(body) else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield Block(row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row])
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix64 finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Lane:
    """One family of hashes for byte and value sequences, from prefix sums modulo 2**64.

    The sum over i of value[i] * base**i is kept for every prefix; any span's hash is a difference
    of two sums, shifted back by the inverse power of its start.
    """

    def __init__(self, seed: int) -> None:
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        self.table = values | np.uint64(1)
        self.lower = self.table.copy()
        self.lower[65:91] = self.table[97:123]
        self.base = int(mix(np.array([seed + 77], dtype=np.uint64))[0]) | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)

    def grow(self, n: int) -> None:
        while len(self.powers) < n:
            step = len(self.powers)
            up, down = (np.uint64(pow(x, step, 1 << 64)) for x in (self.base, self.inverse))
            self.powers = np.concatenate([self.powers, self.powers * up])
            self.inverses = np.concatenate([self.inverses, self.inverses * down])

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair."""
        self.grow(len(values) + 1)
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.powers[:len(values)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))

    def grams(self, values: np.ndarray, size: int) -> np.ndarray:
        """Hash of every run of `size` neighbouring values."""
        n = len(values) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        self.grow(len(values) + 1)
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.powers[:len(values)], out=sums[1:])
        return mix((sums[size:] - sums[:n]) * self.inverses[:n])


LANE, CHECK_LANE = Lane(1), Lane(2)


@dataclass(frozen=True)
class Words:
    """Words of a block: byte spans, hashes, and the number of words before each text."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the runs outside [\\x20\\x09-\\x0D]; no run crosses a text's border."""
    inside = ~SPACE[data]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    np.logical_not(inside[:-1], out=before[1:])
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    before[borders] = True
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    np.logical_not(inside[1:], out=after[:-1])
    after[borders - 1] = True
    return np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1


def pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of a long text at white space, so that working arrays stay small."""
    begin = 0
    while begin < len(data):
        end = begin + 2 * BLOCK_BYTES
        while end < len(data):
            near = np.flatnonzero(SPACE[data[end:end + BLOCK_BYTES]])
            if len(near):
                end += int(near[0])
                break
            end += BLOCK_BYTES
        end = min(end, len(data))
        yield begin, end
        begin = end


def words_of(block: Block, lower: bool = False, lane: Lane = LANE) -> Words:
    """Words of every text of a block; `lower` hashes A-Z as a-z."""
    table = lane.lower if lower else lane.table
    parts = []
    for begin, end in pieces(block.data) if block.rows == 1 else [(0, len(block.data))]:
        data = block.data[begin:end]
        inner = block.offsets if block.rows > 1 else np.array([0, len(data)])
        starts, ends = word_spans(data, inner)
        parts.append((starts + begin, ends + begin, lane.spans(table[data], starts, ends)))
    starts, ends, hashes = (np.concatenate(x) if len(x) > 1 else x[0] for x in zip(*parts)) if parts else (
        np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))
    return Words(starts, ends, hashes, np.searchsorted(starts, block.offsets, "left"))


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of every `size` neighbouring values, by doubling."""
    reach, out = 1, values
    while reach * 2 <= size:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    return np.minimum(out[:len(values) - size + 1], out[size - reach:]) if size > reach else out


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)

