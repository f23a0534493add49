"""Packing of documents into full sequences along a Hilbert curve.

Documents are tokenized once and projected to a few dimensions; a range sort by the Hilbert key of
the projection puts neighbours next to each other. All documents, end to end in this order, are cut
at every LENGTH tokens, so only the very last sequence is not full.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridspark.llm.common import mix, staged

LENGTH = 1024
END = 0
DIMENSIONS, BITS = 4, 12
CACHE = 300_000
# White space of the tokenizer's pattern: a text may be cut where a run of it begins.
WHITE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Tokens:
    """Ids of texts as packed 16-bit numbers, equal to the `tokenizers` library's.

    A text is cut where white space follows other characters, which the pattern of this vocabulary
    never joins; pieces are remembered. Latin pieces go through the same vocabulary in tiktoken,
    which is faster; others, and texts that name a special token, go through `tokenizers` itself.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = [x["content"] for x in spec["added_tokens"]]
        plain = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
        letters = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in plain)}
        ranks = {bytes(letters[x] for x in word): i for word, i in spec["model"]["vocab"].items() if word not in self.special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def encode(self, piece: str) -> bytes:
        latin = piece.isascii() or max(piece) < chr(0x250)
        ids = self.fast.encode_ordinary(piece) if latin else self.slow.encode(piece, add_special_tokens=False).ids
        out = np.array(ids, np.uint16).tobytes()
        if len(self.known) >= CACHE:
            self.known.clear()
        if len(piece) <= 64:
            self.known[piece] = out
        return out

    def of(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint16).tobytes()
        known = self.known
        return b"".join([known.get(piece) or self.encode(piece) for piece in CHUNK.findall(text)])


OPEN: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    if path not in OPEN:
        OPEN[path] = Tokens(path)
    return OPEN[path]


def projection(vocabulary: int = 1 << 16) -> np.ndarray:
    """A fixed direction for each token id, from its hash."""
    hashes = mix(np.arange(1, vocabulary * DIMENSIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return ((hashes >> np.uint64(11)).astype(np.float64) / (1 << 53) - 0.5).astype(np.float32).reshape(vocabulary, DIMENSIONS)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (one row each), by Skilling's transposition."""
    x = [column.astype(np.int64) for column in cells.T]
    n, top = len(x), 1 << (bits - 1)
    bit = top
    while bit > 1:
        low = bit - 1
        for i in range(n):
            set_ = (x[i] & bit) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(set_, x[i], x[i] ^ swap)
        bit >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip, bit = np.zeros_like(x[0]), top
    while bit > 1:
        flip = np.where((x[-1] & bit) != 0, flip ^ (bit - 1), flip)
        bit >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ flip) >> b) & 1)
    return key


def curve_keys(ids: list[np.ndarray], directions: np.ndarray) -> np.ndarray:
    """Hilbert keys of the documents' mean directions."""
    means = np.array([directions[x].mean(axis=0) for x in ids], np.float64).reshape(len(ids), DIMENSIONS)
    cells = ((np.tanh(6 * means) + 1) / 2 * ((1 << BITS) - 1)).astype(np.int64)
    return hilbert(cells)


TOKENIZED = "row_no long, doc_id long, curve long, n_tokens long, ids binary"


def tokenizer(path: str | None):
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, directions = tokens(path or default_path()), projection()
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                own = batch.slice(begin, 256)
                packed = [vocabulary.of(text) + END.to_bytes(2, "little") for text in own.column(2).to_pylist()]
                ids = [np.frombuffer(x, np.uint16) for x in packed]
                yield pa.RecordBatch.from_arrays([
                    own.column(0), own.column(1), pa.array(curve_keys(ids, directions)),
                    pa.array([len(x) for x in ids], pa.int64()), pa.array(packed, pa.binary()),
                ], names=["row_no", "doc_id", "curve", "n_tokens", "ids"])

    return tokenize


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cutter(length: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, ids = [], []
            for doc, packed, place in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = np.frombuffer(packed, np.uint16).astype("<u4")
                cuts = [0, *range(length - place % length, len(own), length), len(own)]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    out.append((doc, a, b - a, zlib.crc32(own[a:b].tobytes()), len(own), (place + a) // length, (place + a) % length))
                    if keep_ids:
                        ids.append(own[a:b].astype(np.int32))
            if out:
                columns = [pa.array(x, pa.int64()) for x in zip(*out)]
                names = [x.split()[0] for x in PIECES.split(", ")]
                if keep_ids:
                    columns, names = columns + [pa.array(ids, pa.list_(pa.int32()))], names + ["ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def pack(docs: DataFrame, length: int = LENGTH, path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A document is its token ids and the end id 0, so a null or empty text is one id. Documents lie
    end to end along the curve (ties by row) and each sequence holds `length` ids, the last one
    fewer. Null or repeated ids and repeated rows are documents like others; an empty table gives
    no rows; further columns are ignored. `path` names the tokenizer's file on every node.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    encoded = staged(rows.mapInArrow(tokenizer(path), TOKENIZED), "tokens")
    # Only keys and lengths are sorted; ids move once, when their places are known.
    ranged = staged(encoded.select("row_no", "curve", "n_tokens").repartitionByRange("curve", "row_no").withColumn("part", F.spark_partition_id()), "curve")
    totals = ranged.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("part").orderBy("curve", "row_no").rowsBetween(Window.unboundedPreceding, -1)
    places = ranged.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(
        F.broadcast(begins), "part").select("row_no", (F.col("begin") + F.col("inside")).alias("place"))
    joined = encoded.select("row_no", "doc_id", "ids").join(places, "row_no").select("doc_id", "ids", "place")
    return joined.mapInArrow(cutter(length, keep_ids), PIECES + (", ids array<int>" if keep_ids else ""))
