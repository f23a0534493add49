"""Alignment of two tokenizers' tokens over the same bytes, by diagonal run skipping.

Both tokenizers cut the same bytes; a group ends wherever a token of each ends. The ends are two
growing arrays. While tokens match one to one, both arrays agree at a fixed index shift (a
diagonal), so doubling spans are compared until one differs and halving spans find where. An
irregular group is then walked token by token, which gives the next shift.

Linked are the two tokens that end a group together. As one of them is then a suffix of the other,
the id pairs that can be linked are bounded by the vocabularies (`possible_pairs`), not the corpus.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridspark.llm.common import ship, staged

BLANK = "▁"
CACHE = 300_000
ROWS = 256
PROBE = 8
# White space of tokenizer A's pattern. A text is cut where a run of it begins with a blank: no
# token of either vocabulary reaches from before such a place to behind it (`load` makes sure).
WHITE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
OTHER = WHITE.replace(" ", "")
CHUNK = re.compile(f"[{WHITE}]*(?:[^{WHITE}]+(?:[{OTHER}][{WHITE}]*)?)+|[{WHITE}]+")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with."""
    plain = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]
    return {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in plain)}


class Pair:
    """Two vocabularies and the ids they give to a text that begins with a blank."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path_a)
        self.slow.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        size = max(*spec["model"]["vocab"].values(), *special.values()) + 1
        self.raw_a = [b""] * size
        for word, i in spec["model"]["vocab"].items():
            self.raw_a[i] = word.encode() if word in special else bytes(letters[x] for x in word)
        ranks = {raw: i for i, raw in enumerate(self.raw_a) if i not in special.values()}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("alignment", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.raw_b = [bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(BLANK, " ").encode() for i, piece in enumerate(pieces)]
        if any(BLANK in piece.lstrip(BLANK) for piece in pieces):
            raise ValueError(f"{path_b} has pieces that go on behind a blank")
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in raw], np.uint32) for raw in (self.raw_a, self.raw_b))
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.older: dict[str, tuple[bytes, bytes] | None] = {}

    def learn(self, chunks: list[str]) -> None:
        """Remember the ids of chunks, or None where they do not spell the chunk. Each chunk begins
        with the blank that B adds by itself."""
        latin: list[str] = []
        rest: list[str] = []
        for chunk in chunks:
            (latin if chunk.isascii() or max(chunk) < chr(0x250) else rest).append(chunk)
        # The faster library knows letters by another version of Unicode, which Latin ones do not feel.
        ids_a = [self.fast.encode_ordinary(x) for x in latin] + [x.ids for x in self.slow.encode_batch(rest, add_special_tokens=False)]
        # The library gives an empty text no ids, not even its own blank.
        ids_b = [ids or [self.model.piece_to_id(BLANK)] for ids in self.model.encode([x[1:] for x in latin + rest], num_threads=1)]
        for chunk, a, b in zip(latin + rest, ids_a, ids_b):
            raw = chunk.encode("utf-8", "surrogatepass")
            spelled = b"".join([self.raw_a[i] for i in a]) == raw == b"".join([self.raw_b[i] for i in b])
            self.known[chunk] = (array("H", a).tobytes(), array("H", b).tobytes()) if spelled else None

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both vocabularies for each text, with the blank before it. An empty text has none,
        and neither has one that they do not spell byte for byte: chunks join as the text does."""
        cut = [CHUNK.findall(" " + text) if text else [] for text in texts]
        # Two generations: when the newer is full it becomes the older, and what is used moves back.
        if len(self.known) > CACHE:
            self.known, self.older = {}, self.known
        missing = {x for chunks in cut for x in chunks}.difference(self.known)
        again = missing & self.older.keys()
        self.known.update((x, self.older[x]) for x in again)
        self.learn(list(missing - again))
        known, out = self.known, []
        for chunks in cut:
            pairs = list(map(known.__getitem__, chunks))
            if None in pairs:
                pairs = []
            out.append((np.frombuffer(b"".join([x for x, _ in pairs]), np.uint16), np.frombuffer(b"".join([x for _, x in pairs]), np.uint16)))
        return out

    def possible_pairs(self) -> int:
        """How many id pairs can be linked at all: one token is a suffix of the other."""
        return suffix_pairs(self.raw_a, self.raw_b)


def suffix_pairs(raw_a: list[bytes], raw_b: list[bytes]) -> int:
    """The number of pairs of which one is the other, or ends with it."""
    counts = [{}, {}]
    for count, raw in zip(counts, (raw_a, raw_b)):
        for x in raw:
            count[x] = count.get(x, 0) + 1
    ends = sum(counts[1].get(x[k:], 0) for x in raw_a for k in range(len(x)))
    return ends + sum(counts[0].get(x[k:], 0) for x in raw_b for k in range(1, len(x)))


OPEN: dict[tuple[str, str], Pair] = {}


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def pair(path_a: str | None, path_b: str | None) -> Pair:
    a, b = default_paths() if path_a is None or path_b is None else (path_a, path_b)
    key = (path_a or a, path_b or b)
    if key not in OPEN:
        OPEN[key] = Pair(*key)
    return OPEN[key]


def run_length(a: bytes, i: int, b: bytes, j: int) -> int:
    """How many 4-byte ends from i and j on are equal: doubling spans are compared until one differs
    or an array ends; the lowest bit in which that span differs tells where."""
    at, to, step = 4 * i, 4 * j, 4 * PROBE
    limit = min(len(a) - at, len(b) - to)
    run = 0
    while run < limit:
        step = min(step, limit - run)
        x, y = a[at + run:at + run + step], b[to + run:to + run + step]
        if x != y:
            different = int.from_bytes(x, "little") ^ int.from_bytes(y, "little")
            return (run * 8 + (different & -different).bit_length() - 1) // 32
        run += step
        step *= 2
    return limit // 4


def group_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the tokens that end each group, for growing ends (unsigned 32 bits) that finish alike."""
    raw_a, raw_b, ends_a, ends_b = a.tobytes(), b.tobytes(), memoryview(a), memoryview(b)
    starts: list[int] = []
    shifts: list[int] = []
    runs: list[int] = []
    i = shift = 0
    while i < len(a):
        run = run_length(raw_a, i, raw_b, i + shift)
        if not run:
            # Irregular: step through it to the next common end, which closes one group.
            j = i + shift
            x, y = ends_a[i], ends_b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = ends_a[i]
                else:
                    j += 1
                    y = ends_b[j]
            run, shift = 1, j - i
        starts.append(i)
        shifts.append(shift)
        runs.append(run)
        i += run
    lengths = np.array(runs, np.int64)
    last_a = np.repeat(np.array(starts, np.int64) - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    return last_a, last_a + np.repeat(np.array(shifts, np.int64), lengths)


class Writer:
    """Groups as text: `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, size_a: int, size_b: int) -> None:
        parts = [b"%d%s" % (i, mark) for size, marks in ((size_a, (b",", b"|")), (size_b, (b",", b";"))) for i in range(size) for mark in marks]
        self.lengths = np.array([len(x) for x in parts], np.int8)
        width = int(self.lengths.max())
        self.table = np.frombuffer(b"".join(x.ljust(width) for x in parts), np.uint8).reshape(-1, width)
        self.places, self.offset = np.arange(width, dtype=np.int8), 2 * size_a

    def write(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> bytes:
        codes = np.empty(len(a) + len(b), np.int64)
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[last_a], ends_b[last_b] = 1, 1
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        # An A token stands behind the B tokens of earlier groups, a B token behind A's of its own too.
        codes[np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]] = 2 * a.astype(np.int64) + ends_a
        codes[np.arange(len(b)) + last_a[group_b] + 1] = self.offset + 2 * b.astype(np.int64) + ends_b
        return self.table[codes][self.places < self.lengths[codes][:, None]].tobytes()[:-1]


GROUPED = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"
ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_last array<int>, b_last array<int>"


def aligner(path_a: str | None, path_b: str | None, digest: bool):
    """Texts to aligned tokens, or to their digest and links; a link is its A id times B's size plus its B id."""

    def of(batch: pa.RecordBatch, both: Pair, writer: Writer | None) -> pa.RecordBatch:
        texts = [text or "" for text in batch.column(1).to_pylist()]
        out = []
        for a, b in both.ids(texts):
            last_a, last_b = group_ends(np.cumsum(both.sizes_a[a], dtype=np.uint32), np.cumsum(both.sizes_b[b], dtype=np.uint32))
            if writer is None:
                out.append((a.astype(np.int32), b.astype(np.int32), last_a.astype(np.int32), last_b.astype(np.int32)))
                continue
            sha = hashlib.sha256(writer.write(a, b, last_a, last_b)).hexdigest() if len(a) else ""
            links = a[last_a].astype(np.uint32) * np.uint32(len(both.raw_b)) + b[last_b]
            out.append((len(a), len(b), len(last_a), sha, links.astype("<u4").tobytes()))
        numbers = pa.list_(pa.int32())
        kinds = (numbers,) * 4 if writer is None else (pa.int64(),) * 3 + (pa.string(), pa.binary())
        names = [x.split()[0] for x in (ALIGNED if writer is None else GROUPED).split(", ")]
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(zip(*out), kinds))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(path_a, path_b)
        writer = Writer(len(both.raw_a), len(both.raw_b)) if digest else None
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                yield of(batch.slice(begin, ROWS), both, writer)

    return run


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, a_ids, b_ids, a_last, b_last of every row: group g ends with tokens a_last[g] and
    b_last[g]. Empty arrays where the text is null or empty or a tokenizer does not give it back."""
    ship(docs.sparkSession)
    return rows_of(docs).mapInArrow(aligner(path_a, path_b, False), ALIGNED)


def counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links per id pair of a task; there are no more pairs than the vocabularies allow."""
    codes, counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    for batch in batches:
        links = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(x, "<u4") for x in batch.column(0).to_pylist())])
        fresh, times = np.unique(links, return_counts=True)
        codes, place = np.unique(np.concatenate([codes, fresh]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([counts, times]), len(codes)).astype(np.int64)
    if len(codes):
        yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(counts)], names=["link", "n"])


def pair_counts(grouped: DataFrame, size_b: int) -> DataFrame:
    """link, a_id, b_id, n and best (n is the highest of its B id) over all documents: the map from
    one vocabulary to the other."""
    summed = grouped.select("links").mapInArrow(counter, "link long, n long").groupBy("link").agg(F.sum("n").alias("n"))
    ids = summed.select("link", F.floor(F.col("link") / size_b).alias("a_id"), (F.col("link") % size_b).alias("b_id"), "n")
    highest = F.max("n").over(Window.partitionBy("b_id"))
    return ids.withColumn("best", F.col("n") == highest)


REPORT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def reporter(codes: np.ndarray, counts: np.ndarray, best: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = [np.searchsorted(codes, np.frombuffer(x, "<u4")) for x in batch.column("links").to_pylist()]
            columns = {name: batch.column(name) for name in ("doc_id", "n_a", "n_b", "n_groups", "groups_sha256")} | {
                "n_links": pa.array([len(x) for x in links], pa.int64()),
                "n_best": pa.array([int(best[x].sum()) for x in links], pa.int64()),
                "count_sum": pa.array([int(counts[x].sum()) for x in links], pa.int64()),
            }
            names = [x.split()[0] for x in REPORT.split(", ")]
            yield pa.RecordBatch.from_arrays([columns[name] for name in names], names=names)

    return run


def report(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best counts links whose pair is the most frequent of its B id in all documents, ties included;
    count_sum adds up the corpus-wide counts of the row's links. Null and empty texts, and texts that
    a tokenizer does not give back byte for byte (they hold the blank's mark), have no tokens: zeros
    and ''. Null or repeated ids and repeated rows are rows like others; an empty table gives no
    rows; further columns are ignored.
    """
    ship(docs.sparkSession)
    grouped = staged(rows_of(docs).mapInArrow(aligner(path_a, path_b, True), GROUPED), "aligned")
    both = pair(path_a, path_b)
    # Bounded by the vocabularies: one row per pair of which one token ends with the other.
    found = pair_counts(grouped, len(both.raw_b)).select("link", "n", "best").toArrow().sort_by("link")
    codes, counts, best = (found.column(i).to_numpy() for i in range(3))
    return grouped.mapInArrow(reporter(codes.astype(np.uint32), counts, best), REPORT)
