"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The search walks over the characters and keeps, for each boundary between them, the best way to get
there. A piece is at most `longest` characters, so only boundaries of that window can still be
extended; whenever the backpointer paths of all of them run through one boundary, the pieces before
it are final, and they are given out and forgotten.

Unigram models take the path of the largest sum of scores. Models of merged pairs (BPE) take the
path that merging would give: such a path is right exactly when each two neighbouring pieces,
merged by themselves, stay the same two pieces, so each boundary has one admissible way to it.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLANK = "▁"
CACHE, CACHED_LENGTH = 500_000, 48
ENDS, GOES_ON = 1, 2


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A vocabulary with scores; pieces of bytes stand for characters it lacks."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: dict[int, int], unknown: int, merges: bool, skipped: Iterable[int] = ()) -> None:
        no = {*byte_ids.values(), unknown, *skipped}
        self.texts = [text for text, _ in pieces]
        self.scores = {text: score for i, (text, score) in enumerate(pieces) if i not in no}
        self.ids = {text: i for i, (text, _) in enumerate(pieces) if i not in no}
        # ENDS: a piece; GOES_ON: a longer piece begins so.
        self.kinds = dict.fromkeys(self.ids, ENDS)
        for text in self.ids:
            for k in range(1, len(text)):
                self.kinds[text[:k]] = self.kinds.get(text[:k], 0) | GOES_ON
        self.longest = max(map(len, self.ids), default=1)
        self.byte_ids, self.unknown, self.merges = byte_ids, unknown, merges
        self.raw = [text.replace(BLANK, " ").encode() for text in self.texts]
        for byte, i in byte_ids.items():
            self.raw[i] = bytes([byte])
        self.penalty = min(self.scores.values(), default=0.0) - 10.0
        # left piece: right piece: whether they are admissible neighbours
        self.pairs: dict[str, dict[str, bool]] = {}
        self.judged = 0
        # Two generations: when the newer is full, it becomes the older, and what is used moves back.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # If no piece has a blank after another character, all paths meet before each such blank.
        self.splits = not any(BLANK in text.lstrip(BLANK) for text in self.ids)
        self.segment = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging its best pair again and again, leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def admissible(self, left: str, right: str) -> bool:
        """Whether the two pieces stay as they are when their text is merged by itself."""
        if self.judged >= CACHE:
            self.judged, self.pairs = 0, {}
        self.judged += 1
        found = self.pairs.setdefault(left, {})[right] = self.stays(left, right)
        return found

    def stays(self, left: str, right: str) -> bool:
        """`merged`, ended by the first merge across the border of the two."""
        scores, parts, border = self.scores, [*left, *right], len(left)
        ranks = [scores.get(a + b) for a, b in zip(parts, parts[1:])]
        while len(parts) > 2:
            best, at = None, -1
            for i, score in enumerate(ranks):
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None or at == border - 1:
                return False
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = scores.get(parts[at] + parts[at + 1])
            if at:
                ranks[at - 1] = scores.get(parts[at - 1] + parts[at])
            border -= at < border
        return border == 1 and ranks[0] is None

    def onward(self, text: str, begin: int, at: int, ways: dict[int, tuple[float, int, str]]) -> None:
        """Extend the way to boundary `at`, which is text[begin], by each piece that starts there, a
        single character in any case."""
        score, _, left = ways[at]
        kinds, merges = self.kinds, self.merges
        judged = self.pairs.get(left, {}) if left else None
        end, most = begin + 1, min(begin + self.longest, len(text))
        to, piece = at + 1, text[begin:end]
        kind = kinds.get(piece, 0)
        ends = ENDS
        while True:
            if ends:
                if not merges:
                    total = score + self.scores.get(piece, self.penalty)
                    if to not in ways or total > ways[to][0]:
                        ways[to] = (total, at, piece)
                elif to not in ways:
                    # Each boundary has one admissible way to it.
                    right = judged is None or judged.get(piece)
                    if right is None:
                        right = self.admissible(left, piece)
                    if right:
                        ways[to] = (0.0, at, piece)
            if kind < GOES_ON or end >= most:
                return
            end += 1
            to += 1
            piece = text[begin:end]
            kind = kinds.get(piece, 0)
            ends = kind & ENDS

    def stream(self, chunks: Iterable[str]) -> Iterator[str]:
        """Pieces of a text that comes in chunks, each as soon as it is final.

        Kept are the characters and boundaries since the last final one, not the text.
        """
        text, base, at = "", 0, 0
        # boundary: (score, boundary before, piece between)
        ways: dict[int, tuple[float, int, str]] = {0: (0.0, -1, "")}
        for chunk, last in with_last(chunks):
            text += chunk
            end = base + len(text)
            # Without more text, a piece might still be longer than what is seen.
            stop = end if last else end - self.longest + 1
            while at < stop:
                if at in ways:
                    self.onward(text, at - base, at, ways)
                at += 1
                if len(ways) > 4 * self.longest or (last and at == end):
                    # At the text's end all paths have come together.
                    meet = end if last and at == end else self.meeting(ways, at)
                    yield from self.path(ways, meet)
                    if last and meet == end:
                        return
                    text, base = text[meet - base:], meet
                    score, _, piece = ways[meet]
                    ways = {b: w for b, w in ways.items() if b > meet} | {meet: (score, -1, piece)}

    def meeting(self, ways: dict[int, tuple[float, int, str]], at: int) -> int:
        """The last boundary that the paths of all boundaries from `at` on have in common."""
        live = {b for b in ways if b >= at}
        while len(live) > 1:
            furthest = max(live)
            live.discard(furthest)
            live.add(ways[furthest][1])
        return live.pop()

    @staticmethod
    def path(ways: dict[int, tuple[float, int, str]], at: int) -> list[str]:
        out = []
        while ways[at][1] >= 0:
            out.append(ways[at][2])
            at = ways[at][1]
        return out[::-1]

    def ids_of(self, pieces: Iterable[str]) -> list[int]:
        out: list[int] = []
        for piece in pieces:
            found = self.ids.get(piece)
            if found is not None:
                out.append(found)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass"))
            else:
                out.append(self.unknown)
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text. One blank goes before it, and blanks are written as a mark of their own."""
        if not text:
            return np.zeros(0, np.uint32)
        marked = BLANK + text.replace(" ", BLANK)
        if not self.splits:
            return np.array(self.ids_of(self.stream(chunks_of(marked))), np.uint32)
        known = self.known
        packed = [known.get(part) or self.remember(part) for part in self.segment.findall(marked)]
        return np.frombuffer(b"".join(packed), np.uint32)

    def remember(self, part: str) -> bytes:
        """Ids of a part by the streaming search. Long parts, which hardly come again, are not kept."""
        if len(part) > CACHED_LENGTH:
            return array("I", self.ids_of(self.stream(chunks_of(part)))).tobytes()
        out = self.older.get(part) or array("I", self.ids_of(self.stream((part,)))).tobytes()
        if len(self.known) >= CACHE:
            self.older, self.known = self.known, {}
        self.known[part] = out
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, without the blank before it; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def with_last(chunks: Iterable[str]) -> Iterator[tuple[str, bool]]:
    """Each chunk and whether it is the last."""
    held = None
    for chunk in chunks:
        if held is not None:
            yield held, False
        held = chunk
    if held is not None:
        yield held, True


def chunks_of(text: str, size: int = 4096) -> Iterator[str]:
    for begin in range(0, len(text), size):
        yield text[begin:begin + size]


def load(path: str) -> Pieces:
    """The vocabulary of a model file. Only models that leave texts as they are, apart from the
    blank before them, can be read; others would need their normaliser."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.normalize("  Ａ é  ") != f"{BLANK * 3}Ａ{BLANK}é{BLANK * 2}":
        raise ValueError(f"{path} normalises texts")
    n = model.get_piece_size()
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(n)]
    byte_ids = {int(pieces[i][0][3:5], 16): i for i in range(n) if model.is_byte(i)}
    skipped = [i for i in range(n) if model.is_control(i) or model.is_unused(i)]
    # Merge models score pieces by their rank; unigram models by log probabilities.
    merges = all(score == int(score) for _, score in pieces)
    return Pieces(pieces, byte_ids, model.unk_id(), merges, skipped)


OPEN: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in OPEN:
        OPEN[path] = load(path)
    return OPEN[path]


ENCODED = "doc_id long, n_chars long, ids array<int>"
CHECKED = "doc_id long, n_chars long, n_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean"


def rows_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_chars and ids of every row; null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path or default_path())
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                own = batch.slice(begin, 256)
                texts = own.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    own.column(0), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([vocabulary.encode(t).astype(np.int32) for t in texts], pa.list_(pa.int32())),
                ], names=["doc_id", "n_chars", "ids"])

    return rows_of(docs).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of every row of ids; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path or default_path())
        for batch in batches:
            texts = [None if ids is None else vocabulary.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def checked(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per input row: doc_id, n_chars, n_ids, ids_crc32 (little-endian unsigned 32-bit ids),
    decoded_sha256 and round_trip, whether decoding gives the text back.

    Null and empty texts have no ids and decode to the empty text. A text that holds the blank's own
    mark comes back with spaces in its place, which is the one case that is no round trip. Null or
    repeated ids and repeated rows are encoded as they are; an empty table gives no rows; further
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path or default_path())
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                own, out = batch.slice(begin, 256), []
                for text in own.column(1).to_pylist():
                    ids = vocabulary.encode(text)
                    back = vocabulary.decode(ids.tolist())
                    out.append((len(text), len(ids), zlib.crc32(ids.astype("<u4").tobytes()), hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest(), back == text))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
                if out:
                    yield pa.RecordBatch.from_arrays([own.column(0), *(pa.array(x, k) for x, k in zip(zip(*out), kinds))],
                                                     names=[x.split()[0] for x in CHECKED.split(", ")])

    return rows_of(docs).mapInArrow(run, CHECKED)
