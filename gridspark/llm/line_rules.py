"""Quality rules over a document and over the lines it shares with others of its host.

Lines are normalised (A-Z as a-z, runs of digits as 0, runs of white space as one blank, none at
the ends) and hashed; per host and line the distinct documents are counted. Lines that stand in
more documents of a host than the limit are boilerplate and are removed; a document of which too
little stays is rejected. Documents are distinct when their texts are, so copies count once and
do not condemn their own original.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gridspark.llm.common import LANE, SPACE, Block, Words, blocks, mix, ship, staged, words_of

WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30
# A line in more distinct documents of one host than this goes.
DOCUMENTS = 8
# A document that keeps less than this share of its words is depleted.
KEPT_PERCENT = 50

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
DIGITS = re.compile(rb"[0-9]+")


def normalised(line: bytes) -> bytes:
    return b" ".join(DIGITS.sub(b"0", line.lower()).split())


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between each two neighbouring offsets."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def repeated_words(words: Words, size: int = WINDOW) -> np.ndarray:
    """Per text, the words covered by a run of `size` words that the text has twice or more."""
    total = len(words.hashes)
    grams = LANE.grams(words.hashes, size)
    rows = words.rows
    at = np.flatnonzero(rows[:len(grams)] == rows[size - 1:]) if len(grams) else np.zeros(0, np.int64)
    keys = mix(grams[at] ^ (rows[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(at), dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    begins = at[again]
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, begins + size, -1)
    return per_text(np.cumsum(change[:-1]) > 0, words.bounds)


def lines_of(raw: bytes) -> tuple[int, dict[int, int]]:
    """Lines with a word that equal an earlier one, and the words under each normalised line's hash."""
    seen: set[bytes] = set()
    repeats, found = 0, {}
    for line in raw.split(b"\n"):
        words = line.split()
        if not words:
            continue
        if line in seen:
            repeats += 1
        seen.add(line)
        key = xxhash.xxh3_64_intdigest(normalised(line)) - (1 << 63)
        found[key] = found.get(key, 0) + len(words)
    return repeats, found


MEASURED = ("row_no long, doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, digest binary, lines array<long>, line_words array<long>")


def measures(block: Block) -> list[list]:
    words = words_of(block)
    leads = (block.data & 0xC0) != 0x80
    raws = [block.data[a:b].tobytes() for a, b in zip(block.offsets[:-1], block.offsets[1:])]
    repeats, found = zip(*map(lines_of, raws))
    return [
        np.diff(words.bounds), per_text(leads & ~SPACE[block.data], block.offsets), per_text(SYMBOL[block.data], block.offsets),
        repeats, repeated_words(words), [xxhash.xxh3_128_digest(raw) for raw in raws],
        [list(x) for x in found], [list(x.values()) for x in found],
    ]


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = pa.list_(pa.int64())
    kinds = (pa.int64(),) * 5 + (pa.binary(), numbers, numbers)
    for batch in batches:
        for block in blocks(batch.column("text")):
            own = batch.slice(block.first, block.rows)
            yield pa.RecordBatch.from_arrays(
                [*(own.column(i) for i in range(3)), *(pa.array(x, k) for x, k in zip(measures(block), kinds))],
                names=[x.split()[0] for x in MEASURED.split(", ")])


def measured(docs: DataFrame, host: Column) -> DataFrame:
    """Base figures and hashed lines of every row, staged. row_no is the row's place in a scan of `docs`."""
    ship(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return staged(rows.mapInArrow(measure, MEASURED), "lines")


def line_counts(rows: DataFrame) -> DataFrame:
    """host, line (its hash) and documents, the distinct texts of that host which hold the line."""
    each = rows.select("host", F.explode("lines").alias("line"), "digest")
    return each.groupBy("host", "line").agg(F.count_distinct("digest").alias("documents"))


def frequent_lines(rows: DataFrame, limit: int = DOCUMENTS) -> DataFrame:
    """The lines above the limit, staged: their size decides how they are joined."""
    return staged(line_counts(rows).filter(F.col("documents") > limit), "frequent")


def occurrences(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """row_no, line and words of every distinct frequent line of a row."""
    each = rows.select("row_no", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("at"))
    lines = each.select("row_no", "host", F.col("at.lines").alias("line"), F.col("at.line_words").alias("words"))
    return lines.join(frequent.select("host", "line"), ["host", "line"], "left_semi")


def judged(rows: DataFrame, frequent: DataFrame, percent: int = KEPT_PERCENT) -> DataFrame:
    """Rows of `measured` with n_removed_words, base_failed and kept."""
    removed = occurrences(rows, frequent).groupBy("row_no").agg(F.sum("words").alias("n_removed_words"))
    joined = rows.drop("digest", "lines", "line_words").join(removed, "row_no", "left").withColumn(
        "n_removed_words", F.coalesce("n_removed_words", F.lit(0)))
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    depleted = 100 * left < percent * F.col("n_words")
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def report(docs: DataFrame, host: str = "source", limit: int = DOCUMENTS) -> DataFrame:
    """One row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_removed_words.

    Null and empty texts have no words and fail the base rules. Rows without a host share one.
    Lines without a word are never counted. Repeated rows are one distinct document, but each is
    judged; null or repeated ids are rows like others; an empty table gives no rows; further
    columns are ignored.
    """
    rows = measured(docs, F.col(host))
    return judged(rows, frequent_lines(rows, limit)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words")


def without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, gone in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            away = set(gone or ())
            lines = text.encode("utf-8", "surrogatepass").split(b"\n") if away else []
            stay = [x for x in lines if not x.split() or xxhash.xxh3_64_intdigest(normalised(x)) - (1 << 63) not in away]
            texts.append(b"\n".join(stay).decode("utf-8", "surrogatepass") if away else text)
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *(batch.column(i) for i in range(2, batch.num_columns))],
                                         names=["text", *batch.schema.names[2:]])


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not use."""
    used = {x.lower() for x in df.columns}
    while name in used:
        name += "_"
    return name


def cleaned(docs: DataFrame, host: str = "source", limit: int = DOCUMENTS) -> DataFrame:
    """The rows that stay, with all their columns; frequent lines are taken out of their texts."""
    rows = measured(docs, F.col(host))
    frequent = frequent_lines(rows, limit)
    verdicts = judged(rows, frequent).filter("kept").select("row_no")
    gone = occurrences(rows, frequent).groupBy("row_no").agg(F.collect_list("line").alias("gone"))
    place, lines = free_name(docs, "row_place"), free_name(docs, "gone_lines")
    stay = verdicts.join(gone, "row_no", "left").select(F.col("row_no").alias(place), F.col("gone").alias(lines))
    marked = docs.withColumn(place, F.monotonically_increasing_id()).join(stay, place)
    others = [x for x in docs.columns if x != "text"]
    quoted = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    out = marked.select("text", lines, *(F.col(f"`{x}`") for x in others)).mapInArrow(without_lines, f"text string, {quoted}")
    return out.select(*(F.col(f"`{x}`") for x in docs.columns))
