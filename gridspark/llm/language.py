"""Language by n-gram filters that answer for all languages at once.

A bit-sliced Bloom filter has one row of bits per position and one bit per language, in as many
64-bit words as there are languages for. The rows an n-gram hashes to, combined by AND, are the mask of all languages that contain it. A text's masks
are counted per language, the counts are corrected for each language's rate of false positives,
and the language with the largest count wins.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridspark.llm.common import LANE, Block, blocks, held_out, mix, signed, staged

GRAM = 4
# Bounds of the fit: labelled texts, and n-grams a language keeps. All languages are learnt.
TEXTS_PER_LANGUAGE, GRAMS_PER_LANGUAGE = 2000, 60_000
WORD = 64
# An n-gram belongs to a language if it is at least this frequent there against its best language.
SHARE, LEAST = 0.1, 3
ROWS, HASHES = 1 << 20, 2
UNKNOWN = "und"
# Letters count in lower case; all other ASCII is one blank.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[:128] = 0x20
FOLD[97:123] = FOLD[65:91] = np.arange(97, 123, dtype=np.uint8)


def grams(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the byte n-grams of each text that hold no blank run."""
    folded = FOLD[block.data]
    if len(folded) < GRAM:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = np.zeros(len(folded) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        hashes = (hashes << np.uint64(8)) | folded[i:len(folded) - GRAM + 1 + i].astype(np.uint64)
    blank = (folded[:-1] == 0x20) & (folded[1:] == 0x20)
    bad = np.concatenate([[0], np.cumsum(blank)])
    whole = bad[GRAM - 1:len(folded)] == bad[:len(folded) - GRAM + 1]
    row = np.repeat(np.arange(block.rows), np.diff(block.offsets))
    keep = np.flatnonzero(whole & (row[:len(hashes)] == row[GRAM - 1:]))
    return row[keep], mix(hashes[keep])


class Filter:
    """The bit-sliced filter, its languages, and each language's rate of false positives."""

    def __init__(self, languages: list[str], members: Iterable[np.ndarray]) -> None:
        self.languages = languages
        # One array of words per WORD languages.
        self.rows = np.zeros((-(-len(languages) // WORD), ROWS), np.uint64)
        for bit, hashes in enumerate(members):
            for place in self.places(hashes):
                np.bitwise_or.at(self.rows[bit // WORD], place, np.uint64(1 << bit % WORD))
        filled = [((self.rows[b // WORD] >> np.uint64(b % WORD)) & np.uint64(1)).mean() for b in range(len(languages))]
        self.false = np.array([x ** HASHES for x in filled])

    @staticmethod
    def places(hashes: np.ndarray) -> list[np.ndarray]:
        return [((hashes >> np.uint64(20 * i)) & np.uint64(ROWS - 1)).astype(np.int64) for i in range(HASHES)]

    def counts(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Corrected numbers of n-grams each language contains, by text, and numbers of n-grams."""
        rows, hashes = grams(block)
        places = self.places(hashes)
        bounds = np.searchsorted(rows, np.arange(block.rows + 1))
        n = np.diff(bounds)
        out = np.zeros((block.rows, len(self.languages)))
        for b in range(len(self.languages)):
            if b % WORD == 0:
                mask = np.full(len(hashes), ~np.uint64(0))
                for place in places:
                    mask &= self.rows[b // WORD][place]
            hits = np.concatenate([[0], np.cumsum((mask >> np.uint64(b % WORD)) & np.uint64(1))])
            seen = (hits[bounds[1:]] - hits[bounds[:-1]]).astype(np.float64)
            out[:, b] = np.maximum(0, (seen - n * self.false[b]) / (1 - self.false[b]))
        return out, n


def learn(docs: DataFrame) -> Filter:
    """Filters of the languages of a bounded number of labelled texts outside the held-out fold."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = rows.filter("lang IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    languages = [r["lang"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()]
    if not languages:
        return Filter([], [])
    bits = docs.sparkSession.createDataFrame(list(zip(languages, range(len(languages)))), "lang string, bit int")
    known = known.join(F.broadcast(bits), "lang")
    order = Window.partitionBy("bit").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("bit", "doc_id").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= TEXTS_PER_LANGUAGE)
    texts = known.join(F.broadcast(ids.select("bit", "doc_id").distinct()), ["bit", "doc_id"]).select("bit", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy()
            for block in blocks(batch.column(1)):
                row, hashes = grams(block)
                own = bits[block.first:block.first + block.rows][row]
                for bit in np.unique(own):
                    names, n = np.unique(hashes[own == bit], return_counts=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(names), bit, np.int32)), pa.array(signed(names)), pa.array(n)], names=["bit", "gram", "n"])

    counted = staged(texts.mapInArrow(count, "bit int, gram long, n long").groupBy("bit", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = F.broadcast(counted.groupBy("bit").agg(F.sum("n").alias("total")))
    rates = counted.filter(F.col("n") >= LEAST).join(totals, "bit").withColumn("rate", F.col("n") / F.col("total"))
    best = rates.groupBy("gram").agg(F.max("rate").alias("best"))
    kept = rates.join(best, "gram").filter(F.col("rate") >= SHARE * F.col("best"))
    order = Window.partitionBy("bit").orderBy(F.desc("rate"), "gram")
    chosen = staged(kept.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= GRAMS_PER_LANGUAGE).select("bit", "gram"), "chosen")

    def members() -> Iterator[np.ndarray]:
        """The n-grams of one language after the other; the driver holds those of one word."""
        for first in range(0, len(languages), WORD):
            own = chosen.filter(F.col("bit").between(first, first + WORD - 1)).toPandas()
            bit, gram = own["bit"].to_numpy(), own["gram"].to_numpy(np.int64).view(np.uint64)
            for b in range(first, min(first + WORD, len(languages))):
                yield gram[bit == b]

    return Filter(languages, members())


def predicted(docs: DataFrame, model: Filter) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row.

    A null text or one without a letter is `und` with score 0, and so is every text if no language
    was learnt. A text with letters but no known n-gram gets the most common language with score 0.
    The score is the winner's lead over the runner-up against the winner's count; ties go to the more common language. Null or
    repeated ids and repeated rows are predicted as they are; an empty table gives no rows; further
    columns are ignored.
    """
    names = np.array([*model.languages, UNKNOWN], object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = np.array(batch.column(2).to_pylist(), bool)
            for block in blocks(batch.column(1)):
                counts, n = model.counts(block)
                some = letters[block.first:block.first + block.rows] & bool(model.languages)
                if model.languages:
                    winner = counts.argmax(axis=1)
                    top = np.sort(counts, axis=1)
                    best, next_best = top[:, -1], top[:, -2] if counts.shape[1] > 1 else np.zeros(len(counts))
                    score = np.where(best > 0, (best - next_best) / np.maximum(best, 1e-9), 0.0)
                else:
                    winner, score = np.zeros(block.rows, np.int64), np.zeros(block.rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(block.first, block.rows),
                    pa.array(names[np.where(some, winner, len(model.languages))], pa.string()), pa.array(np.where(some, score, 0.0)),
                ], names=["doc_id", "lang_pred", "score"])

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
