"""Hashed words and word beginnings of texts, looked up in a sorted vocabulary."""

from __future__ import annotations

import numpy as np

from gridspark.llm.common import LANE, SPACE, Block, mix, word_spans

# Inflected and compounded forms share a beginning: 0 is the whole word, others are bytes from its start.
LENGTHS = (0, 4, 5, 6)
# ASCII punctuation at a word's ends is not part of it.
EDGE = SPACE.copy()
EDGE[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


def trimmed_words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of words, split at white space and ASCII punctuation."""
    if not len(block.data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # word_spans works on white space; punctuation is turned into it first.
    return word_spans(np.where(EDGE[block.data], 0x20, block.data).astype(np.uint8), block.offsets)


def features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every feature of every word of a block, repeats included; A-Z as a-z."""
    starts, ends = trimmed_words(block)
    rows = np.searchsorted(block.offsets, starts, "right") - 1
    values = LANE.lower[block.data]
    LANE.grow(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * LANE.powers[:len(values)], out=sums[1:])
    out_rows, out = [], []
    for length in LENGTHS:
        if length:
            at = np.flatnonzero(ends - starts > length)
            begin, end = starts[at], starts[at] + length
        else:
            at, begin, end = slice(None), starts, ends
        out.append(mix((sums[end] - sums[begin]) * LANE.inverses[begin] + np.uint64(length * 0x9E3779B97F4A7C15 % (1 << 64))))
        out_rows.append(rows[at])
    return np.concatenate(out_rows), np.concatenate(out)


def distinct(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of each distinct feature of each row."""
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    first = np.ones(len(rows), dtype=bool)
    first[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(first)
    return rows[at], hashes[at], np.diff(np.append(at, len(rows)))


def lookup(vocabulary: np.ndarray, rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and vocabulary place of the features that the sorted vocabulary has."""
    if not len(vocabulary) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A table over the top 16 bits rules most features out before the search.
    top = np.zeros(1 << 16, dtype=bool)
    top[(vocabulary >> np.uint64(48)).astype(np.int64)] = True
    maybe = np.flatnonzero(top[(hashes >> np.uint64(48)).astype(np.int64)])
    at = np.minimum(np.searchsorted(vocabulary, hashes[maybe]), len(vocabulary) - 1)
    hit = vocabulary[at] == hashes[maybe]
    return rows[maybe[hit]], at[hit]
