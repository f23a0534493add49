"""Document fingerprints from prefix polynomial hashes.

`Prefixes` keeps the hashes of all prefixes of a text modulo two primes. Any span's hash follows
from two of them, so equality of spans takes constant time and the longest common extension of
two places is found by binary search. A fingerprint holds the text's hash, samples of the prefix
and suffix hashes at multiples of a power of two, and the least hashes of all short spans, which go
by the spans' content, wherever they stand. Two fingerprints are compared by binary search for the
longest common prefix and suffix, and by the share of least hashes that agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gridspark.llm.common import mix, staged

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 998_244_353)
SAMPLES = 32
# Code points of a span whose hash may stand for the text's inside, and how many such hashes are kept.
SPAN, SLOTS = 16, 64
DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


class Powers:
    """Powers of a base and of its inverse modulo a prime, grown by doubling."""

    def __init__(self, base: int, prime: int) -> None:
        self.prime = np.uint64(prime)
        self.base, self.inverse = base, pow(base, -1, prime)
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        while len(self.up) < n:
            step = len(self.up)
            up, down = (np.uint64(pow(x, step, int(self.prime))) for x in (self.base, self.inverse))
            self.up = np.concatenate([self.up, self.up * up % self.prime])
            self.down = np.concatenate([self.down, self.down * down % self.prime])


POWERS = [Powers(base, prime) for base, prime in zip(BASES, PRIMES)]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


class Prefixes:
    """Hashes of all prefixes of a sequence of code points."""

    def __init__(self, values: np.ndarray) -> None:
        self.n = len(values)
        self.sums = []
        for powers in POWERS:
            powers.grow(self.n + 1)
            sums = np.zeros(self.n + 1, np.uint64)
            # Terms are below 2**31, so sums of fewer than 2**33 of them fit without a remainder.
            np.cumsum((values + np.uint64(1)) * powers.up[:self.n] % powers.prime, out=sums[1:])
            self.sums.append(sums)

    def spans(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of the given spans; equal spans of any texts have equal hashes."""
        first, second = ((sums[end] - sums[begin]) % powers.prime * powers.down[begin] % powers.prime for sums, powers in zip(self.sums, POWERS))
        return (first << np.uint64(31)) | second

    def short_spans(self, length: int) -> np.ndarray:
        """31-bit hashes of all spans of a length up to 16, by the first prime alone, whose remainders
        need no division."""
        n, sums, prime = max(0, self.n - length + 1), self.sums[0], POWERS[0].prime

        def folded(x: np.ndarray) -> np.ndarray:
            return (x & prime) + (x >> np.uint64(31))

        # A sum of 16 terms below 2**31 folds to little more than 2**31.
        out = folded(folded(folded(sums[length:length + n] - sums[:n]) * POWERS[0].down[:n]))
        return np.where(out >= prime, out - prime, out)

    def equal(self, i: int, other: "Prefixes", j: int, length: int) -> bool:
        a, b = (x.spans(np.array([at]), np.array([at + length]))[0] for x, at in ((self, i), (other, j)))
        return bool(a == b)

    def extension(self, i: int, other: "Prefixes", j: int) -> int:
        """Length of the longest common extension of place i here and place j there."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(i, other, j, middle) else (low, middle - 1)
        return low


def written(hashes: np.ndarray, digits: int) -> str:
    """The low bits of hashes, six to a character."""
    places = np.arange(digits, dtype=np.uint64) * np.uint64(6)
    return DIGITS[(hashes[:, None] >> places & np.uint64(63)).astype(np.int64)].tobytes().decode()


def least_spans(prefixes: Prefixes) -> str:
    """Of all spans of SPAN code points, the least hash in each of SLOTS equal ranges, two characters
    each and `..` where there is none."""
    ordered = np.sort(mix(prefixes.short_spans(SPAN)))
    edges = np.searchsorted(ordered >> np.uint64(58), np.arange(SLOTS + 1, dtype=np.uint64))
    full = edges[1:] > edges[:-1]
    texts = written(ordered[edges[:-1][full]], 2)
    found = iter(range(0, len(texts), 2))
    return "".join(texts[(k := next(found)):k + 2] if one else ".." for one in full.tolist())


def fingerprint(values: np.ndarray) -> str:
    """n:step:hash:prefix samples:suffix samples:least spans; step is the smallest power of two that
    leaves at most SAMPLES multiples, and each sample is 18 bits of a span's hash."""
    n, step = len(values), 1
    while n // step > SAMPLES:
        step *= 2
    prefixes = Prefixes(values)
    marks = np.arange(1, n // step + 1) * step
    zero = np.zeros(len(marks), np.int64)
    heads, tails = prefixes.spans(zero, marks), prefixes.spans(n - marks, zero + n)
    whole = int(prefixes.spans(np.array([0]), np.array([n]))[0])
    return f"{n}:{step}:{whole:016x}:{written(heads, 3)}:{written(tails, 3)}:{least_spans(prefixes)}"


def agreement(one: str, other: str, step_a: int, step_b: int, common: int) -> int:
    """The largest multiple of the larger step up to which the samples agree, by binary search."""
    step = max(step_a, step_b)
    low, high = 0, common // step
    while low < high:
        middle = (low + high + 1) // 2
        i, j = (3 * (middle * step // s - 1) for s in (step_a, step_b))
        low, high = (middle, high) if one[i:i + 3] == other[j:j + 3] else (low, middle - 1)
    return low * step


def common_spans(one: str, other: str, n: int, m: int) -> float:
    """About how many spans two texts of n and m code points share, from the share of least hashes
    that agree among those that either text has."""
    pairs = [(one[k:k + 2], other[k:k + 2]) for k in range(0, 2 * SLOTS, 2)]
    either = sum(a != ".." or b != ".." for a, b in pairs)
    alike = sum(a == b != ".." for a, b in pairs) / max(1, either)
    # Of a and b spans, alike * (a + b - both) are both.
    return alike * (n + m) / (1 + alike)


def likeness(one: str, other: str) -> float:
    """Share of the longer text that is common to both: the common prefix and suffix, or, if more,
    the common spans wherever they stand. 1 for equal fingerprints only.

    The prefix and suffix are seen in steps of about 1 / SAMPLES of the text. The spans' share is an
    estimate (standard error up to 0.08) that counts repeated spans once and sees nothing common
    that is shorter than SPAN code points.
    """
    if one == other:
        return 1.0
    a, b = one.split(":"), other.split(":")
    n, m = int(a[0]), int(b[0])
    least, most = min(n, m), max(n, m)
    ends = sum(agreement(a[k], b[k], int(a[1]), int(b[1]), least) for k in (3, 4))
    return min(max(ends, common_spans(a[5], b[5], n, m)), least, most - 1) / most


COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
WALKED = COMPARED + ", part int, head_text string, open_text string"


def compare(doc_id: int | None, text: str, own: str, following: str, next_fingerprint: str) -> tuple:
    half = len(text) // 2
    edited = text[:len(text) - half] + following[:half]
    changed = fingerprint(points(edited))
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), sha, own, changed, likeness(own, changed), likeness(own, next_fingerprint)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[kind]) for x, (_, kind) in zip(zip(*rows), fields)], names=[name for name, _ in fields])


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the one after it in this sorted partition; the first and last keep their texts."""
    part = TaskContext.get().partitionId()
    last: tuple | None = None
    head: str | None = None
    for batch in batches:
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = fingerprint(points(text))
            if last is None:
                head = text
            else:
                out.append(compare(*last, text, own) + (part, head, None))
                head = None
            last = (doc_id, text, own)
        if out:
            yield batch_of(out, WALKED)
    if last is not None:
        doc_id, text, own = last
        yield batch_of([(doc_id, len(text), None, own, None, None, None, part, head, text)], WALKED)


def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in range(4)))
        out = [compare(doc_id, text, own, head, fingerprint(points(head))) for doc_id, text, own, head in rows]
        if out:
            yield batch_of(out, COMPARED)


def compared(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The next document is the one with the next smaller doc_id; nulls come last, rows of equal ids
    follow each other by a hash of their texts, and the last row's next is the first. A null text
    counts as empty; two empty texts are alike (1), an empty and another one are not (0). A table
    of one row is its own next; an empty table gives no rows; further columns are ignored.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("row_no")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("row_no"))
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    seen = staged(ranged.mapInArrow(walk, WALKED), "fingerprints")
    done = seen.filter("open_text IS NULL").select(*[x.split()[0] for x in COMPARED.split(", ")])
    # One number per partition: which partition's first row follows each partition's last one.
    parts = sorted(row["part"] for row in seen.filter("head_text IS NOT NULL").select("part").collect())
    follows = docs.sparkSession.createDataFrame(
        [(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)], "part int, next_part int")
    heads = seen.filter("head_text IS NOT NULL").select(F.col("part").alias("next_part"), F.col("head_text").alias("next_text"))
    opened = seen.filter("open_text IS NOT NULL").join(follows, "part").join(heads, "next_part").select("doc_id", "open_text", "fingerprint", "next_text")
    return done.unionByName(opened.mapInArrow(close, COMPARED))
