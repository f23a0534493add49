"""Removal of long passages that occur more than once, by de Bruijn compaction.

The edges of the graph are all runs of WINDOW words; an edge is repeated when its words start at
two or more places. Edges are never shuffled one by one. As in minimizer-based compaction of
genome graphs, the smallest hash of the short word runs inside an edge is its anchor, and
neighbouring edges that share an anchor's occurrence form one path: (anchor, first edge, number of
edges, content digest). Equal edges have equal anchors, so all copies of an edge lie in paths of
one anchor, and Spark joins over anchors settle them:

* an anchor that occurs once has no repeated edge;
* an anchor whose paths all have one content is a nonbranching stretch: it is repeated as a whole;
* at an anchor with several contents the graph branches: contents that occur twice are repeated as
  wholes, and one occurrence of each content is unrolled into its edges, which are counted.

Contents and edges compare by two independent 64-bit hashes taken at their source coordinates
(row, first word). Spans of one document are merged into long passages at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridspark.llm.common import free_name, CHECK_LANE, LANE, Block, blocks, signed, sliding_min, staged, words_of

WINDOW = 35
# Word runs of WINDOW - REACH words are the anchors' candidates; an edge holds REACH + 1 of them.
REACH = 25
LOW = np.uint64(63)

SCAN = ("row_no long, doc_id long, n_words long, kept_sha256 string, "
        "runs array<struct<anchor: long, path: long, path_check: long, start: int, edges: int>>")


def paths_of(block: Block, window: int) -> tuple[np.ndarray, dict[str, np.ndarray], np.ndarray]:
    """Words per text, the paths of all texts, and the number of paths before each text."""
    words, check = words_of(block), words_of(block, lane=CHECK_LANE)
    n_words = np.diff(words.bounds)
    edges = len(words.hashes) - window + 1
    size = max(1, window - REACH)
    if edges <= 0:
        empty = np.zeros(0, np.int64)
        return n_words, dict.fromkeys(("anchor", "path", "path_check", "start", "edges"), empty), np.zeros(block.rows + 1, np.int64)
    grams = LANE.grams(words.hashes, size)
    # The low bits say which of the candidates is the smallest; anchors compare without them.
    marked = (grams & ~LOW) | (np.arange(len(grams), dtype=np.uint64) & LOW)
    least = sliding_min(marked, window - size + 1)
    rows = words.rows
    inside = np.flatnonzero(rows[:edges] == rows[window - 1:])
    first = np.arange(edges)
    place = first + (((least & LOW).astype(np.int64) - first) & 63)
    # Where an anchor occurs twice in one edge, edges may repeat inside a path: each is its own path.
    last = sliding_min(marked ^ LOW, window - size + 1)
    tied = (((last ^ least) & LOW) != LOW)[inside]
    place = place[inside]
    begins = np.ones(len(inside), dtype=bool)
    begins[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1] + 1) | tied[1:] | tied[:-1]
    heads = np.flatnonzero(begins)
    counts = np.diff(np.append(heads, len(inside)))
    starts = inside[heads]
    ends = starts + counts + window - 1
    runs = {
        "anchor": signed(least[starts] >> np.uint64(6)), "path": signed(LANE.spans(words.hashes, starts, ends)),
        "path_check": signed(CHECK_LANE.spans(check.hashes, starts, ends)),
        "start": starts - words.bounds[rows[starts]], "edges": counts,
    }
    return n_words, runs, np.searchsorted(starts, words.bounds, "left")


def joined_sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def scanner(window: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("anchor", pa.int64()), ("path", pa.int64()), ("path_check", pa.int64()), ("start", pa.int32()), ("edges", pa.int32())])
        for batch in batches:
            for block in blocks(batch.column(2)):
                n_words, runs, bounds = paths_of(block, window)
                body = block.data.tobytes()
                shas = [joined_sha(body[a:b].split()) for a, b in zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist())]
                values = pa.StructArray.from_arrays([pa.array(runs[f.name], f.type) for f in kind], fields=list(kind))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(block.first, block.rows), batch.column(1).slice(block.first, block.rows),
                    pa.array(n_words), pa.array(shas, pa.string()),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), values),
                ], names=["row_no", "doc_id", "n_words", "kept_sha256", "runs"])

    return scan


UNROLLED = "row_no long, anchor long, edge long, edge_check long, start int, copies long"


def unroller(window: int):
    def unroll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources = batch.column(2)
            for block in blocks(batch.column(1)):
                words, check = words_of(block), words_of(block, lane=CHECK_LANE)
                edge, edge_check = LANE.grams(words.hashes, window), CHECK_LANE.grams(check.hashes, window)
                wanted = sources.slice(block.first, block.rows)
                flat = wanted.flatten()
                per_row = np.diff(wanted.offsets.to_numpy())
                row = np.repeat(np.arange(block.rows), per_row)
                anchor, start, count, copies = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                which = np.repeat(np.arange(len(start)), count)
                step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
                at = start[which].astype(np.int64) + step
                places = words.bounds[row[which]] + at
                ids = batch.column(0).slice(block.first, block.rows).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[row[which]]), pa.array(anchor[which]), pa.array(signed(edge[places])),
                    pa.array(signed(edge_check[places])), pa.array(at.astype(np.int32)), pa.array(copies[which]),
                ], names=["row_no", "anchor", "edge", "edge_check", "start", "copies"])

    return unroll


def covered(n_words: int, starts: np.ndarray, edges: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in the given edges."""
    depth = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + edges + window - 1, -1)
    return np.cumsum(depth[:-1]) > 0


def cut(text: bytes, gone: np.ndarray) -> bytes:
    """The text without the given words; what stays keeps its own white space."""
    words = words_of(Block(0, np.frombuffer(text, np.uint8), np.array([0, len(text)])))
    edges = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    out, at = [], 0
    for begin, end in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
        out.append(text[at:int(words.starts[begin])])
        at = int(words.starts[end]) if end < len(gone) else len(text)
    out.append(text[at:])
    return b"".join(out)


TAKEN = "row_no long, n_removed long, kept_sha256 string, kept_text string"


def taker(window: int, texts: bool):
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py()
                raw = b"" if raw is None else raw
                words = raw.split()
                spans = batch.column(2)[i].values
                gone = covered(len(words), spans.field(0).to_numpy(), spans.field(1).to_numpy(), window)
                kept = [word for word, out in zip(words, gone.tolist()) if not out]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, 1), pa.array([int(gone.sum())]), pa.array([joined_sha(kept)]),
                    pa.array([cut(raw, gone) if texts else None], pa.binary()).cast(pa.string()),
                ], names=["row_no", "n_removed", "kept_sha256", "kept_text"])

    return take


def numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def find(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Two tables: every row with its word count and digest, and the repeated spans by row
    (row_no, spans of first edge and number of edges)."""
    rows = staged(numbered(docs).mapInArrow(scanner(window), SCAN), "paths")
    runs = rows.select("row_no", F.inline("runs"))
    keys = ["anchor", "path", "path_check"]
    # Staged, so that the join below has two plain shuffles and Spark can split a frequent anchor.
    anchors = staged(runs.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("path").alias("p0"), F.max("path").alias("p1"),
        F.min("path_check").alias("c0"), F.max("path_check").alias("c1"),
    ).filter("n > 1").select("anchor", F.expr("p0 = p1 AND c0 = c1").alias("nonbranching")), "anchors")
    hits = staged(runs.join(anchors, "anchor"), "hits")
    whole = hits.filter("nonbranching").select("row_no", "start", "edges")

    branching = hits.filter("NOT nonbranching")
    contents = staged(branching.groupBy(keys).agg(
        F.count("*").alias("copies"), F.min(F.struct("row_no", "start", "edges")).alias("source")), "contents")
    copied = branching.join(contents.filter("copies > 1").select(keys), keys, "left_semi").select("row_no", "start", "edges")
    sources = contents.groupBy(F.col("source.row_no").alias("row_no")).agg(
        F.collect_list(F.struct("anchor", "source.start", "source.edges", "copies")).alias("sources"))
    texts = numbered(docs).select("row_no", "text")
    unrolled = staged(texts.join(sources, "row_no").mapInArrow(unroller(window), UNROLLED), "edges")
    edge = ["anchor", "edge", "edge_check"]
    repeated = staged(unrolled.groupBy(edge).agg(F.count("*").alias("n")).filter("n > 1").select(edge), "repeated")
    single = unrolled.filter("copies = 1").join(repeated, edge, "left_semi").select("row_no", "start", F.lit(1).alias("edges"))
    spans = whole.unionByName(copied).unionByName(single).groupBy("row_no").agg(
        F.collect_list(F.struct("start", "edges")).alias("spans"))
    return rows, staged(spans, "spans")


def take_out(docs: DataFrame, spans: DataFrame, window: int, texts: bool) -> DataFrame:
    return numbered(docs).select("row_no", F.col("text").cast("binary").alias("text")).join(spans, "row_no").mapInArrow(
        taker(window, texts), TAKEN)


def report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 of the words that stay.

    A word goes when it lies in a run of `window` words that also starts anywhere else, in the same
    text or another. Null and empty texts have no words; repeated rows are copies of each other; an
    empty table gives no rows; null ids stay null; further columns are ignored.
    """
    rows, spans = find(docs, window)
    changed = take_out(docs, spans, window, texts=False).select(
        "row_no", "n_removed", F.col("kept_sha256").alias("new_sha256"))
    return rows.select("row_no", "doc_id", "n_words", "kept_sha256").join(changed, "row_no", "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("new_sha256", "kept_sha256").alias("kept_sha256"))


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with the repeated passages taken out of `text`; other texts and all rows stay as they are."""
    _, spans = find(docs, window)
    changed = staged(take_out(docs, spans, window, texts=True).select("row_no", "kept_text"), "cut")
    number, cut = free_name(docs), free_name(docs, "__text")
    marked = docs.withColumn(number, F.monotonically_increasing_id())
    new = changed.withColumnRenamed("row_no", number).withColumnRenamed("kept_text", cut)
    joined = marked.join(new, number, "left")
    text = F.when(F.col(cut).isNotNull(), F.col(cut)).otherwise(F.col("text"))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cut).isNotNull(), F.length(cut)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
