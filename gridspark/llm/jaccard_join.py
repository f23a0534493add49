"""Exact Jaccard similarity join of word-shingle sets, as a metric-space join over pivots.

Most documents share nothing and lie at distance 1 from each other and from any pivot, where no
pivot tells them apart. So pivots claim their regions by signatures: a set is divided by hash into
more classes than a link may have differing shingles, and two linked sets agree on a whole class.
Only classes with shingles count; a set of which too many classes are empty is divided again by
another hash. The first set with a signature is the pivot of all that share it, and a set is
replicated into the region of each of its pivots, so every linked pair meets in some region.

A region is then split again in a space onto which the metric contracts: counts of shingles per
hash class differ by no more than the sets do. What stays together is joined exactly: the most
central member is the pivot, its ball (distance up to the threshold) is one component, and further
pairs are compared only if their components differ and the triangle inequality over the pivots
allows a link. Regions are counted before they move, and one of too many members to gather is not
split by counts: its lowest row is the pivot. A region too large for a task first measures all its
members against its pivot; only the residual outside the ball is compared, in blocks, with the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridspark.llm.common import LANE, Block, blocks, free_name, mix, signed, staged, words_of
from gridspark.llm.components import components

WORDS, PERCENT = 5, 80
FLUSH = 1 << 19
# A region of more members or shingles than these is measured against its pivot and cut in blocks.
REGION_ROWS, REGION_SHINGLES = 512, 1 << 21
# Hashes by which a set is divided before its least shingles are taken.
DIVISIONS = 4


def shingle_sets(block: Block, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; A-Z count as a-z. A text of fewer words is
    one shingle, one without words has none."""
    words = words_of(block, lower=True)
    grams = LANE.grams(words.hashes, size)
    bounds = words.bounds.tolist()
    for begin, end in zip(bounds[:-1], bounds[1:]):
        if end - begin >= size:
            values = np.sort(grams[begin:end - size + 1])
            keep = np.empty(len(values), dtype=bool)
            keep[0] = True
            np.not_equal(values[1:], values[:-1], out=keep[1:])
            yield values[keep]
        elif end > begin:
            yield LANE.spans(words.hashes[begin:end], np.array([0]), np.array([end - begin]))
        else:
            yield np.zeros(0, dtype=np.uint64)


COUNTS = 128
PROFILE = "row_no long, doc_id long, n_shingles long, set_a long, set_b long, counts binary"


def profiler(size: int):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                n, a, b, counts = [], [], [], []
                for values in shingle_sets(block, size):
                    n.append(len(values))
                    a.append(mix(values).sum(dtype=np.uint64))
                    b.append(mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                    counts.append(np.bincount((values & np.uint64(COUNTS - 1)).astype(np.int64), minlength=COUNTS).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(block.first, block.rows), batch.column(1).slice(block.first, block.rows),
                    pa.array(n, pa.int64()), pa.array(signed(np.array(a, np.uint64))), pa.array(signed(np.array(b, np.uint64))),
                    pa.array(counts, pa.binary()),
                ], names=["row_no", "doc_id", "n_shingles", "set_a", "set_b", "counts"])

    return profile


def size_steps(percent: int, most: int) -> list[int]:
    """Lower bounds of size ranges; a link joins sizes of one range or of neighbouring ranges."""
    steps = [1]
    while steps[-1] <= most:
        steps.append(steps[-1] * 100 // percent + 1)
    return steps + [steps[-1] * 100 // percent + 1]


def classes(step: int, steps: list[int], percent: int) -> tuple[int, int]:
    """Number of classes for sizes in steps[step] up to those in the next range, and how many empty
    classes a set may have without being divided again.

    Linked sets x, y differ in at most (1 - t) / (1 + t) * (|x| + |y|) shingles, so they agree on at
    least 1 + spare classes; if at most `spare` of x's are empty, one of the agreeing ones is not.
    """
    largest = steps[step + 2] - 1
    differ = math.floor(Fraction(100 - percent, 100 + percent) * 2 * largest)
    # Shingles per class of the smallest set: classes that happen to be empty say nothing.
    empty = math.exp(-steps[step] / (differ + 1))
    spare = 1 + math.ceil(1.5 * empty * (differ + 1)) if differ else 0
    return differ + 1 + spare, spare


def signatures(values: np.ndarray, percent: int, steps: list[int]) -> np.ndarray:
    """Marks of a set; each is made of shingles that the set has, and linked sets share one.

    A set is divided by one hash after another until at most `spare` of its classes are empty. Of two
    linked sets, take the one that ends first: there it has few empty classes, the other one is
    divided in the same way, and they agree on a class with shingles. Sets that never end (their
    size allows few full classes) share one of their least shingles instead, as each link leaves
    out at most n - ceil(t * n) shingles of a set of n.
    """
    own = int(np.searchsorted(steps, len(values), "right")) - 1
    out = []
    for step in (own - 1, own):
        if step < 0:
            continue
        k, spare = classes(step, steps, percent)
        for division in range(DIVISIONS):
            # The first division goes by the shingles' own hashes, which are sorted already.
            order = values if not division else np.sort(mix(values + mix(np.array([division], np.uint64))))
            hashed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(order ^ np.uint64(0xD6E8FEB86659FD93)))])
            cuts = np.searchsorted(order >> np.uint64(32), (np.arange(k + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(k), "left")
            cuts[-1] = len(values)
            count = np.diff(cuts)
            name = mix(np.arange(k, dtype=np.uint64) + np.uint64((step << 40) + (division << 32)))
            out.append(mix((hashed[cuts[1:]] - hashed[cuts[:-1]]) + name)[count > 0])
            if (count == 0).sum() <= spare:
                break
        else:
            least = values[:len(values) - -(-percent * len(values) // 100) + 1]
            out.append(mix(mix(least) + np.uint64((step << 40) + (DIVISIONS << 32))))
    return np.concatenate(out)


MARKS = "key long, row_no long"


def marker(size: int, percent: int):
    def flush(keys: list[np.ndarray], rows: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(signed(np.concatenate(keys))), pa.array(np.repeat(np.array(rows, np.int64), [len(k) for k in keys])),
        ], names=["key", "row_no"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = size_steps(percent, 1024)
        keys, rows, seen, held = [], [], set(), 0
        for batch in batches:
            row_nos = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                for i, values in enumerate(shingle_sets(block, size)):
                    if not len(values):
                        continue
                    # A copy of a set that was just marked has nothing to add.
                    same = hash(values.tobytes())
                    if same in seen:
                        continue
                    seen.add(same)
                    if len(values) >= steps[-3]:
                        steps = size_steps(percent, 2 * len(values))
                    keys.append(signatures(values, percent, steps))
                    rows.append(row_nos[block.first + i])
                    held += len(keys[-1])
                    if held > FLUSH:
                        yield flush(keys, rows)
                        keys, rows, seen, held = [], [], set(), 0
        if keys:
            yield flush(keys, rows)

    return mark


def most_apart(sizes: np.ndarray, other: np.ndarray | int, percent: int) -> np.ndarray:
    """The largest number of differing shingles a link of such sizes can have."""
    return (sizes + other) * (100 - percent) // (100 + percent)


NEAR = "region long, row_no long, rank int, members int, shingles long"


def nearer(percent: int):
    """Split regions where count vectors differ by more than linked sets can; drop lone members.
    A region is held as a whole, so only those of a bounded number of members may come here."""

    def split(rows: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
        m = len(rows)
        label = np.arange(m)
        for i in range(m):
            gap = np.abs(counts - counts[i]).sum(axis=1)
            near = np.flatnonzero(gap <= most_apart(sizes, sizes[i], percent))
            least = label[near].min()
            label[np.isin(label, label[near])] = least
        for one in np.unique(label):
            own = np.flatnonzero(label == one)
            if len(own) > 1:
                # Equal groups reach several pivots; their name and ranks are made of their members.
                own = own[np.argsort(rows[own])]
                apart = np.abs(counts[own] - counts[own].mean(axis=0)).sum(axis=1)
                own = own[np.lexsort((rows[own], apart))]
                name = int(signed(mix(mix(rows[own].view(np.uint64)).sum(dtype=np.uint64) + np.arange(1, dtype=np.uint64)))[0])
                for rank, i in enumerate(own):
                    yield name, int(rows[i]), rank, len(own), int(sizes[own].sum())

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for region, table in runs_of(batches):
            out = list(split(
                table.column("row_no").to_numpy(), table.column("n_shingles").to_numpy(),
                np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int32).reshape(-1, COUNTS)))
            if out:
                yield pa.RecordBatch.from_arrays([
                    pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))
                ], names=["region", "row_no", "rank", "members", "shingles"])

    return near


def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Runs of equal first columns in sorted batches, one at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else [0]
        for begin, end in zip(cuts[:-1], cuts[1:]):
            if held and held[0].column(0)[0].as_py() != keys[begin]:
                yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
    if held:
        yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)


SETS = "region long, row_no long, rank int, members int, shingles long, hashes binary"


def setter(size: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                for i, values in enumerate(shingle_sets(block, size)):
                    at = block.first + i
                    seats = batch.column(2).slice(at, 1).flatten()
                    names = [f.name for f in seats.type]
                    yield pa.RecordBatch.from_arrays([
                        seats.field(names.index("region")), pa.array([batch.column(0)[at].as_py()] * len(seats), pa.int64()),
                        *(seats.field(names.index(x)) for x in ("rank", "members", "shingles")),
                        pa.array([values.tobytes()] * len(seats), pa.binary()),
                    ], names=["region", "row_no", "rank", "members", "shingles", "hashes"])

    return make


def shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many of the sorted set's values each of the others has."""
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    ends = np.cumsum([len(x) for x in others])
    hits = np.concatenate([[0], np.cumsum(one[at] == flat)])
    return np.diff(hits[np.concatenate([[0], ends])])


def linked(common: np.ndarray, size: int, sizes: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (size + sizes - common)


LINKS = "a long, b long"


def joiner(percent: int, every: bool = False):
    """Links that span the components of each block of a region, exactly; or every link."""
    radius = 1 - percent / 100 + 1e-9

    def join(rows: np.ndarray, sets: list[np.ndarray], ball: np.ndarray, residual: np.ndarray) -> Iterator[tuple[int, int]]:
        sizes = np.array([len(x) for x in sets])
        label = np.arange(len(rows))
        if ball.any():
            label[ball] = np.flatnonzero(ball)[0]
        measured: list[np.ndarray] = []
        for i in range(len(rows)):
            near = ((label != label[i]) | every) & (residual | residual[i])
            near[:i + 1] = False
            near &= 100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])
            for distance in measured:
                near &= ~(np.abs(distance - distance[i]) > radius)
            others = np.flatnonzero(near)
            if not len(others):
                continue
            common = shared(sets[i], [sets[j] for j in others])
            if len(measured) < 8:
                distance = np.full(len(rows), np.nan)
                distance[others] = 1 - common / (sizes[i] + sizes[others] - common)
                distance[i] = 0
                measured.append(distance)
            for j in others[linked(common, sizes[i], sizes[others], percent)]:
                if every or label[j] != label[i]:
                    yield int(rows[i]), int(rows[j])
                if not every:
                    label[label == label[j]] = label[i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in runs_of(batches):
            sets = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
            rank = np.argsort(table.column("rank").to_numpy(), kind="stable")
            out = list(join(table.column("row_no").to_numpy()[rank], [sets[i] for i in rank],
                            np.array(table.column("ball").to_pylist(), bool)[rank], np.array(table.column("residual").to_pylist(), bool)[rank]))
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


MEASURED = "region long, row_no long, rank int, members int, shingles long, hashes binary, pivot long, ball boolean"


def measurer(percent: int, every: bool = False):
    """Whether each member is in its pivot's ball. Where every link is wanted, balls stand for
    nothing, and all members are residual."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ball = []
            for own, pivot in zip(batch.column("hashes").to_pylist(), batch.column("pivot_hashes").to_pylist()):
                one, other = np.frombuffer(pivot, np.uint64), np.frombuffer(own, np.uint64)
                ball.append(not every and bool(linked(shared(one, [other]), len(one), np.array([len(other)]), percent)[0]))
            keep = [batch.column(x) for x in ("region", "row_no", "rank", "members", "shingles", "hashes", "pivot")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(ball)], names=[x.split()[0] for x in MEASURED.split(", ")])

    return measure


def blocked(large: DataFrame, percent: int, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """Large regions: the links of each ball to its pivot, and members by pair of blocks (residual
    rows in bands, all rows in stripes), so that each residual row meets every other row once."""
    pivots = large.filter("rank = 0").select("region", F.col("row_no").alias("pivot"), F.col("hashes").alias("pivot_hashes"))
    seen = staged(large.join(pivots, "region").mapInArrow(measurer(percent, every), MEASURED), "measured")
    ball = seen.filter("ball AND row_no <> pivot").select(F.col("row_no").alias("a"), F.col("pivot").alias("b"))
    counts = seen.groupBy("region").agg(
        F.greatest(F.lit(1), F.ceil(F.greatest(F.sum(F.expr("int(NOT ball)")) / REGION_ROWS, F.sum(F.expr("if(ball, 0, octet_length(hashes))")) / 8 / REGION_SHINGLES))).cast("int").alias("bands"),
        F.greatest(F.lit(1), F.ceil(F.greatest(F.count("*") / REGION_ROWS, F.sum(F.octet_length("hashes")) / 8 / REGION_SHINGLES))).cast("int").alias("stripes"))
    own = seen.join(counts, "region").withColumn("band", F.pmod(F.xxhash64("row_no"), "bands")).withColumn(
        "stripe", F.pmod(F.xxhash64("row_no", F.lit(1)), "stripes"))
    columns = ["row_no", "rank", "hashes", "ball"]
    in_bands = own.filter("NOT ball").select(
        F.explode(F.expr("sequence(0, stripes - 1)")).alias("s"), F.col("band").alias("b"), "region", *columns, F.lit(True).alias("residual"))
    in_stripes = own.select(
        F.explode(F.expr("sequence(0, bands - 1)")).alias("b"), F.col("stripe").alias("s"), "region", *columns, F.lit(False).alias("residual"))
    # A residual row of both is one member of the block.
    both = in_bands.unionByName(in_stripes.join(
        in_bands.select("region", "b", "s", "row_no"), ["region", "b", "s", "row_no"], "left_anti"))
    cells = both.select(F.xxhash64("region", "b", "s").alias("region"), *columns, "residual")
    return ball, cells


def numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def by_region(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("region", *columns).repartition("region").sortWithinPartitions("region")


def representatives(profiles: DataFrame) -> DataFrame:
    """row_no, doc_id, n_shingles and `rep`, the first row of an equal set, for rows with shingles."""
    same = ["n_shingles", "set_a", "set_b"]
    # Staged, the aggregate is a plain side of the join, and a set of very many rows can be split.
    first = staged(profiles.filter("n_shingles > 0").groupBy(same).agg(F.min("row_no").alias("rep")), "first")
    return staged(profiles.join(first, same).select("row_no", "doc_id", "n_shingles", "rep"), "reps")


def regions_of(docs: DataFrame, reps: DataFrame, words: int, percent: int) -> DataFrame:
    """region, row_no, n_shingles, members, shingles, pivot: seats of regions of two members or more.
    Of equal sets one stands for all, and of regions with equal members one is kept."""
    marks = numbered(docs).select("row_no", "text").mapInArrow(marker(words, percent), MARKS)
    key = Window.partitionBy("key")
    meet = marks.select("row_no", F.min("row_no").over(key).alias("region"), F.max("row_no").over(key).alias("last"))
    seats = meet.filter("region <> last").select("region", "row_no").distinct()
    seats = staged(seats.join(reps.select("row_no", "n_shingles", "rep"), "row_no").select(
        "region", F.col("rep").alias("row_no"), "n_shingles").distinct(), "seats")
    sizes = seats.groupBy("region").agg(
        F.count("*").alias("members"), F.sum("n_shingles").alias("shingles"), F.min("row_no").alias("pivot"),
        F.bit_xor(F.xxhash64("row_no")).alias("name_a"), F.bit_xor(F.xxhash64("row_no", F.lit(1))).alias("name_b"))
    equal = ["members", "shingles", "pivot", "name_a", "name_b"]
    kept = staged(sizes.filter("members > 1").groupBy(equal).agg(F.min("region").alias("region")).drop("name_a", "name_b"), "regions")
    return seats.join(kept, "region")


def links(docs: DataFrame, profiles: DataFrame, reps: DataFrame, words: int, percent: int, every: bool = False) -> DataFrame:
    """a, b: rows of different sets whose links span the components; or every link, once or more."""
    seats = staged(regions_of(docs, reps, words, percent), "seated")
    gathered = F.expr(f"members <= {4 * REGION_ROWS}")
    # A representative's own row has its counts.
    known = profiles.select("row_no", "counts")
    members = seats.filter(gathered).select("region", "row_no", "n_shingles").join(known, "row_no")
    crowds = seats.filter(~gathered).select(
        F.xxhash64("region", F.lit("crowd")).alias("region"), "row_no", F.expr("int(row_no <> pivot)").alias("rank"),
        F.col("members").cast("int").alias("members"), "shingles")
    split = by_region(members, "row_no", "n_shingles", "counts").mapInArrow(nearer(percent), NEAR).distinct()
    near = staged(split.unionByName(crowds), "near")
    fits = F.expr(f"members <= {REGION_ROWS} AND shingles <= {REGION_SHINGLES}")
    columns = ["row_no", "rank", "hashes", "ball", "residual"]
    small = sets_of(docs, near.filter(fits), words).withColumns({"ball": F.lit(False), "residual": F.lit(True)})
    found = by_region(small, *columns).mapInArrow(joiner(percent, every), LINKS)
    large = near.filter(~fits)
    if large.isEmpty():
        return found
    ball, cells = blocked(staged(sets_of(docs, large, words), "sets"), percent, every)
    return found.unionByName(by_region(cells, *columns).mapInArrow(joiner(percent, every), LINKS)).unionByName(ball)


def sets_of(docs: DataFrame, seats: DataFrame, words: int) -> DataFrame:
    """The shingle sets of all members of the given regions, once per region."""
    chairs = seats.groupBy("row_no").agg(F.collect_list(F.struct("region", "rank", "members", "shingles")).alias("seats"))
    # One way of joining at every size: the texts move once, so the work grows in proportion.
    return numbered(docs).select("row_no", "text").join(chairs.hint("merge"), "row_no").mapInArrow(setter(words), SETS)


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: row_no, doc_id, n_shingles, component_id, and `first`, whether the row
    is the one of its component that stays.

    Rows link when their sets of `words`-word shingles (A-Z as a-z) have 100 * intersection >=
    percent * union; component_id is the smallest doc_id reachable by links. Texts without words
    have no shingles and link with nothing; null and empty texts are such. A null id is larger than
    any other; a component of null ids has a null component_id. Repeated rows are equal sets. An
    empty table gives no rows; further columns are ignored.
    """
    profiles = staged(numbered(docs).mapInArrow(profiler(words), PROFILE), "profiles")
    reps = representatives(profiles)
    roots = components(links(docs, profiles, reps, words, percent)).select(F.col("node").alias("rep"), "component")
    placed = reps.join(roots, "rep", "left").select(
        "row_no", "doc_id", "n_shingles", F.coalesce("component", "rep").alias("root"))
    alone = profiles.filter("n_shingles = 0").select("row_no", "doc_id", "n_shingles", F.col("row_no").alias("root"))
    placed = staged(placed.unionByName(alone), "placed")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("blank"), F.col("doc_id").alias("id"), F.col("row_no").alias("row")))
    heads = staged(placed.groupBy("root").agg(head.alias("head")), "heads")
    return placed.join(heads, "root").select(
        "row_no", "doc_id", "n_shingles", F.col("head.id").alias("component_id"), (F.col("row_no") == F.col("head.row")).alias("first"))


def all_links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Every link, as pairs of classes and the rows of each class.

    A class is a set that one row or more have; its name is its first row's number. The links are
    class_a, class_b (class_a < class_b), once each. The rows are row_no, doc_id, n_shingles,
    class_id and n_links: with how many other rows the row links, copies of its set included. Rows
    without words have a null class and no links; nulls, repeated rows, empty tables and further
    columns are as in `groups`.
    """
    profiles = staged(numbered(docs).mapInArrow(profiler(words), PROFILE), "profiles")
    reps = representatives(profiles)
    pairs = staged(links(docs, profiles, reps, words, percent, every=True).select(
        F.least("a", "b").alias("class_a"), F.greatest("a", "b").alias("class_b")).distinct(), "pairs")
    copies = staged(reps.groupBy("rep").agg(F.count("*").alias("copies")), "copies")
    both = pairs.unionByName(pairs.select(F.col("class_b").alias("class_a"), F.col("class_a").alias("class_b")))
    linked_rows = both.join(copies.withColumnRenamed("rep", "class_b"), "class_b").groupBy("class_a").agg(F.sum("copies").alias("others"))
    counted = staged(copies.join(linked_rows.withColumnRenamed("class_a", "rep"), "rep", "left").select(
        "rep", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "counted")
    rows = reps.join(counted, "rep").select("row_no", "doc_id", "n_shingles", F.col("rep").alias("class_id"), "n_links")
    alone = profiles.filter("n_shingles = 0").select(
        "row_no", "doc_id", "n_shingles", F.lit(None).cast("long").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return pairs, rows.unionByName(alone)


def keep_first(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` without those that link, directly or not, to a row that stays."""
    number = free_name(docs)
    gone = groups(docs, words, percent).filter("NOT first").select(F.col("row_no").alias(number))
    marked = docs.withColumn(number, F.monotonically_increasing_id())
    return marked.join(gone, number, "left_anti").drop(number)
