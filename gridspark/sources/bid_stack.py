"""Bid-curve files: price steps nested per day, slot and area.

The nested row is the published shape, but its array grows with the number of price
steps of one key. `segments` therefore keeps the steps in arrays of bounded length;
`stacks` joins a key's segments in order, and the reports work on steps directly. The
segment table stores them as they are: a key of any number of steps is loaded, replaced
and read without ever being one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import BID_FEEDS
from gridspark.functions.numbers import nullable_int
from gridspark.functions.text import cells, decode_ladder, joined_key, lines_of, settled
from gridspark.operators.snapshots import Commit, SnapshotTable
from gridspark.sources.files import WHOLE_FILE_LIMIT, scan_pieces
from gridspark.sources.lines import decode_lines, file_issue, has_few_files, scan_large

KEY = ["id", "date", "slot", "area_code"]
ORDER = ["path", "seg", "line_no"]
POINT = ["price", "sell_qty", "buy_qty"]
SEGMENT_LINES = 4096


def scan(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT) -> DataFrame:
    small = piece_steps(scan_pieces(spark, path, limit))
    large = scan_large(spark, path, limit)
    split = decode_lines(large, broadcast=has_few_files(spark, path, limit)).withColumn("file_issue", F.lit(None).cast("string"))
    return small.unionByName(split)


def piece_steps(pieces: DataFrame) -> DataFrame:
    """Lines of pieces; these files have no header to resolve."""
    text = decode_ladder(F.col("content"), F.col("utf8"))
    lines = pieces.select("path", "seg", "first_line", F.col("issue").alias("file_issue"), F.posexplode_outer(lines_of(text)).alias("pos", "line"))
    return lines.select("path", "seg", (F.coalesce("first_line", F.lit(0)) + F.coalesce("pos", F.lit(0))).alias("line_no"), "line", "file_issue")


def parse(lines: DataFrame) -> DataFrame:
    """Every line as a price step with `issue`; headers fail the number test like any other text."""
    lines = lines.withColumn("file_issue", file_issue(lines))
    split = lines.filter(F.col("line").isNotNull() | F.col("file_issue").isNotNull()).withColumn("cells", cells(F.col("line")))
    steps = split.select(
        *[F.col(name) for name in lines.columns if name != "line"], "line",
        F.size("cells").alias("width"), F.get("cells", F.lit(0)).alias("date"),
        nullable_int(F.get("cells", F.lit(1))).alias("slot"),
        *[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(POINT, start=2)],
        nullable_int(F.get("cells", F.lit(5))).alias("area_code"),
    )
    issue = (
        F.when(F.col("file_issue").isNotNull(), F.col("file_issue"))
        .when(F.col("width") < 6, "too_few_cells")
        .when(F.col("slot").isNull(), "invalid_slot")
        .when(F.col("area_code").isNull(), "invalid_area")
    )
    return settled(steps.withColumn("id", key_of_steps()).withColumn("issue", issue).drop("width", "file_issue"))


def key_of_steps() -> Column:
    return joined_key(F.col("date"), F.col("slot").cast("string"), F.col("area_code").cast("string"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("issue").isNull()).drop("line", "issue")


def file_segment() -> Column:
    """A segment number for steps with file positions: a file holds at most
    SEGMENT_LINES lines per segment, whatever their keys."""
    return F.floor(F.col("line_no") / SEGMENT_LINES)


def segments(steps: DataFrame, order: list[str], segment: list[Column]) -> DataFrame:
    """Steps of a key in arrays, one per `segment`; segments follow the order of the steps.

    `segment` lists columns that are prefixes of, or coarser than, `order`.
    """
    names = [f"segment{i}" for i in range(len(segment))]
    marked = steps.withColumns(dict(zip(names, segment)))
    gathered = marked.groupBy(*KEY, *names).agg(
        F.sort_array(F.collect_list(F.struct(*order, F.struct(*POINT).alias("point")))).alias("rows")
    )
    return gathered.select(
        *KEY, F.struct(*names).alias("segment"), F.transform("rows", lambda row: row["point"]).alias("bid")
    )


def stacks(parts: DataFrame, more: list[str] | None = None, of_id: DataFrame | None = None) -> DataFrame:
    """One row per key with all its steps in order, and columns `more` from a table by id."""
    ordered = F.sort_array(F.collect_list(F.struct("segment", "bid")))
    gathered = parts.groupBy(*KEY).agg(ordered.alias("parts"))
    joined = gathered if of_id is None else gathered.join(of_id, "id")
    return joined.select(*KEY, *(more or []), F.flatten(F.transform("parts", lambda part: part["bid"])).alias("bid"))


def from_files(parsed: DataFrame) -> DataFrame:
    """Stacks in file order."""
    by_file = [F.col("path"), F.col("seg"), file_segment()]
    return stacks(segments(accepted(parsed), ORDER, by_file))


def feed_of(path: Column) -> Column:
    """Place of a path's feed among the feeds; a later one replaces an earlier one's bids."""
    named = F.array(*[F.when(path.contains(feed), F.lit(i)) for i, feed in enumerate(BID_FEEDS)])
    return F.coalesce(F.array_max(named), F.lit(-1))


def table_rows(parsed: DataFrame) -> DataFrame:
    """Rows of the bid table with their `feed`, one per id: the steps of its last feed, in file order.

    For `merge.upsert_into` with the order `feed` and the column `bid`, so that both feeds
    share one id space and loading files again gives the same rows.
    """
    steps = accepted(parsed).withColumn("feed", feed_of(F.col("path")))
    last = steps.groupBy("id").agg(F.max("feed").alias("feed"))
    current = steps.join(last, ["id", "feed"])
    return stacks(segments(current, ORDER, [F.col("path"), F.col("seg"), file_segment()]), ["feed"], last)


def segment_rows(parsed: DataFrame) -> DataFrame:
    """Rows of the segment table: bounded arrays of a key's steps, with the feed they come from."""
    place = [*KEY[1:], "path", "seg", "part"]
    # Lines move as narrow as they are, and without arrays of one: what follows from the key is added above the shuffle.
    moved = accepted(parsed).select(*place[:-1], "line_no", *POINT).repartition(*place[:-1], file_segment())
    steps = moved.select("*", file_segment().alias("part"))
    gathered = steps.groupBy(*place).agg(F.sort_array(F.collect_list(F.struct("line_no", *POINT))).alias("rows"))
    points = F.transform("rows", lambda row: F.struct(*[row[name].alias(name) for name in POINT]))
    return gathered.select(key_of_steps().alias("id"), *KEY[1:], feed_of(F.col("path")).alias("feed"), "path", "seg", "part", points.alias("bid"))


def store_segments(table: SnapshotTable, parsed: DataFrame) -> Commit:
    """Put files into a table of segments: an id of a later or the same feed replaces the stored one
    whole, in one commit, however many segments it has."""
    return table.replace_groups(segment_rows(parsed), ["id"], "feed")


def stored_steps(stored: DataFrame) -> DataFrame:
    """Every stored step with its place in its key's stack: `seg`, `part` and `at`."""
    return stored.select(*KEY, "path", "seg", "part", F.posexplode("bid").alias("at", "point")).select(
        *KEY, "path", "seg", "part", "at", *[F.col(f"point.{name}").alias(name) for name in POINT])


def in_order(stored: DataFrame, id: str) -> DataFrame:
    """The steps of one stack in their order, by a range sort of its segments: no array holds them all."""
    return stored_steps(stored.filter(F.col("id") == id)).orderBy("path", "seg", "part", "at")


def first_and_size_of_segments(stored: DataFrame) -> DataFrame:
    """First step and number of steps of every stored stack, by partial aggregation of segments."""
    # Rows are sorted for this, so they leave their arrays behind.
    narrow = stored.select(*KEY, "path", "seg", "part", F.get("bid", F.lit(0)).alias("step"), F.size("bid").alias("size"))
    return narrow.groupBy(*KEY).agg(F.min_by("step", F.struct("path", "seg", "part")).alias("f"), F.sum("size").alias("points")).select(
        *KEY, *[F.col(f"f.{name}").alias(f"first_{name}") for name in POINT], "points")


def bid_json(bid: Column) -> Column:
    return F.to_json(bid, {"ignoreNullFields": "false"})


def bids_from_json(text: Column) -> Column:
    return F.from_json(text, "array<struct<price:string,sell_qty:string,buy_qty:string>>")


def first_and_size(stacked: DataFrame) -> DataFrame:
    """First step and number of steps of stored stacks."""
    first = F.get("bid", F.lit(0))
    return stacked.select(*KEY, *[first[name].alias(f"first_{name}") for name in POINT], F.size("bid").alias("points"))


def first_and_size_of_steps(steps: DataFrame, order: list[str]) -> DataFrame:
    """The same from the steps, by partial aggregation: no array is built."""
    first = F.min_by(F.struct(*POINT), F.struct(*order, *POINT))
    return steps.groupBy(*KEY).agg(first.alias("f"), F.count(F.lit(1)).cast("int").alias("points")).select(
        *KEY, *[F.col(f"f.{name}").alias(f"first_{name}") for name in POINT], "points"
    )
