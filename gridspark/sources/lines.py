"""Lines with their header resolved, from pieces, from large files or from line tables.

All three routes give `(path, seg, line_no, after_head, positions, line, file_issue)`. `line_no` is the
line's index in its file or archive entry, from 0; `positions` holds, for every wanted column, the cell it
sits in. Small files resolve their header before their lines are exploded, so that
route is narrow from end to end. What cannot be read at all is a row without a line that
names the `file_issue`; parsers pass it on as a reject.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gridspark.functions.text import JAPANESE, cells, decode_fixed, decode_ladder, lines_of
from gridspark.sources.archives import NO_HEADER, HeadRule
from gridspark.sources.files import WHOLE_FILE_LIMIT, Skipped, has_archive_name, has_other_name, scan_pieces

HEADS_TO_BROADCAST = 10_000
HEAD_BYTES = 64 * 1024
ARCHIVE_MARK = "PK\x03\x04"


@dataclass(frozen=True)
class Resolver:
    """Index of the header among a file's lines, and the same rule for archive entries."""

    find: Callable[[Column], Column]
    rule: HeadRule

    def __call__(self, lines: Column) -> Column:
        return self.find(lines)


def spellings_of(aliases: dict[str, list[str]]) -> Column:
    """The alias table as one array literal, a list of spellings per wanted column."""
    return F.array(*[F.array(*[F.lit(s) for s in spellings]) for spellings in aliases.values()])


def alias_positions(names: Column, spellings: Column) -> Column:
    """For each wanted column the 0-based cell of its first spelling that occurs."""

    def place(column: Column) -> Column:
        found = F.transform(column, lambda spelling: F.array_position(names, spelling).cast("int") - 1)
        return F.get(F.filter(found, lambda position: position >= 0), F.lit(0))

    return F.transform(spellings, place)


def header_names(line: Column) -> Column:
    """Header cells, trimmed and in lower case."""
    return F.transform(cells(line), lambda name: F.lower(F.trim(name)))


def nth_line(n: int, skip_blank: bool = True) -> Resolver:
    """Index of the header when it is the n-th line (1-based), blank lines not counted."""

    def find(lines: Column) -> Column:
        if not skip_blank:
            return F.lit(n - 1)
        filled = F.filter(
            F.transform(lines, lambda line, i: F.when(F.trim(line) != "", i)), lambda i: i.isNotNull()
        )
        return F.get(filled, F.lit(n - 1))

    return Resolver(find, HeadRule(nth=n, skip_blank=skip_blank))


def first_cell_line(value: str) -> Resolver:
    """Index of the first line whose first cell is `value`."""

    def find(lines: Column) -> Column:
        firsts = F.transform(lines, lambda line: F.trim(F.translate(F.substring_index(line, ",", 1), '"', "")))
        return F.nullif(F.array_position(firsts, F.lit(value)), F.lit(0)) - 1

    return Resolver(find, HeadRule(first_cell=value))


def piece_lines(pieces: DataFrame, find_head: Resolver, resolve: Callable[[Column, Column], Column],
                charset: str | None = None, labels: dict[str, Column] | None = None) -> DataFrame:
    """Lines of pieces. `resolve` gets the head's lines and the header's index; `labels`
    are columns derived from the path, worked out once per piece."""
    labels = labels or {}

    def text(content: str) -> Column:
        return decode_fixed(F.col(content), charset) if charset else decode_ladder(F.col(content), F.col("utf8"))

    staged = (
        pieces.withColumn("lines", lines_of(text("content")))
        .withColumn("head_lines", F.when(F.col("seg") == 0, F.col("lines")).otherwise(lines_of(text("head"))))
        .withColumn("head_at", find_head(F.col("head_lines")).cast("bigint"))
        .withColumn("positions", resolve(F.col("head_lines"), F.col("head_at")))
        .withColumns(labels)
        .withColumn("file_issue", F.col("issue") if "issue" in pieces.columns else F.lit(None).cast("string"))
        .withColumn("first_line", F.col("first_line") if "first_line" in pieces.columns else F.lit(0).cast("bigint"))
        .select("path", "seg", "head_at", "positions", "file_issue", "first_line", *labels, F.posexplode_outer("lines").alias("pos", "line"))
        .withColumn("line_no", F.coalesce("first_line", F.lit(0)) + F.coalesce("pos", F.lit(0)))
    )
    after = F.when(F.col("seg") == 0, F.col("line_no") - F.col("head_at"))
    below = (F.col("seg") > 0) | F.col("head_at").isNull() | (F.col("after_head") > 0)
    return (
        staged.withColumn("after_head", after)
        .filter(below | F.col("file_issue").isNotNull())
        .select("path", "seg", "line_no", "after_head", "positions", "line", "file_issue", *labels)
    )


def file_issue(lines: DataFrame) -> Column:
    """Why a row stands for a file or entry that could not be read; null for lines."""
    return F.col("file_issue") if "file_issue" in lines.columns else F.lit(None).cast("string")


def with_headless(lines: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """Lines that have their header, and one row per file that has none.

    Archive entries come with their own verdict. `heads` names the files that have a header where
    they are read in splits; files read whole show it on their first line.
    """
    filled = F.col("positions").isNotNull() | F.col("file_issue").isNotNull()
    if heads is None:
        first = F.col("positions").isNull() & (F.col("seg") == 0) & (F.col("line_no") == 0) & ~F.col("path").contains("!")
        bare = lines.filter(filled | first).withColumn("file_issue", F.when(first & F.col("file_issue").isNull(), NO_HEADER).otherwise(F.col("file_issue")))
        return bare.withColumn("line", F.when(F.col("file_issue").isNull(), F.col("line")))
    headless = lines.filter(F.col("positions").isNull()).select("path").distinct()
    empty = {field.name: F.lit(None).cast(field.dataType).alias(field.name) for field in lines.schema}
    named = empty | {"path": F.col("path"), "seg": F.lit(0).cast("bigint").alias("seg"), "line_no": F.lit(0).cast("bigint").alias("line_no"),
                     "file_issue": F.lit(NO_HEADER).alias("file_issue")}
    missing = headless.join(heads.select("path"), "path", "left_anti")
    return lines.filter(filled).unionByName(missing.select(*named.values()))


def scan_large(spark: SparkSession, path: str | list[str], over: int = WHOLE_FILE_LIMIT, skipped: Skipped | None = None) -> DataFrame:
    """Undecoded lines of files over a size, read by many tasks per file.

    `seg` is the byte at which a split starts, and `line_id` grows with the lines of a split one by
    one; `decode_lines` makes line numbers of both. The size test prunes whole files.
    No line end can be part of a character in UTF-8 or the Japanese code page, so
    cutting lines before decoding is safe. Archives go by name, and where the name says
    nothing by their first bytes; `scan_pieces` opens both.
    """
    scan = spark.read.option("recursiveFileLookup", "true").text(path)
    name, place = F.lower("_metadata.file_name"), F.col("_metadata.file_path").alias("path")
    large = scan.filter((F.col("_metadata.file_size") > over) & ~has_archive_name(name))
    starts = large.filter(has_other_name(name) & (F.col("_metadata.file_block_start") == 0))
    archives = starts.filter(F.col("value").startswith(ARCHIVE_MARK)).select(place).distinct()
    columns = [
        place,
        F.col("_metadata.file_block_start").alias("seg"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").cast("binary").alias("raw"),
    ]
    return (skipped.leave_out(large, columns) if skipped else large.select(*columns)).join(archives, "path", "left_anti")


def decode_lines(raw: DataFrame, charset: str | None = None, broadcast: bool = False) -> DataFrame:
    """Number lines by what the splits before hold, and decode them by a verdict reached per file.

    Both come from one aggregate per split, combined before it moves; sums over a file's splits
    then tell where each one's numbers begin. `broadcast` as for `attach_heads`: with few splits
    the lines themselves never move.
    """
    valid = F.lit(True) if charset else F.is_valid_utf8(F.col("raw").cast("string"))
    counted = raw.groupBy("path", "seg").agg(
        F.count(F.lit(1)).alias("lines"), F.min("line_id").alias("first_id"), F.bool_and(valid).alias("valid"))
    before = Window.partitionBy("path").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.select(
        "path", "seg", "first_id", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("before"),
        F.bool_and("valid").over(Window.partitionBy("path")).alias("utf8"))
    joined = raw.join(F.broadcast(splits) if broadcast else splits, ["path", "seg"])
    text = decode_fixed(F.col("raw"), charset) if charset else F.when(F.col("utf8"), F.col("raw").cast("string")).otherwise(F.decode("raw", JAPANESE))
    return joined.select("path", "seg", (F.col("before") + F.col("line_id") - F.col("first_id")).alias("line_no"), text.alias("line"))


def nth_line_heads(lines: DataFrame, n: int, skip_blank: bool = True) -> DataFrame:
    """Per file the n-th line as `header`, with all lines up to it as `head`.

    Only splits that start within the first HEAD_BYTES are looked at, which leaves the
    first one unless splits are tiny. The rank is limited per task before the shuffle,
    so n lines per file are gathered.
    """
    order = Window.partitionBy("path").orderBy("seg", "line_no")
    counted = (F.trim("line") != "") if skip_blank else F.lit(True)
    first = (
        lines.filter((F.col("seg") < HEAD_BYTES) & counted)
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= n)
    )
    gathered = first.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("n", "seg", "line_no", "line"))).alias("h"))
    last = F.get("h", F.lit(n - 1))
    return gathered.filter(F.size("h") == n).select(
        "path", last["seg"].alias("head_seg"), last["line_no"].alias("head_at"), last["line"].alias("header"),
        F.transform("h", lambda entry: entry["line"]).alias("head"),
    )


def first_cell_heads(lines: DataFrame, value: str) -> DataFrame:
    """Per file the first line whose first cell is `value`, by partial aggregation."""
    first_cell = F.trim(F.translate(F.substring_index("line", ",", 1), '"', ""))
    return (
        lines.filter(first_cell == value)
        .groupBy("path")
        .agg(F.min_by(F.struct("seg", "line_no", "line"), F.struct("seg", "line_no")).alias("h"))
        .select("path", F.col("h.seg").alias("head_seg"), F.col("h.line_no").alias("head_at"),
                F.col("h.line").alias("header"))
    )


def attach_heads(lines: DataFrame, heads: DataFrame, positions: Column, broadcast: bool = False) -> DataFrame:
    """Give every line its file's positions and drop the lines up to the header.

    `heads` has one row per file. Pass `broadcast` only when the number of files is
    known to be small (`has_few_files`); otherwise the engine decides.
    """
    resolved = heads.withColumn("positions", positions)
    if "head_seg" not in heads.columns:
        resolved = resolved.withColumn("head_seg", F.lit(0).cast("bigint"))
    resolved = resolved.select("path", "head_seg", "head_at", "positions")
    joined = lines.join(F.broadcast(resolved) if broadcast else resolved, "path", "left")
    after = F.when(F.col("seg") == F.col("head_seg"), F.col("line_no") - F.col("head_at"))
    below = (F.col("seg") > F.col("head_seg")) | F.col("head_at").isNull() | (F.col("after_head") > 0)
    return joined.withColumn("after_head", after).filter(below).select(
        "path", "seg", "line_no", "after_head", "positions", "line"
    )


def has_few_files(spark: SparkSession, path: str | list[str], over: int) -> bool:
    """Whether one row per large file, and per split of one, is small enough to broadcast: their
    number, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # Splits are at least as long as the cost of opening a file.
    least = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.openCostInBytes").removesuffix("b") + "b")
    splits = files.filter(F.col("length") > over).agg(F.sum(F.ceil(F.col("length") / max(1, least)) + 1)).first()[0]
    return (splits or 0) <= HEADS_TO_BROADCAST


def headed_lines(spark: SparkSession, path: str | list[str], find_head: Resolver,
                 resolve: Callable[[Column, Column], Column], large_heads: Callable[[DataFrame], DataFrame],
                 large_positions: Column, limit: int = WHOLE_FILE_LIMIT, charset: str | None = None,
                 labels: dict[str, Column] | None = None, must_have_head: bool = False,
                 skipped: Skipped | None = None) -> DataFrame:
    """Lines of all landed files: small ones and archives as pieces, large ones as splits.

    With `must_have_head`, lines without a header are left out and their file is a reject."""
    small = piece_lines(scan_pieces(spark, path, limit, rule=find_head.rule, skipped=skipped), find_head, resolve, charset, labels)
    scan = scan_large(spark, path, limit, skipped)
    few = has_few_files(spark, path, limit)
    large = decode_lines(scan, charset, broadcast=few)
    heads = large_heads(large)
    attached = attach_heads(large, heads, large_positions, broadcast=few).withColumn("file_issue", F.lit(None).cast("string"))
    if must_have_head:
        small, attached = with_headless(small), with_headless(attached, heads)
    return small.unionByName(attached.withColumns(labels or {}))
