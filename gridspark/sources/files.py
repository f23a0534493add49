"""Landed files as pieces of bytes: whole small files, archive entries, stored payloads.

A *piece* is `(path, seg, first_line, head, utf8, content, issue)`. A small file is one piece. An archive
entry is cut at line ends into pieces of bounded size that share the lines its header is
resolved from (`head`, found by the reader's own rule wherever it stands) and one verdict
on its encoding (`utf8`). An archive or entry that cannot be read is a piece without content
that names the `issue`.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import AREAS
from gridspark.dims import AREA_CODES, lookup
from gridspark.functions.text import is_utf8, is_zip
from gridspark.operators.ledger import next_id, sparse_ids
from gridspark.schemas import TABLES, enforce
from gridspark.sources.archives import PIECE_BYTES, HeadRule, chunk_pieces, content_pieces, entry_pieces
from gridspark.sources.seek import can_seek, first_bytes

WHOLE_FILE_LIMIT = 32 * 1024 * 1024
ARCHIVE_LIMIT = 1024 * 1024 * 1024
SKIPPED_BY_NAME = 1000
ARCHIVE_NAME = ".zip"
TEXT_NAMES = (".csv", ".json", ".txt")
BINARY_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def literal_path(path: str) -> str:
    """A path that readers take as it is, although they expand patterns."""
    return re.sub(r"([\[\]{}*?,\\])", r"\\\1", path)


class Skipped:
    """Landed files that a scan leaves out. A few are left out by name, which prunes the listing, so
    that their bytes are not read; many are joined away, and the engine decides how."""

    def __init__(self, files: DataFrame) -> None:
        self.files = files.select("uri")
        self.names = [row.uri for row in self.files.limit(SKIPPED_BY_NAME + 1).collect()]

    def leave_out(self, scan: DataFrame, columns: list) -> DataFrame:
        """The columns of a file scan, of the files that count."""
        uri = F.col("_metadata.file_path")
        if len(self.names) <= SKIPPED_BY_NAME:
            return (scan.filter(~uri.isin(self.names)) if self.names else scan).select(*columns)
        return scan.select(*columns, uri.alias("uri")).join(self.files, "uri", "left_anti").drop("uri")


def listing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`path`, `length` and `uri` (the path as scans name it) of landed files; no bytes are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.col("_metadata.file_path").alias("uri"))


def scan_files(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT, over: int = 0,
               name: Callable[[Column], Column] | None = None, skipped: Skipped | None = None) -> DataFrame:
    """Files of more than `over` and at most `limit` bytes, with names that pass `name`.

    Both tests are applied to the listing or the scan: the bytes of other files are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    if name is not None:
        files = files.filter(name(F.lower("_metadata.file_name")))
    sized = files.filter((F.col("length") > over) & (F.col("length") <= limit))
    return skipped.leave_out(sized, files.columns) if skipped else sized


def area_of_path(path: Column) -> Column:
    """Area code from the folder or file name that carries the area id."""
    names = "|".join(area_id for area_id, *_ in AREAS)
    found = F.regexp_extract(path, rf"(?:^|[/_=])({names})(?=[/_.]|$)", 1)
    return lookup(AREA_CODES, found)


def period_of_path(path: Column) -> Column:
    """`YYYYMM`, or `YYYY` for yearly files, from the file name."""
    name = F.substring_index(path, "/", -1)
    return F.coalesce(
        F.nullif(F.regexp_extract(name, r"(?:^|\D)(\d{6})(?!\d)", 1), F.lit("")),
        F.nullif(F.regexp_extract(name, r"(?:^|\D)(\d{4})(?!\d)", 1), F.lit("")),
    )


def whole_pieces(files: DataFrame) -> DataFrame:
    """One piece per file."""
    return files.select(
        "path", F.lit(0).cast("bigint").alias("seg"), F.lit(0).cast("bigint").alias("first_line"), F.lit(None).cast("binary").alias("head"),
        is_utf8(F.col("content")).alias("utf8"), "content", F.lit(None).cast("string").alias("issue"),
    )


def has_archive_name(name: Column) -> Column:
    return name.endswith(ARCHIVE_NAME)


def has_text_name(name: Column) -> Column:
    return reduce(lambda left, suffix: left | name.endswith(suffix), TEXT_NAMES, F.lit(False))


def has_other_name(name: Column) -> Column:
    return ~has_text_name(name) & ~has_archive_name(name)


def archive_pieces(files: DataFrame, piece_bytes: int = PIECE_BYTES, rule: HeadRule | None = None) -> DataFrame:
    """CSV entries of archives, or the `issue` of what cannot be read: from `content` where the files
    have it, whole or in chunks, else opened by their `path`, entry by entry."""
    if "part" in files.columns:
        return chunk_pieces(files, piece_bytes, rule)
    if "content" in files.columns:
        return content_pieces(files, piece_bytes, rule)
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return entry_pieces(files, total, piece_bytes, rule)


def named_files(spark: SparkSession, path: str | list[str], name: Callable[[Column], Column], over: int = 0,
                skipped: Skipped | None = None) -> DataFrame:
    """`path` and `length` of the landed files of more than `over` bytes whose name passes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    named = files.filter(name(F.lower("_metadata.file_name")) & (F.col("length") > over))
    return skipped.leave_out(named, ["path", "length"]) if skipped else named.select("path", "length")


def scan_pieces(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT,
                trust_names: bool = True, rule: HeadRule | None = None, skipped: Skipped | None = None) -> DataFrame:
    """Pieces of every plain file up to `limit` and of every archive of any size.

    A file is an archive by its name or, unless it is named like a text, by its first
    bytes. With `trust_names` off, the first bytes of text-named files count too, at the
    price of reading them twice. Plain files over the limit belong to
    `gridspark.sources.lines.scan_large`. Archives are read entry by entry where workers can
    seek in them; on other file systems they are opened as a whole, up to ARCHIVE_LIMIT,
    and the load fails on a larger one instead of leaving it out.
    """
    doubtful = has_other_name if trust_names else lambda name: ~has_archive_name(name)
    zipped = is_zip(F.col("content"))
    plain = scan_files(spark, path, limit, name=doubtful, skipped=skipped).filter(~zipped)
    if trust_names:
        plain = scan_files(spark, path, limit, name=has_text_name, skipped=skipped).unionByName(plain)
    if can_seek(spark, path):
        # Only four bytes of a doubtful file are read, however large it is.
        candidates = named_files(spark, path, doubtful, skipped=skipped)
        sniffed = first_bytes(candidates, 4).filter(is_zip(F.col("start"))).select("path")
        archives = named_files(spark, path, has_archive_name, skipped=skipped).unionByName(candidates.join(sniffed, "path"))
        return whole_pieces(plain).unionByName(archive_pieces(archives, rule=rule))
    fail_on(oversize_archives(spark, path))
    whole = scan_files(spark, path, ARCHIVE_LIMIT, name=has_archive_name, skipped=skipped).unionByName(
        scan_files(spark, path, ARCHIVE_LIMIT, name=doubtful, skipped=skipped).filter(zipped))
    return whole_pieces(plain).unionByName(archive_pieces(whole, rule=rule))


def fail_on(oversize: DataFrame) -> None:
    """Stop before anything is loaded when a file is too large to be opened."""
    found = oversize.limit(10).collect()
    if found:
        raise ValueError(f"{found[0].issue}: " + ", ".join(f"{row.path} ({row.length} bytes)" for row in found))


def oversize_archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Archives too large to open as a whole, for file systems without seeking; only their names are read."""
    return named_files(spark, path, has_archive_name, over=ARCHIVE_LIMIT).withColumn("issue", F.lit("archive_too_large"))


def store_payloads(files: DataFrame, target: str, dir_name: Column, day: Column) -> None:
    """Append raw payloads with an id, their feed, day and arrival time."""
    table = TABLES["downloaded_csv"]
    rows = files.select(
        dir_name.alias("dir_name"), F.date_format(day, "yyyyMMdd").alias("date"), "content",
        F.current_timestamp().alias("downloaded_at"),
    )
    start = next_id(files.sparkSession, target, table)
    # Payloads are large: they are written where they were read.
    enforce(sparse_ids(rows, F.lit(start)), table).write.mode("append").partitionBy(*table.partitions).parquet(target)


def stored_pieces(payloads: DataFrame) -> DataFrame:
    """Stored payloads read back as pieces, named by feed, day and id."""
    named = payloads.filter(F.length("content") > 0).withColumn(
        "path", F.concat_ws("/", "dir_name", "date", F.col("id").cast("string"))
    )
    return whole_pieces(named)
