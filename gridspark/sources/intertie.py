"""Intertie-capacity files: columns are passed through as each file names them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.functions.text import BOM, JAPANESE, cells, decode_fixed, is_zip, lines_of
from gridspark.sources.archives import entry_heads
from gridspark.sources.files import WHOLE_FILE_LIMIT, has_archive_name, named_files
from gridspark.sources.lines import headed_lines, nth_line, nth_line_heads
from gridspark.sources.seek import can_seek, first_bytes, first_lines


def names_of(header: Column) -> Column:
    return F.transform(cells(header), lambda name: F.trim(F.replace(name, F.lit(BOM), F.lit(""))))


def scan(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT) -> DataFrame:
    """Lines below each file's first line, with that line's names as `positions`."""
    return headed_lines(
        spark, path, nth_line(1), lambda head, at: names_of(F.get(head, at.cast("int"))),
        lambda large: nth_line_heads(large, 1), names_of(F.col("header")), limit, JAPANESE,
    )


def layouts(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT) -> list[list[str]]:
    """The different lists of column names, in the order in which sorted files first have them.

    Where workers can seek, only the first line of each file and entry is read; elsewhere all
    lines are.
    """
    if can_seek(spark, path):
        plain = named_files(spark, path, lambda name: ~has_archive_name(name))
        zipped = first_bytes(plain, 4).filter(is_zip(F.col("start"))).select("path")
        archives = named_files(spark, path, has_archive_name).select("path").unionByName(zipped)
        heads = first_lines(plain.join(zipped, "path", "left_anti")).unionByName(entry_heads(archives))
        text = F.get(lines_of(decode_fixed(F.col("head"), JAPANESE)), F.lit(0))
        named = heads.filter(F.length("head") > 0).select("path", names_of(text).alias("positions"))
    else:
        named = scan(spark, path, limit).filter(F.col("positions").isNotNull())
    first = named.groupBy("positions").agg(F.min("path").alias("first"))
    return [row.positions for row in sorted(first.collect(), key=lambda row: row["first"])]


def read(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT) -> DataFrame:
    """All files by column name, whatever order each has them in; every value stays text.

    A file without a column leaves it null, and a repeated name counts at its first cell.
    Columns come in the order in which sorted files first name them; the names, a few per
    layout, are the only thing gathered. Data lines are read once.
    """
    lines = scan(spark, path, limit).filter(F.trim("line") != "")
    names = list(dict.fromkeys(name for layout in layouts(spark, path, limit) for name in layout if name))
    split = lines.select("positions", cells(F.col("line")).alias("cells"))

    def value(name: str) -> Column:
        place = F.nullif(F.array_position("positions", F.lit(name)), F.lit(0))
        return F.get("cells", (place - 1).cast("int")).alias(name)

    return split.select(*[value(name) for name in names])


def rejects(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT) -> DataFrame:
    """`path` and `issue` of archives and entries that could not be read."""
    return scan(spark, path, limit).filter(F.col("file_issue").isNotNull()).select("path", F.col("file_issue").alias("issue"))


def copy(spark: SparkSession, path: str | list[str], target: str) -> None:
    """Read and write as UTF-8 CSV; an empty input leaves an empty output."""
    df = read(spark, path)
    if df.columns:
        df.write.mode("overwrite").option("header", True).csv(target)
    else:
        spark.createDataFrame([], "value string").write.mode("overwrite").text(target)
