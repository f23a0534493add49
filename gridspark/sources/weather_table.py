"""Directories of already standardised weather files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gridspark.functions.numbers import number_or_null
from gridspark.functions.text import blank_na_text, bound, cells, cells_at, na_to_null, settled
from gridspark.operators.dedup import keep_first
from gridspark.schemas import TABLES
from gridspark.sources.files import WHOLE_FILE_LIMIT
from gridspark.sources.lines import alias_positions, file_issue, headed_lines, nth_line, nth_line_heads, spellings_of

TABLE = TABLES["jma_weather"]
ORDER = ["path", "seg", "line_no"]
FILE_PATTERN = "jma_weather_*.csv"


def positions(header: Column) -> Column:
    names = F.transform(cells(header), lambda name: F.trim(name))
    return bound(names, lambda found: alias_positions(found, spellings_of({name: [name] for name in TABLE.columns})))


def scan(spark: SparkSession, directory: str | list[str], limit: int = WHOLE_FILE_LIMIT) -> DataFrame:
    """Lines of a directory's weather files, or of the given files."""
    path = f"{directory.rstrip('/')}/{FILE_PATTERN}" if isinstance(directory, str) else directory
    return headed_lines(
        spark, path, nth_line(1),
        lambda head, at: positions(F.get(head, at.cast("int"))),
        lambda large: nth_line_heads(large, 1), positions(F.col("header")), limit,
    )


def parse(lines: DataFrame) -> DataFrame:
    """Declared columns by name, missing ones null, plus `bad_number` for text in a number column."""
    lines = lines.withColumn("file_issue", file_issue(lines))
    split = lines.filter((F.trim("line") != "") | F.col("file_issue").isNotNull()).withColumn("cells", cells(F.col("line")))
    numbers = [field.name for field in TABLE.schema if field.dataType == T.DoubleType()]
    texts = cells_at(F.col("cells"), F.col("positions"), na_to_null)
    raw = split.select(*ORDER, "line", "file_issue", texts.alias("texts"))
    place = {name: F.get("texts", F.lit(i)) for i, name in enumerate(TABLE.columns)}
    figures = F.array(*[place[name] for name in numbers])
    typed = raw.withColumn("figures", F.transform(figures, number_or_null))
    bad = F.size(F.filter(figures, lambda text: text.isNotNull())) > F.size(
        F.filter("figures", lambda number: number.isNotNull())
    )

    def value(name: str) -> Column:
        if name in numbers:
            return F.get("figures", F.lit(numbers.index(name)))
        return blank_na_text(place[name]) if name == "weather_description" else place[name]

    return settled(typed.select(
        *ORDER, "line", "file_issue", F.coalesce(bad, F.lit(False)).alias("bad_number"), *[value(name).alias(name) for name in TABLE.columns]
    ))


def without_bad_files(parsed: DataFrame) -> DataFrame:
    """Leave out every file that holds text in a number column; the list of such files
    is aggregated per task before it moves."""
    bad = parsed.filter("bad_number").select("path").distinct()
    return parsed.join(bad, "path", "left_anti")


def flagged(parsed: DataFrame) -> DataFrame:
    """Every row with `issue`, null where it loads, for a load that keeps account of files and rejects."""
    bad = parsed.filter("bad_number").select("path").distinct().withColumn("bad_file", F.lit(True))
    issue = F.when(F.col("file_issue").isNotNull(), F.col("file_issue")).when(F.col("bad_file"), "text_in_number_column").when(F.col("primary_key").isNull(), "missing_key")
    return parsed.join(bad, "path", "left").withColumn("issue", issue).drop("bad_file", "bad_number", "file_issue")


def combine(parsed: DataFrame) -> DataFrame:
    """Rows with a key, first by sorted file and line."""
    keyed = parsed.filter(F.col("primary_key").isNotNull())
    return keep_first(keyed, list(TABLE.key), ORDER).select(*TABLE.columns)


def rejects(parsed: DataFrame) -> DataFrame:
    """What a load leaves out, with its reason: unreadable files, every line of a file with text in
    a number column, lines without a key."""
    return flagged(parsed).filter(F.col("issue").isNotNull()).select(*ORDER, "line", "issue")


def load(spark: SparkSession, directory: str, limit: int = WHOLE_FILE_LIMIT) -> DataFrame:
    """The rows that load; `rejects` of the same parsed lines tells the rest."""
    return combine(without_bad_files(parse(scan(spark, directory, limit))))
