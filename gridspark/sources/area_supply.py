"""Area demand and generation files: half-hour rows per area."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import ARCHIVE_ALIASES, ARCHIVE_AREA, COMPACT_DATE_AREA, SUPPLY_ALIASES, SUPPLY_MEASURES
from gridspark.functions.dates import clamp_future_year, compact_date, compact_text, repair_clock, slashed_date, \
    slot_of_clock, slot_of_stored_clock
from gridspark.functions.numbers import clean_number, fold_digits
from gridspark.functions.text import bound, cell, cells, cells_at, joined_key, settled
from gridspark.operators.coverage import archive_years
from gridspark.operators.dedup import first_usable, keep_first
from gridspark.schemas import require_columns
from gridspark.sources.files import WHOLE_FILE_LIMIT, Skipped, area_of_path, listing, period_of_path
from gridspark.sources.lines import alias_positions, file_issue, headed_lines, header_names, nth_line, \
    nth_line_heads, spellings_of

HEADER_LINE = 2
ORDER = ["path", "seg", "line_no"]
KEPT_ISSUES = ["slot_out_of_range"]
CANONICAL = ["area_code", "master_key", "date", "slot", *SUPPLY_MEASURES]


def positions(header: Column, area_code: Column) -> Column:
    """Cells of the canonical columns; one area's archive has its own, shorter alias list."""
    spellings = F.when(area_code == ARCHIVE_AREA, spellings_of(ARCHIVE_ALIASES)).otherwise(spellings_of(SUPPLY_ALIASES))
    return bound(header_names(header), lambda names: alias_positions(names, spellings))


def scan(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT,
         current_year: int | None = None, every_version: bool = False) -> DataFrame:
    """Lines of landed files; the area id is part of the path.

    Of several versions of one area and month only the one to use is read (`choose_versions`),
    decided from the listing; files outside that scheme are read too. `current_year` is this
    year's unless given; `every_version` reads all.
    """
    skipped = None
    if not every_version:
        files = listing(spark, path)
        chosen = chosen_files(files, current_year or date.today().year)
        skipped = Skipped(files.join(chosen, "path", "left_anti"))
    area = area_of_path(F.col("path"))
    return headed_lines(
        spark, path, nth_line(HEADER_LINE),
        lambda head, at: positions(F.get(head, at.cast("int")), area),
        lambda large: nth_line_heads(large, HEADER_LINE), positions(F.col("header"), area), limit,
        labels={"area_code": area}, skipped=skipped,
    )


def choose_versions(files: DataFrame, current_year: int) -> DataFrame:
    """The file to use where several candidates have landed for one area and period.

    Monthly files carry a version in their name; the lowest non-empty one counts. Every
    non-empty yearly archive up to the current year counts. Needs `path` and `length`;
    contents are not read.
    """
    path = F.col("path")
    named = files.select(
        "path", "length", area_of_path(path).alias("area_code"), period_of_path(path).alias("period"),
        F.regexp_extract(path, r"_(\d{2})\.csv$", 1).try_cast("int").alias("version"),
    )
    monthly = named.filter(F.length("period") == 6)
    best = first_usable(monthly, ["area_code", "period"], [F.coalesce("version", F.lit(0)), "path"], F.col("length") > 0)
    yearly = named.filter((F.length("period") == 4) & (F.col("period").cast("int") <= current_year) & (F.col("length") > 0))
    return best.select("area_code", "period", "path").unionByName(yearly.select("area_code", "period", "path"))


def file_units(files: DataFrame) -> DataFrame:
    """Files with their `area_code`, `period`, `version` and `unit`: the area and month that versions
    of a monthly file compete for, or the file itself where nothing competes."""
    path = F.col("path")
    area, period = area_of_path(path), period_of_path(path)
    monthly = area.isNotNull() & (F.length(period) == 6)
    return files.select(
        "path", area.alias("area_code"), period.alias("period"),
        F.coalesce(F.regexp_extract(path, r"_(\d{2})\.csv$", 1).try_cast("int"), F.lit(0)).alias("version"),
        F.coalesce(monthly, F.lit(False)).alias("monthly"), F.when(monthly, F.concat_ws("/", area, period)).otherwise(path).alias("unit"),
    )


def chosen_files(files: DataFrame, current_year: int) -> DataFrame:
    """`path` of every landed file to read: the chosen versions, and files that name no area or period."""
    path = F.col("path")
    named = area_of_path(path).isNotNull() & period_of_path(path).isNotNull()
    outside = files.filter(~named & (F.col("length") > 0)).select("path")
    return choose_versions(files.filter(named), current_year).select("path").unionByName(outside)


def archive_for_year(files: DataFrame, target_year: int, current_year: int) -> DataFrame:
    """The yearly archive that answers for a year: the first landed, non-empty candidate."""
    years = archive_years(target_year, current_year)
    rank = F.array_position(F.array(*[F.lit(str(year)) for year in years]), period_of_path(F.col("path")))
    named = files.select("path", "length", area_of_path(F.col("path")).alias("area_code"), rank.alias("rank"))
    usable = (F.col("length") > 0) & (F.col("rank") > 0)
    return first_usable(named, ["area_code"], ["rank", "path"], usable).select("area_code", "path")


def parse(lines: DataFrame) -> DataFrame:
    """Every non-blank line as a canonical row with `issue`; null where all is well.

    Needs `area_code, path, seg, line_no, positions, line`.
    """
    names = list(SUPPLY_ALIASES)
    date_at, time_at = (F.get("positions", F.lit(names.index(name))) for name in ("date", "slot"))
    first = names.index(SUPPLY_MEASURES[0])
    lines = lines.withColumn("file_issue", file_issue(lines))
    split = lines.filter((F.trim("line") != "") | F.col("file_issue").isNotNull()).withColumn("cells", cells(fold_digits(F.col("line"))))
    compact = F.col("area_code") == COMPACT_DATE_AREA
    measures = F.slice("positions", first + 1, len(SUPPLY_MEASURES))
    raw = split.select(
        "area_code", *ORDER, "line", "file_issue", cell(F.col("cells"), date_at).alias("raw_date"),
        cell(F.col("cells"), time_at).alias("raw_time"),
        (date_at.isNull() | time_at.isNull()).alias("no_key_column"),
        cells_at(F.col("cells"), measures, clean_number).alias("numbers"),
    )
    keyed = raw.withColumn(
        "dt", F.when(compact, compact_date(F.col("raw_date"))).otherwise(slashed_date(F.col("raw_date")))
    ).withColumn("slot", slot_of_clock(F.when(compact, repair_clock(F.col("raw_time"))).otherwise(F.col("raw_time"))))
    issue = (
        F.when(F.col("file_issue").isNotNull(), F.col("file_issue"))
        .when(F.col("no_key_column"), "missing_required_column")
        .when(F.upper("raw_time").contains("TIME"), "repeated_header")
        .when(F.col("dt").isNull(), "invalid_date")
        .when(~F.col("slot").between(1, 48), "slot_out_of_range")
    )
    text = compact_text(F.col("dt"))
    return settled(
        keyed.withColumn("date", text)
        .withColumn("master_key", joined_key(text, F.col("slot").cast("string")))
        .withColumn("issue", issue)
        .select(
            "area_code", "master_key", "date", "slot",
            *[F.coalesce(F.get("numbers", F.lit(i)), F.lit(0.0)).alias(name) for i, name in enumerate(SUPPLY_MEASURES)],
            "dt", *ORDER, "line", "issue",
        )
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Rows that load. A slot outside 1 to 48 follows the formula and is only flagged."""
    return parsed.filter(F.col("issue").isNull() | F.col("issue").isin(KEPT_ISSUES))


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("issue").isNotNull()).select("area_code", *ORDER, "line", "issue")


def canonical(parsed: DataFrame) -> DataFrame:
    """Accepted rows, the first one per area and key in file order."""
    rows = accepted(parsed).select(*CANONICAL, "dt", *ORDER)
    return keep_first(rows, ["area_code", "master_key"], ORDER).select(*CANONICAL, "dt")


def load(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT,
         current_year: int | None = None, every_version: bool = False) -> DataFrame:
    return canonical(parse(scan(spark, path, limit, current_year, every_version)))


def clean_batch(batch: DataFrame, year: int) -> DataFrame:
    """A second cleaning for rows that arrive already canonical but with text slots and dates.

    Drops repeated headers and unreadable slots or dates, and moves later years into `year`.
    """
    require_columns(batch, ["master_key", "date", "slot", "area_demand"])
    text = F.col("slot").cast("string")
    day = F.coalesce(
        slashed_date(F.col("date").cast("string")), compact_date(F.translate(F.col("date").cast("string"), "-", ""))
    )
    return (
        batch.filter(F.col("master_key").isNotNull() & ~F.coalesce(text.contains("TIME"), F.lit(False)))
        .withColumn("slot", slot_of_stored_clock(text))
        .withColumn("dt", clamp_future_year(day, year))
        .filter(F.col("slot").isNotNull() & F.col("dt").isNotNull())
        .withColumn("date", compact_text(F.col("dt")))
    )
