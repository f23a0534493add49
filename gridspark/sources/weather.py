"""Weather files: hourly or daily observations under a two-line header."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import DAILY_SPELLINGS, PUNCTUATION_SPELLINGS, QUALITY_MARKS, SECONDARY_MARKS, \
    UNIT_SPELLINGS, WEATHER_ALIASES
from gridspark.functions.dates import observed_at
from gridspark.functions.numbers import number_or_null
from gridspark.functions.text import JAPANESE, bound, cell, cells, cells_at, joined_key, settled
from gridspark.functions.wind import bearing_cos, bearing_sin
from gridspark.schemas import TABLES
from gridspark.sources.files import WHOLE_FILE_LIMIT
from gridspark.sources.lines import alias_positions, file_issue, headed_lines, nth_line, nth_line_heads, spellings_of

TABLE = TABLES["jma_weather"]
ORDER = ["path", "seg", "line_no"]
UPPER_HEADER_LINE = 4
LOWER_HEADER_LINE = 5
MEASURES = ["temperature", "sunshine_duration", "global_solar_radiation", "wind_speed", "wind_direction_sin",
            "wind_direction_cos", "weather_description", "snowfall_depth", "precipitation"]


def _respell(name: Column, spellings: list[tuple[str, str]]) -> Column:
    return reduce(lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), spellings, name)


def _holds(text: Column, marks: list[str]) -> Column:
    return reduce(lambda left, mark: left | text.contains(mark), marks[1:], text.contains(marks[0]))


def column_name(upper: Column, lower: Column, interval: str) -> Column:
    """Name of a column from its two header cells; empty when both are."""
    if interval == "daily":
        full = F.concat_ws("_", F.nullif(upper, F.lit("")), F.nullif(lower, F.lit("")))
        return F.lower(_respell(full, UNIT_SPELLINGS[:6] + UNIT_SPELLINGS[8:10] + DAILY_SPELLINGS + PUNCTUATION_SPELLINGS))
    measure = F.lower(_respell(upper, UNIT_SPELLINGS + PUNCTUATION_SPELLINGS))
    detail = F.lower(lower)
    speed = upper.contains("風速") | measure.contains("wind_speed")
    bearing = lower.contains("風向") | detail.contains("wind_direction")
    joined = F.concat_ws("_", F.nullif(measure, F.lit("")), F.nullif(F.translate(detail, " ", "_"), F.lit("")))
    return (
        F.when(speed & bearing, "wind_direction_intermediate")
        .when(~_holds(detail, SECONDARY_MARKS) & (measure != ""), F.concat(measure, F.lit("_main")))
        .otherwise(joined)
    )


def positions(upper_line: Column, lower_line: Column, interval: str) -> Column:
    """Cells of the measures; among equal names the first one counts."""
    upper = F.transform(cells(upper_line), lambda name: F.trim(name))
    lower = F.transform(cells(lower_line), lambda name: F.trim(name))
    names = F.zip_with(
        upper, lower,
        lambda u, d: bound(
            F.struct(F.coalesce(u, F.lit("")).alias("u"), F.coalesce(d, F.lit("")).alias("d")),
            lambda pair: column_name(pair["u"], pair["d"], interval),
        ),
    )
    return bound(names, lambda found: alias_positions(found, spellings_of(WEATHER_ALIASES)))


def scan(spark: SparkSession, path: str | list[str], interval: str, limit: int = WHOLE_FILE_LIMIT) -> DataFrame:
    """Lines of landed files; the station number is part of the file name."""

    def place(head: Column) -> Column:
        return positions(F.get(head, F.lit(UPPER_HEADER_LINE - 1)), F.get(head, F.lit(LOWER_HEADER_LINE - 1)), interval)

    return headed_lines(
        spark, path, nth_line(LOWER_HEADER_LINE, skip_blank=False), lambda head, at: place(head),
        lambda large: nth_line_heads(large, LOWER_HEADER_LINE, skip_blank=False), place(F.col("head")), limit, JAPANESE,
        {"station_id": station_of_path(F.col("path"))},
    )


def station_of_path(path: Column) -> Column:
    return F.regexp_extract(F.substring_index(path, "/", -1), r"(?:^|\D)(\d{5})(?!\d)", 1)


def parse(lines: DataFrame, interval: str) -> DataFrame:
    """Observations with `issue`. Needs `station_id, path, seg, line_no, after_head, positions, line`."""
    lines = lines.withColumn("file_issue", file_issue(lines))
    split = lines.filter(F.col("line").isNotNull() | F.col("file_issue").isNotNull()).withColumn("cells", cells(F.col("line")))
    names = list(WEATHER_ALIASES)
    numeric = [name for name in names if name not in ("weather_description", "wind_direction")]
    place = {name: F.get("positions", F.lit(i)) for i, name in enumerate(names)}
    read = cells_at(F.col("cells"), F.array(*[place[name] for name in numeric]), number_or_null)
    typed = split.select(
        "station_id", *ORDER, "after_head", "line", "file_issue", F.trim(F.get("cells", F.lit(0))).alias("first_cell"),
        cell(F.col("cells"), place["weather_description"]).alias("weather_description"),
        cell(F.col("cells"), place["wind_direction"]).alias("bearing"),
        place["wind_direction"].isNotNull().alias("has_bearing"), read.alias("numbers"),
    ).withColumn("observed", observed_at(F.col("first_cell"), interval)).withColumns(
        {name: F.get("numbers", F.lit(i)) for i, name in enumerate(numeric)}
    )
    quality = (F.col("after_head") == 1) & ((F.col("first_cell") == "") | _holds(F.col("first_cell"), QUALITY_MARKS))
    issue = F.when(F.col("file_issue").isNotNull(), F.col("file_issue")).when(quality, "quality_row").when(F.col("observed").isNull(), "invalid_datetime")
    speed = F.col("wind_speed")
    clock = F.date_format("observed", "HH:mm") if interval == "hourly" else F.lit("00:00")
    return settled(typed.select(
        joined_key(F.col("station_id"), F.date_format("observed", "yyyyMMddHHmm")).alias("primary_key"), "station_id",
        F.date_format("observed", "yyyy-MM-dd").alias("date"), clock.alias("time"), "temperature",
        "sunshine_duration", "global_solar_radiation", "wind_speed",
        F.when(F.col("has_bearing"), bearing_sin(F.col("bearing"), speed)).alias("wind_direction_sin"),
        F.when(F.col("has_bearing"), bearing_cos(F.col("bearing"), speed)).alias("wind_direction_cos"),
        "weather_description", "snowfall_depth", "precipitation", F.to_date("observed").alias("dt"), *ORDER, "line",
        issue.alias("issue"),
    ))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("issue").isNull()).drop("line", "issue")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("issue").isNotNull()).select("station_id", *ORDER, "line", "issue")
