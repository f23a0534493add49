"""Plant-operation files: half-hour energy columns that differ from file to file."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import PLANT_AREA_HINTS, PLANT_ENERGY_MARK, PLANT_HEADERS, PLANT_TYPE_HINTS
from gridspark.functions.dates import slashed_date
from gridspark.functions.numbers import number_or_null
from gridspark.functions.text import bound, cell, cells
from gridspark.sources.files import WHOLE_FILE_LIMIT
from gridspark.sources.lines import file_issue, headed_lines, nth_line, nth_line_heads

ORDER = ["path", "seg", "line_no"]


HINTS = {"plant_type": PLANT_TYPE_HINTS, "area": PLANT_AREA_HINTS}


def hinted_cells(numbered: Column, hints: list[str]) -> Column:
    """The header cells whose name contains one of the hints."""
    return F.filter(numbered, lambda entry: reduce(or_, [entry["name"].contains(hint) for hint in hints]))


def positions(header: Column) -> Column:
    """Cells of the six known columns, then the energy columns' labels and cells."""

    def of(names: Column) -> Column:
        known = [(F.nullif(F.array_position(names, F.lit(h)), F.lit(0)) - 1).cast("int") for h in PLANT_HEADERS]
        numbered = F.transform(names, lambda name, i: F.struct(name.alias("name"), i.alias("at")))
        energy = F.filter(numbered, lambda entry: entry["name"].contains(PLANT_ENERGY_MARK))
        label = lambda entry: F.replace(entry["name"], F.lit(PLANT_ENERGY_MARK), F.lit(""))
        labelled = F.transform(energy, lambda entry: F.struct(label(entry).alias("label"), entry["at"].alias("at")))
        labels = F.transform(energy, label)
        # A label that a header repeats counts once, at its first cell.
        first = F.filter(labelled, lambda entry, i: F.array_position(labels, entry["label"]) == i + 1)
        hinted = [F.get(hinted_cells(numbered, hints)["at"], F.lit(0)) for hints in HINTS.values()]
        return F.struct(F.array(*known).alias("known"), first.alias("energy"), F.array(*hinted).alias("hinted"))

    return bound(F.transform(cells(header), lambda name: F.trim(name)), of)


def scan(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT) -> DataFrame:
    return headed_lines(
        spark, path, nth_line(1), lambda head, at: positions(F.get(head, at.cast("int"))),
        lambda large: nth_line_heads(large, 1), positions(F.col("header")), limit,
    )


def parse(lines: DataFrame, processed_on: date) -> DataFrame:
    """Known columns by name, energy columns as a map from end label to kWh."""
    lines = lines.withColumn("file_issue", file_issue(lines))
    split = lines.filter((F.trim("line") != "") | F.col("file_issue").isNotNull()).withColumn("cells", cells(F.col("line")))
    known = {
        name: cell(F.col("cells"), F.get(F.col("positions.known"), F.lit(i)))
        for i, name in enumerate(PLANT_HEADERS.values())
    }
    energy = F.map_from_entries(F.transform(
        F.col("positions.energy"),
        lambda entry: F.struct(entry["label"], number_or_null(F.trim(F.get(F.col("cells"), entry["at"])))),
    ))
    day = slashed_date(known["date"])
    return split.select(
        *ORDER, *[column.alias(name) for name, column in known.items() if name != "date"],
        day.alias("date"), energy.alias("kwh"), F.lit(processed_on).alias("processing_date"),
        F.when(F.col("file_issue").isNotNull(), F.col("file_issue")).when(day.isNull(), "invalid_date").alias("issue"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("issue").isNull())


def summary(lines: DataFrame, column: str) -> DataFrame:
    """Rows per value of the first column whose header hints at a plant type or an area."""
    place = F.get("positions.hinted", F.lit(list(HINTS).index(column)))
    filled = lines.filter(F.trim("line") != "")
    value = cell(cells(F.col("line")), place).alias(column)
    return filled.select(value).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def long_form(parsed: DataFrame) -> DataFrame:
    """One row per plant, unit, day and half hour."""
    plain = [name for name in parsed.columns if name != "kwh"]
    return parsed.select(*plain, F.explode("kwh").alias("time", "output_kwh"))
