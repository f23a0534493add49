"""Wide tables across areas, and the slot matrix in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridspark.constants import SUPPLY_MEASURES
from gridspark.schemas import SLOT_COLUMNS

WIDE_AREAS = list(range(1, 10))
SPINE_AREA = 1


def wide_areas(supply: DataFrame, order: list[str], measures: list[str] = SUPPLY_MEASURES) -> DataFrame:
    """One row per day and slot of the spine area, all areas' measures side by side.

    Picking each area's first row, spreading the areas and keeping the spine's slots are
    one aggregation over one shuffle; each task first reduces its rows to one candidate
    per area and slot.
    """
    rank = F.struct(*order)
    values = F.struct(*measures)
    picks = [
        F.min_by(F.when(F.col("area_code") == area, values), F.when(F.col("area_code") == area, rank)).alias(f"a{area}")
        for area in WIDE_AREAS
    ]
    picked = supply.groupBy("dt", "slot").agg(*picks).filter(F.col(f"a{SPINE_AREA}").isNotNull())
    key = F.concat(F.date_format("dt", "yyyyMMdd"), F.lit("_"), F.lpad(F.col("slot").cast("string"), 2, "0"))
    return picked.select(
        key.alias("master_key"), F.col("dt").alias("date"), "slot",
        *[F.col(f"a{area}")[name].alias(f"{area}_{name}") for area in WIDE_AREAS for name in measures],
    )


def slots_to_rows(generation: DataFrame) -> DataFrame:
    """48 slot columns to one row per slot."""
    keep = [name for name in generation.columns if name not in SLOT_COLUMNS]
    numbered = F.array(*SLOT_COLUMNS)
    return generation.select(*keep, F.posexplode(numbered).alias("pos", "kwh")).select(
        *keep, (F.col("pos") + 1).alias("slot"), "kwh"
    )


def rows_to_slots(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per key with 48 slot columns, absent slots 0."""
    sums = [
        F.coalesce(F.sum(F.when(F.col("slot") == n, F.col(value))), F.lit(0)).alias(name)
        for n, name in enumerate(SLOT_COLUMNS, start=1)
    ]
    return rows.groupBy(*keys).agg(*sums)
