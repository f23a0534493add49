"""Routing rows to per-area tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.dims import AREA_CODES, area_code_of, areas
from gridspark.operators.merge import read_table
from gridspark.schemas import TABLES


def table_name(area_id: Column, kind: str, prefix: str | None = None) -> Column:
    """Table an area's rows go to: numbered for known areas, by id and kind for others."""
    code = area_code_of(area_id)
    if prefix:
        return F.when(code.isNotNull(), F.concat(F.lit(f"{prefix}_"), area_id)).otherwise(F.lit(prefix))
    numbered = F.concat(F.lit("tso_area_"), code.cast("string"), F.lit("_data"))
    return F.coalesce(numbered, F.concat(area_id, F.lit(f"_{kind}")))


def with_area(df: DataFrame) -> DataFrame:
    """Area id, name and region next to the code; the dimension has ten rows."""
    dim = areas(df.sparkSession).select("area_code", "tso_id", F.col("name").alias("area_name"), "region")
    return df.join(F.broadcast(dim), "area_code", "left")


def area_table(spark: SparkSession, path: str, area_code: int) -> DataFrame:
    """One area's rows of the stored dataset; the filter prunes all other folders."""
    if area_code not in AREA_CODES.values():
        raise ValueError(f"unknown area code: {area_code}")
    return read_table(spark, path, TABLES["tso_area_data"]).filter(F.col("area_code") == area_code)
