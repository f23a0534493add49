"""Dimension tables (areas, stations, bearings, generation types) and their lookups."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import AREAS, BEARINGS, CALM, GENERATION_DEFAULT, GENERATION_TYPES, STATIONS

AREA_CODES = {area_id: code for area_id, _, code, _ in AREAS}
AREA_IDS = {code: area_id for area_id, code in AREA_CODES.items()}
BEARING_DEGREES = {name: 360.0 / len(BEARINGS) * step for step, name in enumerate(BEARINGS)}


def areas(spark: SparkSession) -> DataFrame:
    rows = [(code, area_id, name, code, region) for area_id, name, code, region in AREAS]
    return spark.createDataFrame(rows, "id int, tso_id string, name string, area_code int, region string")


def stations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATIONS, "station_id string, name string")


def bearings(spark: SparkSession) -> DataFrame:
    rows = [*BEARING_DEGREES.items(), (CALM, None)]
    return spark.createDataFrame(rows, "bearing string, degrees double")


def generation_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(GENERATION_TYPES.items()), "gen_name string, gen_method string")


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(item) for item in chain.from_iterable(mapping.items())])


def lookup(mapping: dict, key: Column) -> Column:
    """Null for a null or unknown key."""
    return F.try_element_at(literal_map(mapping), key)


def area_code_of(area_id: Column) -> Column:
    """Area id to code; an id that starts with a digit carries its code in front."""
    leading = F.regexp_extract(area_id, r"^([0-9])", 1).try_cast("int")
    return F.coalesce(leading, lookup(AREA_CODES, F.lower(area_id)))


def area_id_of(area_code: Column) -> Column:
    return lookup(AREA_IDS, F.trim(area_code.cast("string")).try_cast("int"))


def generation_type_of(name: Column) -> Column:
    return F.coalesce(lookup(GENERATION_TYPES, name), F.lit(GENERATION_DEFAULT))


def check_area_ids(area_ids: list[str]) -> list[int]:
    unknown = [area_id for area_id in area_ids if area_id not in AREA_CODES]
    if unknown:
        raise ValueError(f"unknown area ids: {unknown}")
    return [AREA_CODES[area_id] for area_id in area_ids]
