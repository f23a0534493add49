"""Deterministic first-wins and last-wins deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__rank"


def _columns(order: list[str | Column]) -> list[Column]:
    return [F.col(item) if isinstance(item, str) else item for item in order]


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the first by `order`.

    The rank filter is limited to one row per key and task before the shuffle, so a
    key that holds a large share of all rows does not pile up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*_columns(order))
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def keep_last(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key, the last by `order`."""
    return keep_first(df, keys, [column.desc() for column in _columns(order)])


def first_usable(candidates: DataFrame, keys: list[str], priority: list[str | Column], usable: Column) -> DataFrame:
    """The best-ranked usable candidate per key, e.g. the first non-empty file version."""
    return keep_first(candidates.filter(usable), keys, priority)


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of repeated keys. The keys' side of the join has one row per key, so a
    dominant key can be split on the other side."""
    return df.join(duplicate_groups(df, keys), keys, "left_semi").select(*df.columns)


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: repeated keys, rows in repeated groups, rows a first-wins pass removes."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    repeated = F.col("copies") > 1
    return groups.agg(
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("copies"))), F.lit(0)).alias("rows_in_groups"),
        F.coalesce(F.sum(F.when(repeated, F.col("copies") - 1)), F.lit(0)).alias("rows_removed"),
    )
