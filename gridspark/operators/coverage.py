"""Expected grids and what is missing from them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F


def months(start: Column, end: Column) -> Column:
    """First days of the months from `start` to `end`, both inclusive."""
    return F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))


def month_spans(start: Column, end: Column) -> Column:
    """`(year, month, first_day, last_day)` per month, the outer months clipped to the range."""
    return F.transform(
        months(start, end),
        lambda month: F.struct(
            F.year(month).alias("year"), F.month(month).alias("month"),
            F.dayofmonth(F.greatest(month, start)).alias("first_day"),
            F.dayofmonth(F.least(F.last_day(month), end)).alias("last_day"),
        ),
    )


def days(start: Column, end: Column) -> Column:
    return F.sequence(start, end, F.expr("interval 1 day"))


def expected_months(entities: DataFrame, start: date | Column, end: date | Column) -> DataFrame:
    """Every entity with every month of the range: each entity row unfolds its months in place."""
    first, last = _day(start), _day(end)
    return entities.select("*", F.explode(months(first, last)).alias("month_start"))


def expected_days(entities: DataFrame, start: date | Column, end: date | Column) -> DataFrame:
    return entities.select("*", F.explode(days(_day(start), _day(end))).alias("day"))


def expected_spans(entities: DataFrame, start: date | Column, end: date | Column) -> DataFrame:
    return entities.select("*", F.explode(month_spans(_day(start), _day(end))).alias("span")).select(
        *entities.columns, "span.*"
    )


def span_of(df: DataFrame, day: str) -> DataFrame:
    """One row with the first and last day of a table."""
    return df.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def gaps(expected: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Expected keys without any loaded row. Loaded keys are made distinct before they move."""
    return expected.join(loaded.select(*keys).distinct(), keys, "left_anti")


def archive_years(target_year: int, current_year: int) -> list[int]:
    """Years tried for a yearly archive, best first: the target (at most the current year),
    the one before, the one after if not in the future, and the current one."""
    wanted = [min(target_year, current_year), target_year - 1, target_year + 1, current_year]
    return list(dict.fromkeys(year for year in wanted if year <= current_year))


def _day(value: date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")
