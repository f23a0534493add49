"""Numbers written as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FULL_WIDTH = "０１２３４５６７８９"
ASCII = "0123456789"
# A cast alone would take `nan`, `1d` and the like for numbers.
NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"
WHOLE = r"^\s*[-+]?\d{1,18}\s*$"


def fold_digits(text: Column) -> Column:
    return F.when(text.rlike(f"[{FULL_WIDTH}]"), F.translate(text, FULL_WIDTH, ASCII)).otherwise(text)


def number_or_null(text: Column) -> Column:
    # The pattern comes first: a failing cast costs an exception per cell.
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def clean_number(text: Column) -> Column:
    """Thousands commas accepted; 0 where it is not a number. Fold full-width digits first."""
    grouped = F.when(text.contains(","), number_or_null(F.translate(text, ",", "")))
    return F.coalesce(number_or_null(text), grouped, F.lit(0.0))


def exact_int(text: Column) -> Column:
    """Whole part of a decimal text, toward zero; null for blank or invalid text."""
    decimal = F.when(text.rlike(NUMBER), F.trim(text).try_cast("decimal(38,10)")).try_cast("bigint")
    return F.when(text.rlike(WHOLE), F.trim(text).try_cast("bigint")).otherwise(decimal)


def exact_decimal(text: Column, kind: str) -> Column:
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast(kind))


def int_or_zero(text: Column, kind: str = "int") -> Column:
    return F.coalesce(number_or_null(text).try_cast(kind), F.lit(0).cast(kind))


def nullable_int(text: Column) -> Column:
    return F.trim(text).try_cast("int")
