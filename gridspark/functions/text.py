"""Decoding, cells, keys and display text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from gridspark.constants import NA_TOKENS

JAPANESE = "windows-31j"
BOM = "﻿"
# A comma, then a quoted cell with doubled quotes inside, or a plain one.
QUOTED_CELL = r', *("[^"]*+(?:""[^"]*+)*+" *|[^,]*)'


def is_utf8(content: Column) -> Column:
    return F.is_valid_utf8(content.cast("string"))


def decode_ladder(content: Column, utf8: Column | None = None) -> Column:
    """UTF-8 where the bytes are valid UTF-8, the Japanese code page otherwise.

    `utf8` passes a verdict reached for the whole file when `content` is a part of it.
    """
    valid = is_utf8(content) if utf8 is None else utf8
    text = F.when(valid, content.cast("string")).otherwise(F.decode(content, JAPANESE))
    return F.when(text.startswith(BOM), F.substring(text, 2, 2147483647)).otherwise(text)


def decode_fixed(content: Column, charset: str = JAPANESE) -> Column:
    return F.decode(content, charset)


def is_zip(content: Column) -> Column:
    return F.substring(content, 1, 4) == F.lit(b"PK\x03\x04")


def lines_of(text: Column) -> Column:
    """Lines without their ends; one trailing line end opens no further line."""
    return F.split(F.regexp_replace(text, r"(\r\n|\r|\n)\z", ""), r"\r\n|\r|\n")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` worked out once, however often `use` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _unquoted(raw: Column) -> Column:
    inner = F.regexp_extract(raw, r'^"(.*)" *$', 1)
    return F.when(raw.rlike(r'^".*" *$'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(raw)


def cells(line: Column) -> Column:
    """Comma-separated cells; only lines that hold quotes are matched cell by cell."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(QUOTED_CELL), F.lit(1))
    return F.when(line.contains('"'), F.transform(quoted, _unquoted)).otherwise(F.split(line, ","))


def cell(array: Column, position: int | Column) -> Column:
    """A trimmed cell; null past the end of a short row."""
    return F.trim(F.get(array, F.lit(position) if isinstance(position, int) else position))


def cells_at(array: Column, places: Column, read: Callable[[Column], Column]) -> Column:
    """The cells at `places`, trimmed and read alike: one small expression for many columns."""
    return F.transform(places, lambda place: read(F.trim(F.get(array, place))))


def joined_key(*parts: Column) -> Column:
    """Parts joined by `_`; null if any part is null, unlike concat_ws."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit("_"), part]
    return F.concat(*pieces)


def or_na(part: Column) -> Column:
    return F.coalesce(part, F.lit("NA"))


def na_to_null(text: Column) -> Column:
    return F.when(~text.isin(NA_TOKENS), text)


def blank_na_text(text: Column) -> Column:
    return F.when(text.isNull() | text.isin("nan", "<NA>"), "").otherwise(text)


def fixed_or_na(value: Column, digits: int = 2) -> Column:
    return F.when(value.isNull(), "N/A").otherwise(F.format_string(f"%.{digits}f", value.cast("double")))


def thousands_or_na(value: Column) -> Column:
    return F.when(value.isNull(), "N/A").otherwise(F.format_number(value, 0))


def settled(df: DataFrame) -> DataFrame:
    """The same rows behind a generator, which later filters are not pushed through.

    Without it a filter on a derived column repeats the derivation, text parsing
    included, below the projection that already holds it.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{name}`") for name in df.columns]))))
