"""Dates, times and half-hour slots."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gridspark.functions.numbers import fold_digits

SLASHED_DATE = r"^\s*(\d{4}/\d{1,2}/\d{1,2})\s*$"
SLASHED_STAMP = r"^\s*(\d{4}/\d{1,2}/\d{1,2}(?: +\d{1,2}:\d{1,2}(?::\d{1,2})?)?)\s*$"
COMPACT_DATE = r"^\d{8}$"
CLOCK = r"^\s*([+-]?\d+)\s*:\s*([+-]?\d+)\s*$"


def slashed_date(text: Column) -> Column:
    """`2024/4/1` to a date; anything else is null."""
    return F.translate(F.regexp_extract(text, SLASHED_DATE, 1), "/", "-").try_cast("date")


def compact_date(text: Column) -> Column:
    """`20240401` (slashes and blanks tolerated) to a date; anything else is null."""
    digits = F.regexp_extract(F.translate(F.trim(text), "/", ""), COMPACT_DATE, 0)
    return F.regexp_replace(digits, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").try_cast("date")


def compact_text(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def iso_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def slot_of_clock(label: Column) -> Column:
    """`HH:MM` to its start-labelled half-hour slot; 0 where it cannot be read.

    Minute zero opens the hour's first slot, every other minute its second one.
    """
    folded = fold_digits(label)
    hour = F.regexp_extract(folded, CLOCK, 1).try_cast("int")
    minute = F.regexp_extract(folded, CLOCK, 2).try_cast("int")
    return F.coalesce(hour * 2 + F.when(minute == 0, 1).when(minute.isNotNull(), 2), F.lit(0))


def slot_of_stored_clock(label: Column) -> Column:
    """Slot for already stored labels: only minute text `30` is a second half; null if unreadable."""
    hour = F.regexp_extract(label, r"^\s*([+-]?\d+)\s*:([^:]*)$", 1).try_cast("int")
    second_half = F.regexp_extract(label, r"^\s*([+-]?\d+)\s*:([^:]*)$", 2) == "30"
    return F.when(label.contains(":"), hour * 2 + 1 + second_half.cast("int")).otherwise(label.try_cast("int"))


def repair_clock(label: Column) -> Column:
    """A bare hour `h` means `h:30`; seconds are cut off."""
    return (
        F.when(label.rlike(r"^\d+$"), F.concat(label, F.lit(":30")))
        .when(label.rlike(r"^[^:]*:[^:]*:[^:]*$"), F.regexp_extract(label, r"^([^:]*:[^:]*):", 1))
        .otherwise(label)
    )


def slot_of_stamp(stamp: Column) -> Column:
    """The half-hour slot a timestamp falls into, 1 to 48."""
    return F.hour(stamp) * 2 + F.when(F.minute(stamp) < 30, 1).otherwise(2)


def clock_of_slot(slot: Column) -> Column:
    """Start label of a slot: 1 is `00:00`, 48 is `23:30`."""
    half = slot - 1
    hour = F.lpad((F.floor(half / 2)).cast("string"), 2, "0")
    return F.concat(hour, F.when(half % 2 == 0, ":00").otherwise(":30"))


def observed_at(text: Column, interval: str) -> Column:
    """Observation time: date and clock for hourly files, date only for daily ones."""
    if interval not in ("hourly", "daily"):
        raise ValueError(f"unknown interval: {interval}")
    pattern = SLASHED_DATE if interval == "daily" else SLASHED_STAMP
    return F.translate(F.regexp_extract(text, pattern, 1), "/", "-").try_cast("timestamp_ntz")


def clamp_future_year(day: Column, year: int) -> Column:
    """Move days of later years into `year`; 29 February has no counterpart and becomes null."""
    moved = F.concat(F.lit(f"{year:04d}-"), F.date_format(day, "MM-dd")).try_cast("date")
    return F.when(F.year(day) > year, moved).otherwise(day)
