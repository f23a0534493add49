"""Column functions on single values."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridspark.functions import dates, numbers, text, wind
from gridspark import dims


def value(spark, column, cell, kind="string"):
    df = spark.createDataFrame([(cell,)], f"x {kind}")
    return df.select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("label, slot", [
    ("00:00", 1), ("0:30", 2), ("23:30", 48), ("9:05", 20), ("24:00", 49), ("９:３０", 20),
    ("noon", 0), ("", 0), (None, 0), ("1:2:3", 0),
])
def test_slot_of_clock(spark, label, slot):
    assert value(spark, dates.slot_of_clock, label) == slot


@pytest.mark.parametrize("label, slot", [
    ("00:00", 1), ("09:15", 19), ("09:30", 20), ("17", 17), ("x:30", None), ("early", None), (None, None),
])
def test_slot_of_stored_clock(spark, label, slot):
    assert value(spark, dates.slot_of_stored_clock, label) == slot


@pytest.mark.parametrize("label, repaired", [("9", "9:30"), ("9:30:00", "9:30"), ("9:00", "9:00"), (None, None)])
def test_repair_clock(spark, label, repaired):
    assert value(spark, dates.repair_clock, label) == repaired


@pytest.mark.parametrize("written, day", [
    ("2024/4/1", date(2024, 4, 1)), ("2024/04/01", date(2024, 4, 1)), ("2024/02/30", None), ("2024-04-01", None),
    ("2024", None), ("", None), (None, None), ("2024/4/1 0:00", None),
])
def test_slashed_date(spark, written, day):
    assert value(spark, dates.slashed_date, written) == day


@pytest.mark.parametrize("written, day", [
    (" 20240401 ", date(2024, 4, 1)), ("2024/04/01", date(2024, 4, 1)), ("20241301", None), ("nan", None), (None, None),
])
def test_compact_date(spark, written, day):
    assert value(spark, dates.compact_date, written) == day


@pytest.mark.parametrize("written, interval, stamp", [
    ("2023/1/1 1:00:00", "hourly", datetime(2023, 1, 1, 1)), ("2023/1/1 01:30", "hourly", datetime(2023, 1, 1, 1, 30)),
    ("2023/1/1", "hourly", datetime(2023, 1, 1)), ("2023/1/1", "daily", datetime(2023, 1, 1)),
    ("2023/1/1 1:00", "daily", None), ("2023/1/1 24:00", "hourly", None), ("x", "hourly", None),
])
def test_observed_at(spark, written, interval, stamp):
    assert value(spark, lambda c: dates.observed_at(c, interval), written) == stamp


@pytest.mark.parametrize("day, clamped", [
    (date(2030, 5, 6), date(2025, 5, 6)), (date(2024, 5, 6), date(2024, 5, 6)), (date(2028, 2, 29), None),
])
def test_clamp_future_year(spark, day, clamped):
    assert value(spark, lambda c: dates.clamp_future_year(c, 2025), day, "date") == clamped


def test_clock_of_slot_and_back(spark):
    df = spark.range(1, 49).select(F.col("id").cast("int").alias("slot"))
    back = df.filter(dates.slot_of_clock(dates.clock_of_slot(F.col("slot"))) == F.col("slot"))
    assert back.count() == 48


@pytest.mark.parametrize("written, number", [
    ("1,234.5", 1234.5), ("１２３", 123.0), ("-5", -5.0), ("1e3", 1000.0), ("nan", 0.0), ("1d", 0.0), ("", 0.0),
    ("x", 0.0), (None, 0.0), (" 7 ", 7.0),
])
def test_clean_number(spark, written, number):
    assert value(spark, lambda c: numbers.clean_number(numbers.fold_digits(c)), written) == number


@pytest.mark.parametrize("written, number", [
    ("12.0", 12), ("2.7", 2), ("-2.7", -2), ("x", None), ("", None), (" 5 ", 5), ("1e2", 100), (None, None),
])
def test_exact_int(spark, written, number):
    assert value(spark, numbers.exact_int, written) == number


@pytest.mark.parametrize("written, number", [
    ("12.345", Decimal("12.35")), ("1234.5", Decimal("1234.50")), ("x", None), ("99999999", None), ("", None),
])
def test_exact_decimal(spark, written, number):
    assert value(spark, lambda c: numbers.exact_decimal(c, "decimal(9,2)"), written) == number


@pytest.mark.parametrize("written, number", [("12870", 12870), ("1.9", 1), ("x", 0), (None, 0), ("", 0)])
def test_int_or_zero(spark, written, number):
    assert value(spark, numbers.int_or_zero, written) == number


@pytest.mark.parametrize("line, cells", [
    ("a,b,,", ["a", "b", "", ""]),
    ('a, "1,234" ,b', ["a", "1,234", "b"]),
    ('"x ""q""",y', ['x "q"', "y"]),
    ('"open,b', ['"open', "b"]),
    ("", [""]),
    ('"",', ["", ""]),
])
def test_cells(spark, line, cells):
    assert value(spark, text.cells, line) == cells


def test_lines_keep_inner_blanks(spark):
    assert value(spark, text.lines_of, "a\r\n\nb\rc\n") == ["a", "", "b", "c"]


@pytest.mark.parametrize("words", ["火力（ＬＮＧ）,東京", "plain", "①～", ""])
@pytest.mark.parametrize("charset", ["utf-8", "cp932"])
def test_decoding_undoes_encoding(spark, words, charset):
    content = bytearray(words.encode(charset))
    assert value(spark, text.decode_ladder, content, "binary") == words


def test_decoding_survives_damage_and_drops_the_mark(spark):
    assert value(spark, text.decode_ladder, bytearray(b"\x82\xffA"), "binary").endswith("A")
    assert value(spark, text.decode_ladder, bytearray("﻿a".encode()), "binary") == "a"


@pytest.mark.parametrize("bearing, speed, sin, cos", [
    ("北", 3.0, 0.0, 1.0), ("東", 3.0, 1.0, 0.0), ("南西", 1.0, -0.7071, -0.7071), ("静穏", 0.0, 0.0, 0.0),
    ("静穏", 2.0, None, None), ("?", 1.0, None, None), (None, 0.0, 0.0, 0.0),
])
def test_wind_components(spark, bearing, speed, sin, cos):
    df = spark.createDataFrame([(bearing, speed)], "b string, s double")
    row = df.select(wind.bearing_sin(F.col("b"), F.col("s")).alias("sin"), wind.bearing_cos(F.col("b"), F.col("s")).alias("cos")).first()
    assert (row.sin, row.cos) == (sin, cos)


def test_key_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert [r.k for r in df.select(text.joined_key(F.col("x"), F.col("y")).alias("k")).collect()] == [None, "a_b"]


@pytest.mark.parametrize("area_id, code", [("tepco", 3), ("OKINAWA", 10), ("7_anything", 7), ("nobody", None)])
def test_area_codes(spark, area_id, code):
    assert value(spark, dims.area_code_of, area_id) == code


def test_area_ids_and_types(spark):
    assert value(spark, dims.area_id_of, " 10 ") == "okinawa"
    assert value(spark, dims.generation_type_of, "水力") == "hydro"
    assert value(spark, dims.generation_type_of, None) == "other_fire"
    assert dims.stations(spark).count() == 47 and dims.bearings(spark).count() == 17 and dims.areas(spark).count() == 10
    with pytest.raises(ValueError):
        dims.check_area_ids(["tepco", "nobody"])


def test_display(spark):
    assert value(spark, text.fixed_or_na, 1.5, "double") == "1.50"
    assert value(spark, text.fixed_or_na, None, "double") == "N/A"
    assert value(spark, text.thousands_or_na, 1234567, "bigint") == "1,234,567"
    assert value(spark, text.blank_na_text, "nan") == "" and value(spark, text.blank_na_text, "晴") == "晴"
