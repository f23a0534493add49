"""Merges, coverage, pivots and reports on small frames."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from gridspark.constants import SUPPLY_MEASURES
from gridspark.operators import coverage, dedup, ledger, merge, reports, routing, wide
from gridspark.schemas import SLOT_COLUMNS, TABLES, enforce, missing_columns, require_columns

KV = "k string, v int, n int"


def frame(spark, *data, schema=KV):
    return spark.createDataFrame(list(data), schema)


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_first_and_last_do_not_depend_on_partitioning(spark, rows, parts):
    df = frame(spark, *[(f"k{i % 5}", i, i) for i in range(100)]).repartition(parts)
    assert rows(dedup.keep_first(df, ["k"], ["n"]), "k", "v") == [(f"k{i}", i) for i in range(5)]
    assert rows(dedup.keep_last(df, ["k"], ["n"]), "k", "v") == [(f"k{i}", 95 + i) for i in range(5)]


def test_dominant_key_is_cut_down_before_the_shuffle(spark):
    df = frame(spark, *[("hot" if i % 3 else f"k{i}", i, i) for i in range(900)])
    plan = dedup.keep_first(df, ["k"], ["n"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert "Partial" in physical and physical.rindex("Partial") > physical.index("Exchange")


def test_insert_ignore(spark, rows):
    target = frame(spark, ("a", 1, 0), ("b", None, 0))
    batch = frame(spark, ("b", 9, 0), ("c", 5, 2), ("c", 4, 1), (None, 7, 0))
    once = merge.insert_ignore(target, batch, ["k"], ["n"])
    assert rows(once, "k", "v") == sorted([("a", 1), ("b", None), ("c", 4)], key=repr)
    again = merge.insert_ignore(once, batch, ["k"], ["n"])
    assert rows(again, "k", "v") == rows(once, "k", "v")
    assert merge.affected_counts(target, batch, ["k"], ["n"]).select("sent", "inserted", "ignored").first() == (4, 1, 3)


def test_upsert_replaces_whole_rows_with_the_last(spark, rows):
    target = frame(spark, ("a", 1, 0), ("b", 2, 0))
    batch = frame(spark, ("b", 9, 1), ("b", None, 2), ("c", 5, 0), (None, 1, 1))
    merged = merge.upsert(target, batch, ["k"], ["n"])
    assert rows(merged, "k", "v") == sorted([("a", 1), ("b", None), ("c", 5)], key=repr)
    assert rows(merge.upsert(merged, batch, ["k"], ["n"]), "k", "v") == rows(merged, "k", "v")


def test_upsert_of_columns_leaves_the_others(spark, rows):
    schema = "k string, v int, w int"
    target = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], schema)
    batch = spark.createDataFrame([("b", None, 9), ("c", 3, 3)], schema)
    merged = merge.upsert_columns(target, batch, ["k"], ["v"], ["w"])
    assert rows(merged, "k", "v", "w") == sorted([("a", 1, 1), ("b", None, 2), ("c", 3, 3)], key=repr)


def test_watermark(spark, rows):
    target, batch = frame(spark, ("a", 5, 0)), frame(spark, ("b", 5, 0), ("c", 6, 0), ("a", 7, 0))
    assert rows(merge.watermark_append(target, batch, ["k"], "v", ["n"]), "k", "v") == [("a", 5), ("c", 6)]
    assert merge.after_watermark(target.limit(0), batch, "v").count() == 3


def supply(spark, *rows):
    return spark.createDataFrame(list(rows), "area_code int, master_key string, date string, slot int, area_demand double, n int")


def test_stored_insert_appends_only_new_keys(spark, tmp_path, rows):
    table, path = TABLES["tso_area_data"], str(tmp_path / "t")
    first = supply(spark, (1, "20240401_1", "20240401", 1, 1.0, 0), (2, "20240401_1", "20240401", 1, 2.0, 0))
    merge.insert_into(spark, first, path, table, ["n"])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    merge.insert_into(spark, supply(spark, (1, "20240401_1", "20240401", 1, 9.0, 0), (1, "20240501_1", "20240501", 1, 3.0, 0)), path, table, ["n"])
    merge.insert_into(spark, first, path, table, ["n"])
    stored = merge.read_table(spark, path, table)
    assert rows(stored, "area_code", "month", "area_demand") == [(1, "202404", 1.0), (1, "202405", 3.0), (2, "202404", 2.0)]
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert routing.area_table(spark, path, 2).count() == 1
    with pytest.raises(ValueError):
        routing.area_table(spark, path, 11)


def test_stored_upsert_rewrites_only_touched_partitions(spark, tmp_path, rows):
    table, path = TABLES["tso_area_data"], str(tmp_path / "t")
    merge.append_into(supply(spark, (1, "20240401_1", "20240401", 1, 1.0, 0), (1, "20240401_2", "20240401", 2, 5.0, 0),
                             (2, "20240401_1", "20240401", 1, 2.0, 0)), path, table)
    untouched = {p.name for p in (tmp_path / "t" / "area_code=2").rglob("*.parquet")}
    batch = supply(spark, (1, "20240401_1", "20240401", 1, 7.0, 0), (1, "20240401_1", "20240401", 1, 8.0, 1))
    for _ in range(2):
        merge.upsert_into(spark, batch, path, table, ["n"])
        assert rows(merge.read_table(spark, path, table), "area_code", "slot", "area_demand") == [(1, 1, 8.0), (1, 2, 5.0), (2, 1, 2.0)]
    assert {p.name for p in (tmp_path / "t" / "area_code=2").rglob("*.parquet")} == untouched


def test_stored_column_upsert(spark, tmp_path, rows):
    table, path = TABLES["jepx_bid_data"], str(tmp_path / "b")
    step = "array<struct<price:string,sell_qty:string,buy_qty:string>>"
    schema = f"id string, date string, slot int, area_code int, bid {step}, n int"
    merge.upsert_into(spark, spark.createDataFrame([("20240401_1_1", "20240401", 1, 1, [("1", "2", "3")], 0)], schema), path, table, ["n"], ["bid"])
    merge.upsert_into(spark, spark.createDataFrame([("20240401_1_1", "20240401", 1, 1, [("9", "9", "9")], 0)], schema), path, table, ["n"], ["bid"])
    stored = merge.read_table(spark, path, table)
    assert stored.count() == 1 and stored.first().bid[0].price == "9"


def test_schema_projection(spark):
    table = TABLES["occto_reserve"]
    df = spark.createDataFrame([(date(2024, 1, 1), "3", "tepco", "x")], "date date, hour string, area string, extra string")
    assert missing_columns(df, table.columns) == ["reserve_rate"]
    projected = enforce(df, table)
    assert projected.schema.names == table.columns and projected.first().hour == 3
    with pytest.raises(ValueError):
        require_columns(df, ["nope"])
    assert set(TABLES["tso_area_data"].columns) >= set(SUPPLY_MEASURES)


def test_wide_areas_take_the_first_row_and_keep_the_spine(spark, rows):
    data = [(1, date(2024, 4, 1), 1, 10.0, 1), (2, date(2024, 4, 1), 1, 21.0, 2), (2, date(2024, 4, 1), 1, 20.0, 1),
            (2, date(2024, 4, 1), 2, 5.0, 1)]
    df = spark.createDataFrame(data, "area_code int, dt date, slot int, area_demand double, n int")
    result = wide.wide_areas(df, ["n"], ["area_demand"])
    assert rows(result, "master_key", "`1_area_demand`", "`2_area_demand`", "`3_area_demand`") == [("20240401_01", 10.0, 20.0, None)]
    plan = result._jdf.queryExecution().toString()
    assert plan[plan.index("== Physical Plan =="):].count("Exchange") == 1


def test_slot_matrix_round_trip(spark, rows):
    long = spark.createDataFrame([("u", n, n * 2) for n in range(1, 49)] + [("w", 7, 3)], "key string, slot int, kwh int")
    matrix = wide.rows_to_slots(long, ["key"], "kwh")
    assert matrix.columns == ["key", *SLOT_COLUMNS]
    assert rows(wide.slots_to_rows(matrix).filter("kwh <> 0"), "key", "slot", "kwh") == rows(long, "key", "slot", "kwh")


def test_month_spans_clip_both_ends(spark):
    df = spark.range(1).select(coverage.month_spans(F.lit(date(2024, 1, 31)), F.lit(date(2024, 3, 5))).alias("s"))
    assert [tuple(s) for s in df.first().s] == [(2024, 1, 31, 31), (2024, 2, 1, 29), (2024, 3, 1, 5)]
    same = spark.range(1).select(coverage.month_spans(F.lit(date(2024, 2, 3)), F.lit(date(2024, 2, 9))).alias("s"))
    assert [tuple(s) for s in same.first().s] == [(2024, 2, 3, 9)]


def test_gaps(spark, rows):
    feeds = spark.createDataFrame([("a",), ("b",)], "feed string")
    expected = coverage.expected_months(feeds, date(2024, 1, 15), date(2024, 2, 1))
    loaded = spark.createDataFrame([("a", date(2024, 1, 1)), ("a", date(2024, 1, 1))], "feed string, month_start date")
    assert rows(coverage.gaps(expected, loaded, ["feed", "month_start"]), "feed", "month_start") == [
        ("a", date(2024, 2, 1)), ("b", date(2024, 1, 1)), ("b", date(2024, 2, 1))]


@pytest.mark.parametrize("target, current, years", [
    (2024, 2025, [2024, 2023, 2025]), (2025, 2025, [2025, 2024]), (2030, 2025, [2025]), (2020, 2025, [2020, 2019, 2021, 2025]),
])
def test_archive_years(target, current, years):
    assert coverage.archive_years(target, current) == years


def test_candidates(spark, rows):
    df = spark.createDataFrame([("tohoku", 1, 0), ("tohoku", 2, 30), ("tohoku", 3, 40), ("chubu", 1, 0)], "area string, version int, length int")
    assert rows(dedup.first_usable(df, ["area"], ["version"], F.col("length") > 0), "area", "version") == [("tohoku", 2)]


def test_dense_ids(spark, rows):
    df = spark.range(1000).select(F.lit("same").alias("a"), (1000 - F.col("id")).alias("b")).repartition(5)
    numbered = ledger.dense_ids(df, ["a", "b"], start=11)
    assert rows(numbered.filter("id <> b + 10"), "id") == []
    assert sorted(r.id for r in numbered.collect()) == list(range(11, 1011))


def test_sparse_ids_are_unique(spark):
    df = ledger.sparse_ids(spark.range(100).repartition(4).drop("id").withColumn("x", F.lit(1)), F.lit(5))
    assert df.select("id").distinct().count() == 100 and df.agg(F.min("id")).first()[0] >= 5


def test_ledger_entries_get_growing_ids(spark, tmp_path, rows):
    attempts = spark.createDataFrame([("a", date(2024, 4, 1), True), ("b", date(2024, 4, 2), False)], "feed string, day date, ok boolean")
    name = F.concat("feed", F.lit(".csv"))
    entries = ledger.ledger_entries(attempts, F.col("feed"), F.col("day"), name, F.col("ok"), F.lit("404"))
    for _ in range(2):
        ledger.append_entries(entries, str(tmp_path / "l"))
    stored = merge.read_table(spark, str(tmp_path / "l"), TABLES["downloaded_files"])
    assert stored.count() == 4 and stored.select("id").distinct().count() == 4
    assert rows(stored.select("filename", "status").distinct(), "filename", "status") == [("a.csv", "success"), ("b.csv", "failed: 404")]
    assert stored.filter("downloaded_at is null").count() == 0


def test_profile(spark, rows):
    df = spark.createDataFrame([("a", i % 20) for i in range(40)] + [(None, None)], "s string, n int")
    assert rows(reports.profile(df, ["s", "n"]), "column", "nulls", "distinct_values", "values") == [
        ("n", 1, 20, None), ("s", 1, 1, "a")]


def test_reports(spark, rows):
    df = spark.createDataFrame([(3, "tepco", "x"), (10, "okinawa", None), (2, "tohoku", "x")], "area_code int, id string, `エリア名` string")
    assert rows(reports.select_areas(df, ["tepco"]), "id") == [("tepco",)]
    with pytest.raises(ValueError):
        reports.select_areas(df, ["nobody"])
    assert reports.find_column(df, ["エリア", "area_name"]) == "エリア名" and reports.find_column(df, ["?"]) is None
    assert [tuple(r) for r in reports.value_counts(df, "エリア名").collect()] == [("x", 2)]
    assert [r.area_code for r in reports.preview(df, [F.col("area_code")], 2).collect()] == [2, 3]
    assert reports.head_with_total(df, [F.col("area_code")], 1).first().total_rows == 3
    assert routing.with_area(df.select("area_code")).filter("region = '沖縄'").count() == 1


def test_range_and_columns_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    ranged = reports.in_range(orders, "o_orderdate", F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-02-01").cast("timestamp_ntz"))
    plan = ranged.select("o_orderkey")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
