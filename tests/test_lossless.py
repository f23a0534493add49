"""Nothing that has landed is lost without a word: late headers, unnamed and oversize files, odd names and months."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from gridspark.constants import PRICE_CELLS, PRICE_HEADER_CELL
from gridspark.operators import merge
from gridspark.schemas import TABLES
from gridspark.sources import area_supply, bid_stack, files, intertie, plant_operation, spot_price, unit_generation
from gridspark.sources.lines import first_cell_line, nth_line, piece_lines
from gridspark.streaming.ingest import ingest_new_files
from test_sources import SUPPLY_HEADER, archive, land, price_line


@pytest.mark.parametrize("before", [0, 10, 400])
@pytest.mark.parametrize("piece_bytes", [1 << 22, 3000])
def test_price_header_far_down_in_an_archive(spark, tmp_path, before, piece_bytes):
    header = ",".join([PRICE_HEADER_CELL, *["x"] * 47])
    days = [price_line(f"2024/04/{n % 28 + 1:02d}", str(n % 48 + 1)) for n in range(400)]
    text = "\n".join([*["note"] * before, header, *days]) + "\n"
    land(tmp_path, "spot.zip", archive(a__csv=text.encode("cp932")))
    rule = first_cell_line(PRICE_HEADER_CELL)
    pieces = files.archive_pieces(files.scan_files(spark, str(tmp_path)), piece_bytes, rule.rule)
    lines = piece_lines(pieces, rule, lambda head, at: F.when(at.isNotNull(), F.array(F.lit(0))), "windows-31j")
    parsed = spot_price.parse(lines.filter(F.col("positions").isNotNull()))
    assert spot_price.accepted(parsed).count() == 400 and parsed.count() == 400


def test_area_header_below_many_blank_lines_in_an_archive(spark, tmp_path):
    body = [f"2024/04/{n % 28 + 1:02d},{n % 24}:00,{n},,," for n in range(300)]
    text = "\n" * 30 + "title\n" + "\n" * 30 + "\n".join([SUPPLY_HEADER, *body]) + "\n"
    land(tmp_path, "tepco/e_2024.zip", archive(a__csv=text))
    rule = nth_line(2)
    pieces = files.archive_pieces(files.scan_files(spark, str(tmp_path)), 500, rule.rule)
    cut = piece_lines(pieces, rule, lambda head, at: area_supply.positions(F.get(head, at.cast("int")), F.lit(3)))
    filled = cut.filter(F.trim("line") != "")
    assert filled.filter(F.get("positions", F.lit(0)) == 0).count() == 300


def test_unnamed_archive_above_the_limit_for_plain_files(spark, tmp_path, rows, small_splits):
    body = "\n".join(f"2024/04/{n % 28 + 1:02d},{n % 24}:00,{n},,," for n in range(200))
    land(tmp_path, "tepco/unnamed", archive(a__csv=f"t\n{SUPPLY_HEADER}\n{body}\n"))
    land(tmp_path, "tepco/plain", f"t\n{SUPPLY_HEADER}\n2024/05/01,0:00,7,,,\n")
    small, large = (area_supply.parse(area_supply.scan(spark, str(tmp_path), limit)) for limit in (1 << 20, 10))
    assert rows(small, "master_key", "area_demand", "issue") == rows(large, "master_key", "area_demand", "issue")
    assert small.count() == 201


def test_oversize_files_stop_the_load(spark, tmp_path, monkeypatch):
    # Where workers cannot seek, an archive is opened as a whole.
    land(tmp_path / "a", "tepco/big_2024.zip", archive(a__csv=f"t\n{SUPPLY_HEADER}\n"))
    monkeypatch.setattr(files, "ARCHIVE_LIMIT", 20)
    monkeypatch.setattr(files, "can_seek", lambda *_: False)
    with pytest.raises(ValueError, match="archive_too_large.*big_2024.zip"):
        area_supply.scan(spark, str(tmp_path / "a"))
    land(tmp_path / "b", "answer.json", '{"data":{"items":[]}}')
    monkeypatch.setattr(unit_generation, "ANSWER_LIMIT", 5)
    monkeypatch.setattr(unit_generation, "can_seek", lambda *_: False)
    with pytest.raises(ValueError, match="answer_too_large.*answer.json"):
        unit_generation.scan(spark, str(tmp_path / "b"))


WEATHER = "primary_key string, date string, temperature double, n int"


@pytest.mark.parametrize("days", [[None], [None, "2024-01-05"]])
def test_null_months_load_once(spark, tmp_path, days, rows):
    table = TABLES["jma_weather"]
    batch = spark.createDataFrame([(f"k{i}", day, float(i), 0) for i, day in enumerate(days)], WEATHER)
    for name, write in (("insert", merge.insert_into), ("upsert", merge.upsert_into)):
        path = str(tmp_path / name)
        for _ in range(3):
            write(spark, batch, path, table, ["n"])
        assert rows(merge.read_table(spark, path, table), "primary_key", "temperature") == [(f"k{i}", float(i)) for i in range(len(days))]


@pytest.mark.parametrize("limit", [0, 1000])
def test_null_months_load_once_with_either_way_of_pruning(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(merge, "PARTITIONS_TO_PRUNE", limit)
    table, path = TABLES["jma_weather"], str(tmp_path / "t")
    batch = spark.createDataFrame([("a", None, 1.0, 0), ("b", "2024-01-05", 2.0, 0), ("c", "2024-02-05", 3.0, 0)], WEATHER)
    for _ in range(2):
        merge.insert_into(spark, batch, path, table, ["n"])
        merge.upsert_into(spark, batch, path, table, ["n"])
    assert merge.read_table(spark, path, table).count() == 3


def test_month_of_any_spelling(spark):
    days = spark.createDataFrame([("2024/1/5",), ("2024-01-05",), ("20240105",), ("2024/12/31",), (None,)], "d string")
    assert [r[0] for r in days.select(merge.month_of(F.col("d"))).collect()] == ["202401", "202401", "202401", "202412", None]


def test_upsert_rewrites_the_touched_pairs_only(spark, tmp_path):
    table, path = TABLES["tso_area_data"], str(tmp_path / "t")
    schema = "area_code int, master_key string, date string, slot int, area_demand double, n int"
    every = [(a, f"2024{m}01_1", f"2024{m}01", 1, 1.0, 0) for a in (1, 2) for m in ("04", "05")]
    merge.append_into(spark.createDataFrame(every, schema), path, table)
    before = {p.relative_to(tmp_path): p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    merge.upsert_into(spark, spark.createDataFrame([every[0][:4] + (9.0, 1), every[3][:4] + (9.0, 1)], schema), path, table, ["n"])
    kept = {p.relative_to(tmp_path) for p in (tmp_path / "t").rglob("*.parquet")} & set(before)
    assert {str(p.parent) for p in kept} == {"t/area_code=1/month=202405", "t/area_code=2/month=202404"}
    assert merge.read_table(spark, path, table).filter("area_demand = 9").count() == 2


def test_stream_takes_names_with_pattern_characters(spark, tmp_path, rows):
    for name in ("a[1]_202404", "b{x,y}_202404", "c*d_202404"):
        land(tmp_path / "landing", f"tepco/{name}.csv", f"t\n{SUPPLY_HEADER}\n2024/04/01,{ord(name[0]) - 97}:00,1,,,\n")
    query = ingest_new_files(
        spark, str(tmp_path / "landing"), lambda s, paths: area_supply.parse(area_supply.scan(s, paths, every_version=True)),
        TABLES["tso_area_data"], str(tmp_path / "table"), str(tmp_path / "ledger"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert query.exception() is None
    stored = merge.read_table(spark, str(tmp_path / "table"), TABLES["tso_area_data"])
    assert rows(stored, "master_key") == [("20240401_1",), ("20240401_3",), ("20240401_5",)]
    ledger = spark.read.parquet(str(tmp_path / "ledger"))
    assert rows(ledger, "status") == [("success",)] * 3


def test_intertie_files_are_read_by_their_own_headers(spark, tmp_path, rows):
    land(tmp_path, "1.csv", "連系線,容量\n北本,900\n", "cp932")
    land(tmp_path, "2.csv", '容量,備考,連系線\n"1,200",x,阿南\n5\n', "cp932")
    df = intertie.read(spark, str(tmp_path))
    assert df.columns == ["連系線", "容量", "備考"]
    assert rows(df, *df.columns) == sorted([("北本", "900", None), ("阿南", "1,200", "x"), (None, "5", None)], key=repr)


def test_plant_labels_that_repeat_and_bad_days(spark, tmp_path, rows):
    text = "発電所コード,エリア,発電所名,ユニット名,発電方式・燃種,対象日,00:30[kWh],00:30[kWh]\n1,東京,A,1号,水力,2025/04/01,10,20\n2,東京,B,1号,水力,nothing,1,2\n"
    land(tmp_path, "p.csv", text, "cp932")
    parsed = plant_operation.parse(plant_operation.scan(spark, str(tmp_path)), date(2025, 4, 3))
    assert rows(parsed, "plant_code", "kwh", "issue") == [("1", {"00:30": 10.0}, None), ("2", {"00:30": 1.0}, "invalid_date")]
    assert plant_operation.accepted(parsed).count() == 1


def test_only_the_chosen_version_is_read(spark, tmp_path, rows):
    for name, value in (("01", None), ("02", 2), ("03", 3)):
        text = "" if value is None else f"t\n{SUPPLY_HEADER}\n2024/04/01,0:00,{value},,,\n2024/04/0{value},0:30,{value},,,\n"
        land(tmp_path, f"tepco/eria_202404_{name}.csv", text)
    land(tmp_path, "tepco/other.csv", f"t\n{SUPPLY_HEADER}\n2024/05/01,0:00,9,,,\n")
    got = area_supply.load(spark, str(tmp_path), current_year=2024)
    assert rows(got, "master_key", "area_demand") == [("20240401_1", 2.0), ("20240402_2", 2.0), ("20240501_1", 9.0)]
    assert area_supply.load(spark, str(tmp_path / "tepco" / "eria_202404_01.csv"), current_year=2024).count() == 0


def test_both_bid_feeds_share_one_table(spark, tmp_path, rows):
    def line(price, slot=1):
        return f"20240401,{slot},{price},10,20,1\n"

    landing, path = tmp_path / "landing", str(tmp_path / "table")
    land(landing, "spot_bid_curves/spot_bid_curves_20240401.csv", "h,h,h,h,h,h\n" + line(1) + line(2) + line(7, 2))

    def run():
        query = ingest_new_files(
            spark, str(landing), lambda s, paths: bid_stack.parse(bid_stack.scan(s, paths)), TABLES["jepx_bid_data"], path,
            str(tmp_path / "ledger"), str(tmp_path / "checkpoint"), replace=True, order=["feed"], shape=bid_stack.table_rows, columns=["bid"])
        query.awaitTermination()
        assert query.exception() is None
        stored = merge.read_table(spark, path, TABLES["jepx_bid_data"])
        return rows(stored, "id", F.transform("bid", lambda step: step["price"]))

    assert run() == [("20240401_1_1", ["1", "2"]), ("20240401_2_1", ["7"])]
    land(landing, "spot_splitting_areas/spot_splitting_areas_20240401.csv", line(5))
    assert run() == [("20240401_1_1", ["5"]), ("20240401_2_1", ["7"])]
    steps = bid_stack.parse(bid_stack.scan(spark, str(landing)))
    assert rows(bid_stack.table_rows(steps), "id", "feed") == [("20240401_1_1", 1), ("20240401_2_1", 0)]


def test_plant_summaries_by_header_hint(spark, tmp_path, rows):
    text = "発電所コード,供給エリア,発電所名,ユニット名,燃種,対象日,00:30[kWh]\n1,東京,A,1号,水力,2025/04/01,1\n2,東京,B,1号,風力,2025/04/01,1\n"
    land(tmp_path, "p.csv", text, "cp932")
    lines = plant_operation.scan(spark, str(tmp_path))
    assert rows(plant_operation.summary(lines, "area"), "area", "rows") == [("東京", 2)]
    assert rows(plant_operation.summary(lines, "plant_type"), "plant_type", "rows") == sorted([("水力", 1), ("風力", 1)], key=repr)


def test_price_cells_are_complete():
    assert len({number for number, *_ in PRICE_CELLS}) == len(PRICE_CELLS)
