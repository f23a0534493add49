"""Landed bytes through the real readers."""

import io
import json
import zipfile
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridspark.operators.dedup import keep_last
from gridspark.sources import area_supply, bid_stack, export, files, intertie, plant_operation, spot_price, \
    unit_generation, weather, weather_table
from gridspark.constants import PRICE_CELLS

SUPPLY_HEADER = "DATE,TIME,エリア需要,原子力,火力（ＬＮＧ）,合計"


def land(root, name, content, charset="utf-8"):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode(charset))
    return str(root)


def archive(**entries):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as target:
        for name, content in entries.items():
            target.writestr(name.replace("__", "."), content)
    return buffer.getvalue()


# --- area supply -------------------------------------------------------------------


def supply_landing(tmp_path):
    body = "\n".join([
        "title", "", SUPPLY_HEADER, '2024/4/1, 0:00,"1,234",１２,3,x', "2024/04/01,00:30,5,6,7,8",
        "2024/04/01,00:30,50,60,70,80", "DATE,TIME,a,b,c,d", "bad,1:00,1,1,1,1", "2024/04/01,24:00,9", "", "2024/04/01,zz,9",
    ])
    land(tmp_path, "tepco/eria_202404_03.csv", body + "\n", "cp932")
    land(tmp_path, "kyushu/area_202404.csv", f"t\r\n{SUPPLY_HEADER}\r\n 20240401 ,9,1,2,3,4\r\n2024/04/01,9:00:00,7\r\n")
    land(tmp_path, "okinawa/no_date.csv", "t\nTIME,合計\n0:00,5\n")
    return land(tmp_path, "tohoku/empty.csv", b"")


SUPPLY_EXPECTED = [
    (3, "20240401_0", 9.0, 0.0, 0.0), (3, "20240401_1", 1234.0, 12.0, 0.0), (3, "20240401_2", 5.0, 6.0, 8.0),
    (3, "20240401_49", 9.0, 0.0, 0.0), (9, "20240401_19", 7.0, 0.0, 0.0), (9, "20240401_20", 1.0, 2.0, 4.0),
]
SUPPLY_COLUMNS = ["area_code", "master_key", "area_demand", "nuclear", "total"]


def test_area_supply_files(spark, tmp_path, rows):
    landing = supply_landing(tmp_path)
    assert rows(area_supply.load(spark, landing), *SUPPLY_COLUMNS) == sorted(SUPPLY_EXPECTED, key=repr)


def test_area_supply_large_route_gives_the_same(spark, tmp_path, rows, small_splits):
    landing = supply_landing(tmp_path)
    loaded = area_supply.load(spark, landing, limit=10)
    assert rows(loaded, *SUPPLY_COLUMNS) == sorted(SUPPLY_EXPECTED, key=repr)


def test_large_files_are_read_in_splits_and_in_order(spark, tmp_path, rows, small_splits):
    lines = [f"2024/04/01,00:00,{n},,," for n in range(1, 200)]
    land(tmp_path, "chugoku/a_202404.csv", "\n".join(["表題", SUPPLY_HEADER, *lines]) + "\n", "cp932")
    scan = area_supply.scan(spark, str(tmp_path), limit=10)
    assert scan.select("seg").distinct().count() > 20
    assert scan.count() == len(lines)
    assert rows(area_supply.canonical(area_supply.parse(scan)), "area_code", "area_demand") == [(7, 1.0)]


def test_area_supply_rejects(spark, tmp_path, rows):
    parsed = area_supply.parse(area_supply.scan(spark, supply_landing(tmp_path)))
    assert rows(area_supply.rejects(parsed), "area_code", "issue") == [
        (10, "missing_required_column"), (3, "invalid_date"), (3, "repeated_header"), (3, "slot_out_of_range"),
        (3, "slot_out_of_range"),
    ]
    reasons = parsed.filter(~F.col("issue").isin("slot_out_of_range")).count()
    assert area_supply.accepted(parsed).count() + reasons == parsed.count()


def test_archives(spark, tmp_path, rows):
    header = SUPPLY_HEADER.replace("（ＬＮＧ）", "(LNG)")
    good = f"t\n{header}\n2024/04/02,0:30,1,2,3,4\n"
    content = archive(a__csv=good.encode("cp932"), b__CSV=good.replace("04/02", "04/03").encode(), notes__txt="no", empty__csv="")
    land(tmp_path, "chubu/eria_jukyu_2024.zip", content)
    land(tmp_path, "chubu/unnamed_2023.bin", archive(c__csv=good.replace("2024", "2023").encode()))
    land(tmp_path, "chubu/fake.zip", b"not an archive")
    broken = bytearray(archive(x__csv=("t\n" + header + "\n" + "2024/05/01,0:00,1,2,3,4\n" * 500).encode()))
    broken[120:140] = bytes(20)
    land(tmp_path, "chubu/broken.zip", bytes(broken))
    loaded = area_supply.load(spark, str(tmp_path))
    assert rows(loaded, "area_code", "master_key", "LNG") == [
        (4, "20230402_2", 3.0), (4, "20240402_2", 3.0), (4, "20240403_2", 3.0)]


def test_archive_entries_are_cut_at_line_ends(spark, tmp_path):
    lines = [f"2024/04/{n % 28 + 1:02d},{n % 24}:00,{n},,," for n in range(3000)]
    text = "\n".join(["表題", SUPPLY_HEADER, *lines])
    land(tmp_path, "chubu/e_2024.zip", archive(a__csv=text.encode("cp932")))
    from gridspark.sources.lines import nth_line, piece_lines

    pieces = files.archive_pieces(files.scan_files(spark, str(tmp_path), name=files.has_archive_name), 1000, nth_line(2).rule)
    assert pieces.count() > 50
    cut = piece_lines(pieces, nth_line(2), lambda head, at: area_supply.positions(F.get(head, at.cast("int")), F.lit(3)))
    assert cut.count() == len(lines)
    assert cut.filter(F.get("positions", F.lit(0)) != 0).count() == 0


def test_names_decide_which_files_are_read(spark, tmp_path):
    land(tmp_path, "a.csv", "x\n1\n")
    land(tmp_path, "b.zip", archive(b__csv="x\n2\n"))
    land(tmp_path, "c.csv", archive(c__csv="x\n3\n"))
    land(tmp_path, "d.bin", archive(d__csv="x\n4\n"))
    land(tmp_path, "e.bin", "x\n5\n")

    def contents(**options):
        pieces = files.scan_pieces(spark, str(tmp_path), **options)
        return sorted(bytes(r.content)[2:3] for r in pieces.collect())

    assert contents(trust_names=False) == [b"1", b"2", b"3", b"4", b"5"]
    assert len(contents()) == 5 and b"3" not in contents()  # taken as text, to be rejected line by line
    named = files.scan_files(spark, str(tmp_path), name=files.has_archive_name)
    named.collect()
    scan = next(line for line in named._jdf.queryExecution().toString().splitlines() if "FileScan binaryFile" in line)
    assert "file_name" in scan


def test_paths(spark):
    df = spark.createDataFrame([("/x/tepco/eria_202404_03.csv",), ("/x/chubu_2024.zip",), ("/x/unknown/a.csv",)], "path string")
    assert [tuple(r) for r in df.select(files.area_of_path(F.col("path")), files.period_of_path(F.col("path"))).collect()] == [
        (3, "202404"), (4, "2024"), (None, None)]


def test_version_choice(spark, rows):
    names = [("/l/tohoku/eria_jukyu_202404_01.csv", 0), ("/l/tohoku/eria_jukyu_202404_02.csv", 9),
             ("/l/tohoku/eria_jukyu_202404_03.csv", 9), ("/l/tepco/eria_jukyu_202404_03.csv", 9),
             ("/l/chubu/eria_jukyu_2023.zip", 9), ("/l/chubu/eria_jukyu_2024.zip", 0), ("/l/chubu/eria_jukyu_2025.zip", 9)]
    df = spark.createDataFrame(names, "path string, length bigint")
    assert rows(area_supply.choose_versions(df, 2025), "area_code", "path") == [
        (2, "/l/tohoku/eria_jukyu_202404_02.csv"), (3, "/l/tepco/eria_jukyu_202404_03.csv"),
        (4, "/l/chubu/eria_jukyu_2023.zip"), (4, "/l/chubu/eria_jukyu_2025.zip")]
    assert rows(area_supply.archive_for_year(df, 2024, 2025), "path") == [("/l/chubu/eria_jukyu_2023.zip",)]


# --- price and bids ------------------------------------------------------------------


def price_line(day, slot, **cells):
    values = [""] * 48
    values[0], values[1] = day, slot
    for position, value in cells.items():
        values[int(position[1:])] = value
    return ",".join(values)


def test_spot_price(spark, tmp_path, rows):
    headers = dict((number, header) for number, header, _ in PRICE_CELLS)
    header = ",".join(headers.get(n, "") for n in range(48))
    text = "\r\n".join([
        "お知らせ", header, price_line("2024/04/01", "1", _2="12.0", _5="10.5", _6="x", _47="3.456"),
        ",,", "2024/04/01,2,7", price_line("2024/13/01", "1"), price_line("2024/04/02", "a"),
        price_line("2024/04/01", "1", _5="1234.5"),
    ])
    land(tmp_path, "spot.csv", text, "cp932")
    land(tmp_path, "other.csv", "no header here\n1,2\n")
    parsed = spot_price.parse(spot_price.scan(spark, str(tmp_path)))
    assert rows(parsed.filter("issue is not null"), "issue") == [("invalid_date",), ("invalid_slot",), ("no_header",)]
    first = parsed.filter("slot = 1 and sell_bid_qty_kwh = 12").first()
    assert (first.ap0_system, first.ap1_hokkaido, first.fip_ref_price_kyushu) == (Decimal("10.50"), None, Decimal("3.46"))
    latest = keep_last(spot_price.accepted(parsed), ["date", "slot"], spot_price.ORDER)
    assert rows(latest, "date", "slot", "sell_bid_qty_kwh", "ap0_system") == [
        ("2024-04-01", 1, None, Decimal("1234.50")), ("2024-04-01", 2, 7, None)]


def test_spot_price_large_route(spark, tmp_path, small_splits):
    lines = [price_line("2024/04/01", str(n), _5=f"{n}.25") for n in range(1, 49)]
    land(tmp_path, "spot.csv", "\n".join(["x", "年月日,時刻コード", *lines]), "cp932")
    parsed = spot_price.parse(spot_price.scan(spark, str(tmp_path), limit=10))
    assert parsed.filter("issue is null").count() == 48


def test_price_header_rename(spark):
    df = spark.createDataFrame([("a", "b")], "`年月日` string, `時刻コード` string")
    assert spot_price.rename_headers(df).columns == ["date", "slot"]


BIDS = "日付,時刻,価格,売り,買い,エリア\n20240401,1,5.0,10,20,1,extra\n20240401,1,6.0,11,21,1\n20240401,2,1,1,1\n20240401,01,4.0,12,22,01\n"


@pytest.mark.parametrize("charset", ["utf-8", "cp932"])
def test_bid_stack(spark, tmp_path, charset):
    land(tmp_path, "spot_bid_curves_20240401.csv", BIDS, charset)
    parsed = bid_stack.parse(bid_stack.scan(spark, str(tmp_path)))
    assert parsed.filter("issue is not null").count() == 2
    stacked = bid_stack.from_files(parsed).first()
    assert (stacked.id, stacked.slot, stacked.area_code) == ("20240401_1_1", 1, 1)
    assert [p.price for p in stacked.bid] == ["5.0", "6.0", "4.0"]
    assert bid_stack.first_and_size(bid_stack.from_files(parsed)).first().points == 3
    as_json = bid_stack.from_files(parsed).select(bid_stack.bid_json(F.col("bid")).alias("j"))
    assert json.loads(as_json.first().j)[0] == {"price": "5.0", "sell_qty": "10", "buy_qty": "20"}
    assert as_json.select(F.size(bid_stack.bids_from_json(F.col("j")))).first()[0] == 3


def test_bid_segments_stay_bounded_and_ordered(spark):
    many = 10_000
    lines = spark.range(many).select(
        F.lit("f").alias("path"), F.lit(0).cast("bigint").alias("seg"), F.col("id").alias("line_no"),
        F.concat_ws(",", F.lit("20240401"), F.lit("1"), F.col("id").cast("string"), F.lit("1"), F.lit("2"), F.lit("3")).alias("line"),
    )
    steps = bid_stack.accepted(bid_stack.parse(lines)).repartition(7)
    parts = bid_stack.segments(steps, bid_stack.ORDER, [F.col("path"), F.col("seg"), bid_stack.file_segment()])
    assert parts.select(F.max(F.size("bid"))).first()[0] <= bid_stack.SEGMENT_LINES
    assert [p.price for p in bid_stack.stacks(parts).first().bid] == [str(n) for n in range(many)]


# --- generation ------------------------------------------------------------------------


def unit(day, **more):
    return {"htdnsCd": "10001", "areaCd": "01", "unitNm": "１号機", "tgtDate": day, "htdnsNm": "泊発電所",
            "htdnNm": "原子力", "htdnRslt0030": "1", "htdnRslt2400": "2", "dayElr": "3", "upyh": "x", **more}


def test_unit_generation(spark, tmp_path, rows):
    answers = {"data": {"items": [unit("2024/05/01"), unit("2024/05/02", unitNm=None, htdnNm="謎", htdnRslt0030="x", areaCd="zz"),
                                  unit("bad")]}}
    land(tmp_path, "a.json", json.dumps(answers, ensure_ascii=False))
    land(tmp_path, "b.json", json.dumps({"data": {}}))
    land(tmp_path, "c.json", "not json")
    result = unit_generation.transform(unit_generation.items(unit_generation.scan(spark, str(tmp_path))))
    assert rows(result.filter("issue is not null"), "issue") == [("broken_answer",), ("invalid_date",), ("no_items",)]
    good = unit_generation.accepted(result)
    assert good.columns[:-1] == unit_generation.TABLE.columns
    assert rows(good, "master_key", "area_code", "gen_method", "slot1", "slot2", "slot48", "total") == [
        ("20240501_10001_１号機", 1, "nuclear", 1, 0, 2, 3), ("20240502_10001_NA", None, "other_fire", 0, 0, 2, 3)]


def test_plant_operation(spark, tmp_path, rows):
    text = "発電所コード,エリア,発電所名,ユニット名,発電方式・燃種,対象日,00:30[kWh],01:00[kWh]\n1,東京,A,1号,水力,2025/04/01,10,x\n2,東京,B,1号,風力,2025/4/2,,30\n"
    land(tmp_path, "p.csv", text, "cp932")
    parsed = plant_operation.parse(plant_operation.scan(spark, str(tmp_path)), date(2025, 4, 3))
    assert rows(parsed, "plant_code", "area", "plant_type", "date", "processing_date") == [
        ("1", "東京", "水力", date(2025, 4, 1), date(2025, 4, 3)), ("2", "東京", "風力", date(2025, 4, 2), date(2025, 4, 3))]
    long = plant_operation.long_form(parsed).filter("output_kwh is not null")
    assert rows(long, "plant_code", "time", "output_kwh") == [("1", "00:30", 10.0), ("2", "01:00", 30.0)]


# --- weather ---------------------------------------------------------------------------

HOURLY = "\n".join([
    "ダウンロードした時刻", "", ",東京", "年月日時,気温(℃),気温(℃),風速(m/s),風速(m/s),全天日射量(MJ/㎡),天気,気温(℃)",
    ",,品質情報,,風向,,,", ",,品質,,,,,", "2023/1/1 1:00:00,5.1,8,2.0,東,0.5,晴,9", "2023/1/1 2:00:00,x,8,0.0,静穏,,曇,9",
    "2023/1/1 3:00,6,8,1.0,謎,,,9", "bad,1,1,1,北,1,1,1", "2023/1/1 1:00:00,99,8,2.0,北,0.5,晴,9",
])


def test_hourly_weather(spark, tmp_path, rows):
    land(tmp_path, "jma_weather_47662_202301.csv", HOURLY + "\n", "cp932")
    parsed = weather.parse(weather.scan(spark, str(tmp_path), "hourly"), "hourly")
    assert rows(weather.rejects(parsed), "issue") == [("invalid_datetime",), ("quality_row",)]
    good = weather.accepted(parsed)
    columns = ["primary_key", "time", "temperature", "wind_direction_sin", "wind_direction_cos", "global_solar_radiation",
               "weather_description", "precipitation"]
    assert rows(good.orderBy("line_no").limit(3), *columns) == [
        ("47662_202301010100", "01:00", 5.1, 1.0, 0.0, 0.5, "晴", None),
        ("47662_202301010200", "02:00", None, 0.0, 0.0, None, "曇", None),
        ("47662_202301010300", "03:00", 6.0, None, None, None, "", None)]


def test_hourly_weather_large_route(spark, tmp_path, rows, small_splits):
    land(tmp_path, "jma_weather_47662_202301.csv", HOURLY + "\n", "cp932")
    parsed = weather.parse(weather.scan(spark, str(tmp_path), "hourly", limit=10), "hourly")
    assert rows(weather.accepted(parsed), "time", "temperature") == [("01:00", 5.1), ("01:00", 99.0), ("02:00", None), ("03:00", 6.0)]


def test_daily_weather(spark, tmp_path, rows):
    text = "\n".join(["a", "b", "c", "年月日,平均気温(℃),合計全天日射量(MJ/㎡),降水量(mm),日照時間(時間)", ",,,,",
                      "2023/1/1,5.5,10.1,0.5,3", "2023/1/2 1:00,1,1,1,1"])
    land(tmp_path, "jma_weather_47412_daily.csv", text, "cp932")
    good = weather.accepted(weather.parse(weather.scan(spark, str(tmp_path), "daily"), "daily"))
    assert rows(good, "primary_key", "time", "temperature", "precipitation", "sunshine_duration", "wind_direction_sin") == [
        ("47412_202301010000", "00:00", 5.5, 0.5, 3.0, None)]


def test_weather_directory(spark, tmp_path, rows):
    names = weather_table.TABLE.columns
    full = ",".join(names)
    land(tmp_path, "jma_weather_b.csv", f"{full}\nk1,s,2023-01-01,00:00,9,,,,,,晴,\n")
    land(tmp_path, "jma_weather_a.csv", "﻿time,primary_key,temperature\n00:00,k1,--\n01:00,k2,#N/A\n02:00,,5\n")
    land(tmp_path, "jma_weather_c.csv", f"{full}\nk3,s,2023-01-01,00:00,warm,,,,,,晴,\nk4,s,2023-01-01,00:00,1,,,,,,晴,\n")
    land(tmp_path, "other.csv", f"{full}\nk5,s,2023-01-01,00:00,1,,,,,,晴,\n")
    loaded = weather_table.load(spark, str(tmp_path))
    assert loaded.columns == names
    assert rows(loaded, "primary_key", "time", "temperature", "weather_description") == [
        ("k1", "00:00", None, ""), ("k2", "01:00", None, "")]


# --- pass-through, store, export ---------------------------------------------------------


def test_intertie(spark, tmp_path):
    land(tmp_path / "in", "i.csv", "連系線,容量\n北本,900\n", "cp932")
    intertie.copy(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == ["連系線", "容量"] and [tuple(r) for r in back.collect()] == [("北本", "900")]
    land(tmp_path / "none", "i.csv", b"")
    intertie.copy(spark, str(tmp_path / "none"), str(tmp_path / "nothing"))
    assert spark.read.text(str(tmp_path / "nothing")).count() == 0


def test_payload_store(spark, tmp_path):
    land(tmp_path / "in", "spot_bid_curves_20240401.csv", BIDS, "cp932")
    scanned = files.scan_files(spark, str(tmp_path / "in"))
    for _ in range(2):
        files.store_payloads(scanned, str(tmp_path / "store"), F.lit("spot_bid_curves"), F.lit("2024-04-01").cast("date"))
    stored = spark.read.parquet(str(tmp_path / "store"))
    assert stored.count() == 2 and stored.select("id").distinct().count() == 2
    assert {r.date for r in stored.collect()} == {"20240401"}
    pieces = files.stored_pieces(stored)
    assert pieces.filter("not utf8").count() == 2


def test_weather_export(spark, tmp_path):
    df = spark.createDataFrame([("47662", "2024-01-02", 1.5), ("47412", "2024-02-03", None)], "station_id string, date string, t double")
    export.export_weather(df, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == 2
    assert (tmp_path / "csv" / "station=47662" / "month=202401").is_dir()
