"""Archives read by seeking, entry by entry, and what becomes of the ones that cannot be read."""

import io
import resource
import zipfile

import pytest
from pyspark.sql import functions as F

from gridspark.constants import PRICE_HEADER_CELL
from gridspark.operators import merge
from gridspark.operators.ledger import file_outcomes
from gridspark.schemas import TABLES
from gridspark.sources import archives, area_supply, bid_stack, files, plant_operation, spot_price, weather, weather_table
from gridspark.sources.archives import HeadRule
from gridspark.streaming.ingest import ingest_new_files
from test_sources import SUPPLY_HEADER, archive, land, price_line


def damaged(content: bytes, entry: str) -> bytes:
    """The archive with bytes of one entry's data overwritten."""
    info = zipfile.ZipFile(io.BytesIO(content)).getinfo(entry)
    begin = info.header_offset + 30 + len(entry) + 4
    return content[:begin] + bytes(min(20, info.compress_size - 8)) + content[begin + min(20, info.compress_size - 8):]


def supply(day, count=1):
    lines = "\n".join(f"2024/04/{day:02d},{n % 24}:00,{n},,," for n in range(count))
    return f"t\n{SUPPLY_HEADER}\n{lines}\n"


def listed(spark, root):
    return files.named_files(spark, str(root), files.has_archive_name)


def test_directory_names_every_entry_and_what_is_no_archive(spark, tmp_path, rows):
    land(tmp_path, "a.zip", archive(a__csv="x\n1\n", b__CSV="x\n2\n", notes__txt="no"))
    land(tmp_path, "b.zip", b"PK\x03\x04 cut off")
    land(tmp_path, "d.zip", archive(notes__txt="no"))
    found = archives.directory(listed(spark, tmp_path))
    assert rows(found, F.substring_index("path", "/", -1), "entry", "place", "issue") == [
        ("a.zip", "a.csv", 0, None), ("a.zip", "b.CSV", 1, None), ("b.zip", None, -1, "broken_archive")]


@pytest.mark.parametrize("piece_bytes", [1, 300, 1 << 22])
@pytest.mark.parametrize("rule", [None, HeadRule(nth=2), HeadRule(first_cell="DATE")])
def test_seeking_and_whole_archives_give_the_same_pieces(spark, tmp_path, rows, piece_bytes, rule):
    good = archive(a__csv=supply(1, 40), b__csv=supply(2, 40).encode("cp932"), empty__csv="", blank__csv="\n\n", c__csv="no header here\n" * 9)
    land(tmp_path, "good.zip", good)
    land(tmp_path, "half.zip", damaged(good, "a.csv"))
    land(tmp_path, "none.zip", b"none")
    by_seek = files.archive_pieces(listed(spark, tmp_path), piece_bytes, rule)
    whole = files.archive_pieces(files.scan_files(spark, str(tmp_path)), piece_bytes, rule)
    columns = [F.substring_index("path", "/", -1), "seg", "head", "utf8", "content", "issue"]
    assert rows(by_seek, *columns) == rows(whole, *columns)
    issues = rows(archives.file_rejects(by_seek), F.substring_index("path", "/", -1), "issue")
    headless = [(f"{x}.zip!{y}.csv", "no_header") for x in ("good", "half") for y in ("blank", "c", "empty")] if rule and rule.first_cell else []
    assert issues == sorted([("half.zip!a.csv", "broken_entry"), ("none.zip", "broken_archive"), *headless])


def test_a_broken_entry_is_one_reject_and_the_others_load(spark, tmp_path, rows):
    content = archive(a__csv=supply(1, 24), b__csv=supply(2, 24), c__csv=supply(3, 24))
    land(tmp_path, "chubu/e_2024.zip", damaged(content, "b.csv"))
    parsed = area_supply.parse(area_supply.scan(spark, str(tmp_path)))
    assert area_supply.accepted(parsed).count() == 48
    assert rows(area_supply.rejects(parsed), "area_code", F.substring_index("path", "/", -1), "line", "issue") == [
        (4, "e_2024.zip!b.csv", None, "broken_entry")]


def test_stored_and_other_packings(spark, tmp_path):
    for name, kind in (("stored", zipfile.ZIP_STORED), ("bz2", zipfile.ZIP_BZIP2), ("lzma", zipfile.ZIP_LZMA)):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", kind) as target:
            target.writestr("a.csv", supply(1, 24))
        land(tmp_path, f"chubu/{name}_2024.zip", buffer.getvalue())
    assert area_supply.accepted(area_supply.parse(area_supply.scan(spark, str(tmp_path)))).count() == 72


def test_entries_are_spread_over_tasks(spark, tmp_path):
    land(tmp_path, "chubu/many_2024.zip", archive(**{f"e{n}__csv": supply(1) for n in range(60)}))
    pieces = files.archive_pieces(listed(spark, tmp_path)).withColumn("task", F.spark_partition_id())
    assert pieces.count() == 60 and pieces.select("task").distinct().count() > 4


def test_a_large_entry_is_inflated_as_a_stream(tmp_path):
    """300 MB of lines in an archive of 1 MB: the reader's own memory stays far below the entry."""
    line = ("2024/04/01,00:00," + "1" * 1000 + "\n").encode()
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as target, target.open("a.csv", "w") as entry:
        for _ in range(300):
            entry.write(line * 1024)
    entries, pieces = archives.archive_reader(4 << 20, HeadRule(nth=1))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    with zipfile.ZipFile(tmp_path / "big.zip") as opened:
        size = sum(len(piece[4]) for _, info in entries(opened) for piece in pieces(opened, info))
    assert size == 300 * 1024 * len(line)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 60 * 1024


def test_price_files_without_a_header_are_rejects_on_every_route(spark, tmp_path, rows, small_splits):
    header = ",".join([PRICE_HEADER_CELL, *["x"] * 47])
    land(tmp_path, "good.csv", "\n".join([header, price_line("2024/04/01", "1")]) + "\n", "cp932")
    land(tmp_path, "bare.csv", "\n".join([price_line("2024/04/01", "2")] * 5) + "\n", "cp932")
    land(tmp_path, "blank.csv", "\n\n")
    land(tmp_path, "a.zip", archive(
        bare__csv=price_line("2024/04/02", "1") + "\n", good__csv="\n".join([header, price_line("2024/04/03", "1")]).encode("cp932")))
    for limit in (1 << 20, 10):
        parsed = spot_price.parse(spot_price.scan(spark, str(tmp_path), limit))
        assert spot_price.accepted(parsed).count() == 2
        assert rows(parsed.filter("issue IS NOT NULL"), F.substring_index("path", "/", -1), "line", "issue") == [
            ("a.zip!bare.csv", None, "no_header"), ("bare.csv", None, "no_header"), ("blank.csv", None, "no_header")]


@pytest.mark.parametrize("parser", ["prices", "bids", "weather", "weather_table", "plants"])
def test_every_parser_passes_unreadable_files_on(spark, tmp_path, rows, parser):
    from datetime import date

    land(tmp_path, "jma_weather_47662.zip", b"nothing")
    path = str(tmp_path / "jma_weather_47662.zip")
    parsed = {
        "prices": lambda: spot_price.parse(spot_price.scan(spark, path)),
        "bids": lambda: bid_stack.parse(bid_stack.scan(spark, path)),
        "weather": lambda: weather.parse(weather.scan(spark, path, "hourly"), "hourly"),
        "weather_table": lambda: weather_table.rejects(weather_table.parse(weather_table.scan(spark, [path]))),
        "plants": lambda: plant_operation.parse(plant_operation.scan(spark, path), date(2025, 1, 1)),
    }[parser]()
    assert rows(parsed, "issue") == [("broken_archive",)]


def test_weather_directory_rejects_name_bad_files_and_lines(spark, tmp_path, rows):
    land(tmp_path, "jma_weather_1.csv", "primary_key,date,temperature\nk1,2024-01-02,1.5\n,2024-01-02,2\n")
    land(tmp_path, "jma_weather_2.csv", "primary_key,date,temperature\nk3,2024-01-02,warm\nk4,2024-01-02,1\n")
    parsed = weather_table.parse(weather_table.scan(spark, str(tmp_path)))
    assert rows(weather_table.rejects(parsed), F.substring_index("path", "/", -1), "issue") == [
        ("jma_weather_1.csv", "missing_key"), ("jma_weather_2.csv", "text_in_number_column"), ("jma_weather_2.csv", "text_in_number_column")]
    assert weather_table.load(spark, str(tmp_path)).count() == 1


def test_the_ledger_knows_what_was_lost(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    land(landing, "chubu/e_2024.zip", damaged(archive(a__csv=supply(1, 24), b__csv=supply(2, 24)), "b.csv"))
    land(landing, "chubu/f_2024.zip", b"nothing")
    land(landing, "tepco/g_202404.csv", supply(3))
    ingest_new_files(
        spark, str(landing), lambda s, paths: area_supply.parse(area_supply.scan(s, paths)), TABLES["tso_area_data"],
        str(tmp_path / "table"), str(tmp_path / "ledger"), str(tmp_path / "checkpoint")).awaitTermination()
    outcome = rows(spark.read.parquet(str(tmp_path / "ledger")), F.substring_index("path", "/", -1), "status", "rows", "flagged", "unread")
    assert outcome == [("e_2024.zip", "partial: broken_entry", 24, 0, 1), ("f_2024.zip", "failed: broken_archive", 0, 0, 1), ("g_202404.csv", "success", 1, 0, 0)]
    assert merge.read_table(spark, str(tmp_path / "table"), TABLES["tso_area_data"]).count() == 25


def test_outcomes_count_every_row_once(spark):
    parsed = spark.createDataFrame([("a", None), ("a", "invalid_date"), ("b!x", "broken_entry"), ("b!y", None)], "path string, issue string")
    files_ = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    assert sorted(map(tuple, file_outcomes(files_, parsed).collect())) == [
        ("a", "success", 1, 1, 0), ("b", "partial: broken_entry", 1, 0, 1), ("c", "failed: no rows", 0, 0, 0)]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_line_numbers_are_the_lines_of_the_file_on_every_route(spark, tmp_path, small_splits, end):
    days = [f"2024/04/{n % 28 + 1:02d},{n % 24}:00,{n},,," for n in range(300)]
    text = end.join(["表題", "", SUPPLY_HEADER, *days]) + end
    land(tmp_path, "tepco/plain_202404.csv", text, "cp932")
    land(tmp_path, "chubu/packed_2024.zip", archive(a__csv=text.encode("cp932")))
    for limit, piece_bytes in ((1 << 20, 500), (10, 1 << 20)):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(files, "archive_pieces", lambda found, rule=None: archives.entry_pieces(found, 1, piece_bytes, rule))
            parsed = area_supply.parse(area_supply.scan(spark, str(tmp_path), limit)).collect()
        assert sorted((r.area_code, r.line_no, r.area_demand) for r in parsed) == [(a, 3 + n, float(n)) for a in (3, 4) for n in range(300)]


def test_line_numbers_of_bid_files(spark, tmp_path, small_splits):
    lines = ["date,slot,price,sell,buy,area"] + [f"20240401,{n % 48 + 1},{n},1,1,1" for n in range(200)]
    land(tmp_path, "spot_bid_curves_1.csv", "\n".join(lines))
    for limit in (10, 1 << 20):
        steps = bid_stack.accepted(bid_stack.parse(bid_stack.scan(spark, str(tmp_path), limit))).collect()
        assert sorted((r.line_no, r.price) for r in steps) == [(n + 1, str(n)) for n in range(200)]
