"""Versions of a month's file that land one after the other, and the choice among landed ones."""

import pytest
from pyspark.sql import functions as F

from gridspark.operators.snapshots import SnapshotTable
from gridspark.schemas import TABLES
from gridspark.sources import area_supply, files
from gridspark.streaming.versions import ingest_versions
from test_sources import SUPPLY_HEADER, archive, land


def supply(value, *days, month="04"):
    lines = "".join(f"2024/{month}/{day:02d},0:00,{value},,,\n" for day in days)
    return f"t\n{SUPPLY_HEADER}\n{lines}"


@pytest.fixture
def run(spark, tmp_path):
    """One run of the stream; each call is a restart from what the last one left."""

    def go(checkpoint="checkpoint", **options):
        query = ingest_versions(spark, str(tmp_path / "landing"), str(tmp_path / "table"), str(tmp_path / "ledger"), str(tmp_path / checkpoint), 2024, **options)
        query.awaitTermination()
        assert query.exception() is None
        table = SnapshotTable(spark, str(tmp_path / "table"), TABLES["tso_area_data"]).read()
        return sorted((r.area_code, r.master_key, r.area_demand) for r in table.collect())

    return go


def test_a_better_version_takes_the_place_of_a_worse_one(spark, tmp_path, run, rows):
    landing = tmp_path / "landing"
    land(landing, "tepco/eria_202404_03.csv", supply(3, 1, 2, 30) + "2024/05/01,0:00,33,,,\n")
    land(landing, "chubu/eria_202404_03.csv", supply(7, 1))
    chubu = (4, "20240401_1", 7.0)
    assert run() == sorted([(3, "20240401_1", 3.0), (3, "20240402_1", 3.0), (3, "20240430_1", 3.0), (3, "20240501_1", 33.0), chubu])
    # The better version lacks a day, and the row beyond its month: both go.
    land(landing, "tepco/eria_202404_02.csv", supply(2, 1, 2))
    assert run() == sorted([(3, "20240401_1", 2.0), (3, "20240402_1", 2.0), chubu])
    # A worse one changes nothing, nor does an archive that repeats known keys; its new keys load.
    land(landing, "tepco/eria_202404_05.csv", supply(5, 1, 9))
    land(landing, "tepco/eria_2024.zip", archive(a__csv=supply(8, 1, 20)))
    assert run() == sorted([(3, "20240401_1", 2.0), (3, "20240402_1", 2.0), (3, "20240420_1", 8.0), chubu])
    # The best one lands last: the archive's rows of that month stay where it has none.
    land(landing, "tepco/eria_202404_01.csv", supply(1, 2))
    assert run() == sorted([(3, "20240401_1", 8.0), (3, "20240402_1", 1.0), (3, "20240420_1", 8.0), chubu])
    ledger = spark.read.parquet(str(tmp_path / "ledger")).filter("area_code = 3")
    name, replaced = (F.substring_index(column, "/", -1) for column in ("path", "replaced"))
    assert rows(ledger, name, "action", replaced) == [
        ("eria_2024.zip", "loaded", None), ("eria_202404_01.csv", "loaded", "eria_202404_02.csv"), ("eria_202404_02.csv", "loaded", "eria_202404_03.csv"),
        ("eria_202404_03.csv", "loaded", None), ("eria_202404_05.csv", "superseded", None)]


def test_versions_that_land_together_and_files_that_compete_with_none(spark, tmp_path, run):
    landing = tmp_path / "landing"
    for version in ("03", "02", "04"):
        land(landing, f"tepco/eria_202404_{version}.csv", supply(int(version), int(version)))
    land(landing, "tepco/other.csv", supply(9, 9, month="06"))
    land(landing, "tepco/eria_2025.csv", supply(5, 5, month="07"))
    expected = [(3, "20240402_1", 2.0), (3, "20240609_1", 9.0)]
    assert run() == expected
    assert run(checkpoint="forgotten", files_per_batch=3) == expected


def test_choice_is_on_unless_switched_off(spark, tmp_path, rows):
    for version in ("02", "03"):
        land(tmp_path, f"tepco/eria_202404_{version}.csv", supply(int(version), int(version)))
    assert rows(area_supply.load(spark, str(tmp_path)), "master_key") == [("20240402_1",)]
    assert rows(area_supply.load(spark, str(tmp_path), every_version=True), "master_key") == [("20240402_1",), ("20240403_1",)]


@pytest.mark.parametrize("by_name", [0, 1000])
@pytest.mark.parametrize("limit", [10, 1 << 20])
def test_both_ways_to_leave_files_out_agree(spark, tmp_path, monkeypatch, rows, by_name, limit):
    monkeypatch.setattr(files, "SKIPPED_BY_NAME", by_name)
    for version in ("02", "03"):
        land(tmp_path, f"tepco/a b%[{version}]_202404_{version}.csv", supply(int(version), int(version)))
        land(tmp_path, f"chubu/é_202404_{version}.csv", supply(int(version), int(version)))
    assert rows(area_supply.load(spark, str(tmp_path), limit), "area_code", "master_key") == [(3, "20240402_1"), (4, "20240402_1")]


def test_files_left_out_are_not_opened(spark, tmp_path):
    for version in range(2, 12):
        land(tmp_path, f"tepco/eria_202404_{version:02d}.csv", supply(version, version))
    lines = area_supply.scan(spark, str(tmp_path))
    assert lines.select("path").distinct().count() == 1
    skipped = files.Skipped(files.listing(spark, str(tmp_path)).filter("NOT path LIKE '%_02.csv'"))
    kept = files.scan_files(spark, str(tmp_path), skipped=skipped)
    assert kept.count() == 1 and len(skipped.names) == 9
    assert kept.rdd.getNumPartitions() == 1
