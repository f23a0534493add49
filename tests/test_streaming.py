"""File-stream loads: new files only, repeatable, with a ledger."""

import json

from pyspark.sql import functions as F

from gridspark.operators import merge
from gridspark.schemas import TABLES
from gridspark.sources import area_supply, spot_price, unit_generation, weather_table
from gridspark.streaming.ingest import ingest_new_files
from gridspark.constants import PRICE_HEADER_CELL
from test_sources import SUPPLY_HEADER, archive, land, price_line, unit


def read_supply(spark, paths):
    return area_supply.parse(area_supply.scan(spark, paths))


def run(spark, tmp_path, checkpoint="checkpoint", **options):
    query = ingest_new_files(
        spark, str(tmp_path / "landing"), options.pop("read", read_supply), options.pop("table", TABLES["tso_area_data"]),
        str(tmp_path / "table"), str(tmp_path / "ledger"), str(tmp_path / checkpoint), **options,
    )
    query.awaitTermination()
    assert query.exception() is None


def test_new_files_are_loaded_once(spark, tmp_path, rows):
    landing, table = tmp_path / "landing", TABLES["tso_area_data"]
    land(landing, "tepco/a_202404.csv", f"t\n{SUPPLY_HEADER}\n2024/04/01,0:00,1,,,\nbad,0:00,1,,,\n")
    land(landing, "kansai/empty_202404.csv", f"t\n{SUPPLY_HEADER}\n")
    run(spark, tmp_path)
    land(landing, "chubu/b_2024.zip", archive(x__csv=f"t\n{SUPPLY_HEADER}\n2024/04/01,0:30,2,,,\n"))
    land(landing, "tepco/c_202404.csv", f"t\n{SUPPLY_HEADER}\n2024/04/01,0:00,9,,,\n2024/05/01,0:00,3,,,\n")
    run(spark, tmp_path)
    expected = [(3, "20240401_1", 1.0), (3, "20240501_1", 3.0), (4, "20240401_2", 2.0)]
    stored = merge.read_table(spark, str(tmp_path / "table"), table)
    assert rows(stored, "area_code", "master_key", "area_demand") == expected
    ledger = spark.read.parquet(str(tmp_path / "ledger"))
    assert rows(ledger, F.substring_index("path", "/", -1), "status", "rows", "flagged", "batch_id") == [
        ("a_202404.csv", "success", 1, 1, 0), ("b_2024.zip", "success", 1, 0, 1), ("c_202404.csv", "success", 2, 0, 1),
        ("empty_202404.csv", "failed: no rows", 0, 0, 0)]
    # A run without memory of earlier ones reads everything again and changes nothing.
    run(spark, tmp_path, checkpoint="fresh", files_per_batch=1)
    assert rows(merge.read_table(spark, str(tmp_path / "table"), table), "area_code", "master_key", "area_demand") == expected


def test_replacing_load(spark, tmp_path, rows):
    table = TABLES["occto_30min_generation"]

    def read(session, paths):
        items = unit_generation.items(unit_generation.scan(session, paths), ["path"])
        return unit_generation.transform(items, ["path"])

    for name, energy in (("a", "1"), ("b", "5")):
        land(tmp_path / "landing", f"{name}.json", json.dumps({"data": {"items": [unit("2024/05/01", htdnRslt0030=energy)]}}))
        run(spark, tmp_path, read=read, table=table, replace=True, order=["path"])
    stored = merge.read_table(spark, str(tmp_path / "table"), table)
    assert rows(stored, "master_key", "slot1") == [("20240501_10001_１号機", 5)]


def test_price_and_weather_loads(spark, tmp_path, rows):
    header = ",".join([PRICE_HEADER_CELL, *["x"] * 47])
    land(tmp_path / "landing", "spot.csv", "\n".join([header, price_line("2024/04/01", "1"), price_line("bad", "1")]) + "\n", "cp932")
    run(spark, tmp_path, read=lambda s, paths: spot_price.parse(spot_price.scan(s, paths)), table=TABLES["jepx_da_price"], replace=True)
    assert rows(merge.read_table(spark, str(tmp_path / "table"), TABLES["jepx_da_price"]), "date", "slot") == [("2024-04-01", 1)]
    ledger = spark.read.parquet(str(tmp_path / "ledger"))
    assert rows(ledger, "status", "rows", "flagged") == [("success", 1, 1)]

    other = tmp_path / "weather"
    land(other / "landing", "jma_weather_1.csv", "primary_key,date,temperature\nk1,2024-01-02,1.5\n,2024-01-02,2\nk2,--,3\n")
    land(other / "landing", "jma_weather_2.csv", "primary_key,date,temperature\nk3,2024-01-02,warm\n")
    for checkpoint in ("one", "two"):
        run(spark, other, checkpoint, read=lambda s, paths: weather_table.flagged(weather_table.parse(weather_table.scan(s, paths))), table=TABLES["jma_weather"])
        assert rows(merge.read_table(spark, str(other / "table"), TABLES["jma_weather"]), "primary_key", "temperature") == [("k1", 1.5), ("k2", 3.0)]
    outcomes = spark.read.parquet(str(other / "ledger"))
    assert rows(outcomes, "status", "rows", "flagged") == [("failed: no rows", 0, 1), ("success", 2, 1)]


def test_nothing_is_left_in_the_shared_folder(spark, tmp_path):
    from gridspark.session import shared_folder

    land(tmp_path / "landing", "tepco/a_202404.csv", f"t\n{SUPPLY_HEADER}\n2024/04/01,0:00,1,,,\n")
    run(spark, tmp_path)
    files = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    listed = files.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(files)
    assert not [x.getPath().getName() for x in listed if x.getPath().getName().startswith("ingest-")]
