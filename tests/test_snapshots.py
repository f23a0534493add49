"""Tables that change by whole commits."""

import random

import pytest
from pyspark.sql import functions as F

from gridspark.operators import merge, snapshots
from gridspark.operators.ledger import account
from gridspark.operators.snapshots import SnapshotTable
from gridspark.schemas import TABLES

TABLE = TABLES["tso_area_data"]
SCHEMA = "area_code int, master_key string, date string, slot int, area_demand double, n int"
COLUMNS = ("area_code", "master_key", "area_demand")


def batch(spark, *rows):
    """(area, month, key, value) rows; later ones count as later."""
    return spark.createDataFrame([(a, f"2024{m:02d}01_{k}" if k is not None else None, f"2024{m:02d}01", 1, float(v), i) for i, (a, m, k, v) in enumerate(rows)], SCHEMA)


def held(table, version=None):
    return sorted((r.area_code, r.master_key, r.area_demand) for r in table.read(version).collect())


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "table"), TABLE)


def test_every_version_can_be_read(spark, table):
    assert table.version() == 0 and held(table) == []
    first = table.insert(batch(spark, (1, 4, 1, 1), (1, 4, 1, 9), (2, 5, 1, 2), (1, 4, None, 3)), ["n"])
    assert (first.version, first.sent, first.keyless, first.written) == (1, 4, 1, 2)
    assert table.insert(batch(spark, (1, 4, 1, 7), (1, 4, 2, 3)), ["n"]).written == 1
    assert table.upsert(batch(spark, (1, 4, 1, 8), (1, 4, 3, 5), (1, 4, 3, 6)), ["n"]).version == 3
    one, two = [(1, "20240401_1", 1.0), (2, "20240501_1", 2.0)], [(1, "20240401_1", 1.0), (1, "20240401_2", 3.0), (2, "20240501_1", 2.0)]
    three = [(1, "20240401_1", 8.0), (1, "20240401_2", 3.0), (1, "20240401_3", 6.0), (2, "20240501_1", 2.0)]
    assert [held(table, v) for v in (0, 1, 2, 3)] == [[], one, two, three] and held(table) == three


def test_repeated_and_empty_inserts_publish_nothing(spark, table):
    rows = batch(spark, (1, 4, 1, 1))
    assert table.insert(rows, ["n"]).version == 1
    again = table.insert(rows, ["n"])
    assert (again.version, again.sent, again.written) == (1, 1, 0) and table.version() == 1
    assert table.insert(rows.limit(0), ["n"]).written == 0 and table.version() == 1


def test_a_job_that_dies_between_two_partitions_changes_nothing(spark, table):
    table.insert(batch(spark, (1, 4, 1, 1), (2, 4, 1, 1)), ["n"])
    before = held(table)
    dying = F.when(F.col("area_code") == 2, F.raise_error(F.lit("lost")).cast("double")).otherwise(9.0)
    write = table.write

    def breaks(rows, folder, odd):
        # The staged batch is whole; the merge writes one partition and dies in the other.
        if "/data/" in folder:
            rows = rows.withColumn("area_demand", dying)
        return write(rows, folder, odd)

    table.write = breaks
    with pytest.raises(Exception, match="lost"):
        table.upsert(batch(spark, (1, 4, 1, 9), (2, 4, 1, 9)), ["n"])
    assert held(SnapshotTable(spark, table.path, TABLE)) == before and table.version() == 1


def test_a_writer_that_dies_before_the_log_changes_nothing(spark, table, monkeypatch):
    table.insert(batch(spark, (1, 4, 1, 1)), ["n"])
    before = held(table)

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(snapshots, "create_exclusively", dies)
    with pytest.raises(KeyboardInterrupt):
        table.upsert(batch(spark, (1, 4, 1, 9)), ["n"])
    monkeypatch.undo()
    assert held(table) == before
    assert table.upsert(batch(spark, (1, 4, 1, 5)), ["n"]).version == 2 and held(table) == [(1, "20240401_1", 5.0)]


def test_the_later_of_two_writers_merges_again(spark, table, monkeypatch):
    table.insert(batch(spark, (1, 4, 1, 1)), ["n"])
    other, create, raced = SnapshotTable(spark, table.path, TABLE), snapshots.create_exclusively, []

    def slower(*arguments):
        if not raced:
            raced.append(True)
            other.upsert(batch(spark, (1, 4, 1, 2), (1, 4, 2, 2)), ["n"])
        return create(*arguments)

    monkeypatch.setattr(snapshots, "create_exclusively", slower)
    assert table.upsert(batch(spark, (1, 4, 2, 3), (1, 4, 3, 3)), ["n"]).version == 3
    assert held(table) == [(1, "20240401_1", 2.0), (1, "20240401_2", 3.0), (1, "20240401_3", 3.0)]


def test_partitions_are_replaced_even_by_nothing(spark, table):
    table.insert(batch(spark, (1, 4, 1, 1), (1, 5, 1, 2), (2, 4, 1, 3)), ["n"])
    partitions = spark.createDataFrame([(1, "202404"), (2, "202404"), (7, "202404")], "area_code int, month string")
    table.replace(batch(spark, (1, 4, 9, 9), (3, 4, 1, 4)), partitions)
    assert held(table) == [(1, "20240401_9", 9.0), (1, "20240501_1", 2.0), (3, "20240401_1", 4.0)]


def test_columns_and_null_and_odd_partitions(spark, tmp_path, rows):
    table = SnapshotTable(spark, str(tmp_path / "t"), TABLES["jma_weather"])
    schema = "primary_key string, date string, temperature double, wind_speed double, n int"
    days = [None, "a=b+% xyz", "2024-01-05"]
    first = spark.createDataFrame([(f"k{i}", day, 1.0, 1.0, 0) for i, day in enumerate(days)], schema)
    for _ in range(2):
        table.insert(first, ["n"])
    assert table.version() == 1
    table.upsert(first.withColumns({"temperature": F.lit(5.0), "wind_speed": F.lit(5.0)}), ["n"], ["temperature"])
    assert rows(table.read(), "primary_key", "temperature", "wind_speed") == [(f"k{i}", 5.0, 1.0) for i in range(3)]
    table.replace(first.limit(0), spark.createDataFrame([(None,), (days[1][:6],)], "month string"))
    assert rows(table.read(), "primary_key") == [("k2",)]


def test_filters_change_nothing_but_what_is_read(spark, tmp_path):
    rng = random.Random(1)
    tables = [SnapshotTable(spark, str(tmp_path / str(on)), TABLE, on) for on in (True, False)]
    for _ in range(3):
        sent = [(rng.randint(1, 2), rng.randint(4, 5), rng.randint(1, 60), rng.randint(1, 9)) for _ in range(25)]
        commits = [t.insert(batch(spark, *sent), ["n"]) for t in tables]
        assert commits[0].written == commits[1].written
    assert held(tables[0]) == held(tables[1])


def test_unknown_keys_open_no_file(spark, table, monkeypatch):
    table.insert(batch(spark, *[(1, 4, k, 1) for k in range(400)]), ["n"])
    opened, rows_of = [], table.rows_of
    table.rows_of = lambda files: opened.append(files.count()) or rows_of(files)
    assert table.insert(batch(spark, (1, 4, 1000, 1), (1, 4, 1001, 1)), ["n"]).written == 2
    assert opened == [0]
    assert table.insert(batch(spark, (1, 4, 5, 7), (1, 4, 1001, 7), (1, 4, 1002, 1)), ["n"]).written == 1
    assert opened[1] > 0 and table.read().count() == 403


def test_filters_pass_few_unknown_keys(spark, table):
    table.insert(batch(spark, *[(1, 4, k, 1) for k in range(3000)]), ["n"])
    filters = spark.read.parquet(f"{table.path}/filters/*")
    assert filters.count() > 1
    staged = merge.stored_form(batch(spark, *[(1, 4, k, 1) for k in range(5000, 5030)]), TABLE, ["n"])
    assert table.maybe_known(staged, table.manifest(1)).count() == 0


def test_vacuum_keeps_the_versions_asked_for(spark, table):
    for value in range(1, 5):
        table.upsert(batch(spark, (1, 4, 1, value)), ["n"])
    assert table.vacuum(2) == 2
    assert held(table, 3) == [(1, "20240401_1", 3.0)] and held(table) == [(1, "20240401_1", 4.0)]
    assert table.vacuum(2) == 0


def test_the_batch_is_evaluated_once(spark, tmp_path):
    for name, write in (("snapshot", lambda df, p: SnapshotTable(spark, p, TABLE).upsert(df, ["n"])), ("snapshot insert", lambda df, p: SnapshotTable(spark, p, TABLE).insert(df, ["n"])),
                        ("insert", lambda df, p: merge.insert_into(spark, df, p, TABLE, ["n"])), ("upsert", lambda df, p: merge.upsert_into(spark, df, p, TABLE, ["n"]))):
        seen = spark.sparkContext.accumulator(0)

        def touch(parts):
            for part in parts:
                seen.add(len(part))
                yield part

        source = batch(spark, *[(1, 4, k, 1) for k in range(20)])
        write(source.mapInPandas(touch, source.schema), str(tmp_path / name))
        assert seen.value == 20, name


def test_one_pass_splits_and_counts(spark, tmp_path):
    issues = [None] * 5 + ["slot_out_of_range"] * 2 + ["invalid_date"] * 3 + ["broken_entry", "no_header"]
    parsed = spark.createDataFrame([(f"f{i}", issue) for i, issue in enumerate(issues)], "path string, issue string")
    got = account(parsed, str(tmp_path / "a"), ("slot_out_of_range",))
    assert got.counts == {"accepted": 7, "rejected": 3, "unread": 2} and got.sent == len(issues)
    assert (got.accepted.count(), got.rejected.count(), got.unread.count()) == (7, 3, 2) and got.accepted.columns == parsed.columns
    empty = account(parsed.limit(0), str(tmp_path / "b"))
    assert empty.sent == 0 and empty.accepted.count() == 0
