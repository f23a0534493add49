"""Groups of a snapshot table replaced without moving what need not move."""

import os

import pytest

from gridspark.operators import snapshots
from gridspark.operators.snapshots import SnapshotTable
from gridspark.schemas import TABLES

SCHEMA = "id string, date string, slot int, area_code int, feed int, path string, seg long, part long, bid array<struct<price:string,sell_qty:string,buy_qty:string>>"


def batch(spark, *rows):
    """(id, month, feed, part, price) rows."""
    return spark.createDataFrame(
        [(i, f"2024{m:02d}01", 1, 1, feed, "f", 0, part, [(price, "1", "1")]) for i, m, feed, part, price in rows], SCHEMA).coalesce(1)


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"), TABLES["jepx_bid_segments"])


def held(table, version=None):
    return sorted(((r.id, r.feed, r.part, r.bid[0].price) for r in table.read(version).collect()), key=repr)


def files(table):
    return {(r.commit, r.folder, r.file) for r in table.manifest(table.version()).collect()}


def counted(table, monkeypatch):
    """Rows that each later write holds."""
    written, write = [], table.write
    monkeypatch.setattr(table, "write", lambda *a: written.append(write(*a)) or written[-1])
    return lambda: [w["sent"] for w in written]


def test_a_batch_that_counts_whole_is_written_once(spark, table, monkeypatch):
    written = counted(table, monkeypatch)
    done = table.replace_groups(batch(spark, ("a", 4, 0, 0, "1"), ("a", 4, 0, 1, "2"), ("b", 5, 0, 0, "3")), ["id"], "feed")
    assert (done.sent, done.written) == (3, 3) and written() == [3, 0]
    # Files that hold no replaced group stay as they are; in others only remaining rows are written again.
    before = files(table)
    done = table.replace_groups(batch(spark, ("a", 4, 1, 0, "4"), ("c", 4, 1, 0, "5")), ["id"], "feed")
    assert written()[2:] == [2, 0] and done.written == 2
    assert len(before & files(table)) == 1 and {f for _, f, _ in before & files(table)} == {"month=202405"}
    table.replace_groups(batch(spark, ("c", 4, 1, 0, "6")), ["id"], "feed")
    assert written()[4:] == [1, 1]
    assert held(table) == [("a", 1, 0, "4"), ("b", 0, 0, "3"), ("c", 1, 0, "6")]
    assert held(table, 1) == [("a", 0, 0, "1"), ("a", 0, 1, "2"), ("b", 0, 0, "3")]


def test_rows_that_do_not_count_are_left_out(spark, table):
    table.replace_groups(batch(spark, ("a", 4, 1, 0, "1"), ("b", 4, 0, 0, "2"), ("b", 4, None, 1, "9"), (None, 4, 0, 0, "3")), ["id"], "feed")
    assert held(table) == [("a", 1, 0, "1"), ("b", 0, 0, "2")]
    # An older feed, two feeds in one batch, and a group without one.
    table.replace_groups(batch(spark, ("a", 4, 0, 0, "4"), ("b", 4, 0, 0, "5"), ("b", 4, 1, 0, "6"), ("c", 4, None, 0, "7")), ["id"], "feed")
    expected = [("a", 1, 0, "1"), ("b", 1, 0, "6"), ("c", None, 0, "7")]
    assert held(table) == expected
    table.replace_groups(batch(spark, ("b", 4, None, 0, "8")), ["id"], "feed")
    assert held(table) == expected


def test_the_later_writer_keeps_its_staged_files(spark, table, monkeypatch):
    table.replace_groups(batch(spark, ("a", 4, 0, 0, "1")), ["id"], "feed")
    other, create, raced = SnapshotTable(spark, table.path, table.table), snapshots.create_exclusively, []

    def slower(*arguments):
        if not raced:
            raced.append(True)
            other.replace_groups(batch(spark, ("a", 4, 1, 0, "2"), ("d", 4, 1, 0, "2")), ["id"], "feed")
        return create(*arguments)

    monkeypatch.setattr(snapshots, "create_exclusively", slower)
    assert table.replace_groups(batch(spark, ("a", 4, 0, 0, "3"), ("b", 4, 0, 0, "3")), ["id"], "feed").version == 3
    assert held(table) == [("a", 1, 0, "2"), ("b", 0, 0, "3"), ("d", 1, 0, "2")]


def test_vacuum_removes_staged_files_that_no_version_names(spark, table):
    for price in "1234":
        table.replace_groups(batch(spark, ("a", 4, 0, 0, price)), ["id"], "feed")
    assert table.vacuum(1) == 3
    assert held(table) == [("a", 0, 0, "4")]
    assert {c for c, _, _ in files(table)} <= {name[2:] for name in os.listdir(f"{table.path}/data")} and len(os.listdir(f"{table.path}/data")) == 2
    table.replace_groups(batch(spark, ("b", 4, 0, 0, "5")), ["id"], "feed")
    assert table.vacuum(1) == 1 and held(table) == [("a", 0, 0, "4"), ("b", 0, 0, "5")]


def test_lines_of_bid_files_move_once_and_narrow(spark):
    """One exchange, of lines: no array is made before it and no column that others tell."""
    from gridspark.sources import bid_stack
    from test_plans import physical_plan

    lines = spark.createDataFrame([("landed/spot_bid_curves.csv", 0, 1, "20240401,1,5,10,20,1")], "path string, seg long, line_no long, line string")
    plan = physical_plan(bid_stack.segment_rows(bid_stack.parse(lines))).splitlines()
    at = [i for i, line in enumerate(plan) if "Exchange" in line]
    assert len(at) == 1 and not any("collect_list" in line for line in plan[at[0]:])
    moved = next(line for line in plan[at[0] + 1:] if "Project" in line)
    assert not any(f"{name}#" in moved.split("Project", 1)[1] for name in ("id", "feed", "part"))
