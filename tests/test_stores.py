"""Bid segments, sketches of stored parts, and header discovery."""

import pytest
from pyspark.sql import functions as F

from gridspark.operators import reports
from gridspark.operators.snapshots import SnapshotTable
from gridspark.schemas import TABLES
from gridspark.sources import bid_stack, files, intertie
from test_sources import archive, land


def parsed(spark, feed, rows):
    """rows of (slot, price) as lines of one file."""
    text = [(f"landed/{feed}.csv", 0, i, f"20240401,{slot},{price},10,20,1") for i, (slot, price) in enumerate(rows)]
    return bid_stack.parse(spark.createDataFrame(text, "path string, seg long, line_no long, line string"))


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "bids"), TABLES["jepx_bid_segments"], use_filters=False)


def stacks(table):
    out = {}
    for row in bid_stack.stored_steps(table.read()).orderBy("id", "path", "seg", "part", "at").collect():
        out.setdefault(row.id, []).append(row.price)
    return out


def test_a_later_feed_replaces_whole_stacks(spark, table):
    first, second = "spot_bid_curves", "spot_splitting_areas"
    bid_stack.store_segments(table, parsed(spark, first, [(1, 5), (1, 6), (1, 7), (2, 8)]))
    assert stacks(table) == {"20240401_1_1": ["5", "6", "7"], "20240401_2_1": ["8"]}
    bid_stack.store_segments(table, parsed(spark, second, [(1, 1), (3, 3)]))
    expected = {"20240401_1_1": ["1"], "20240401_2_1": ["8"], "20240401_3_1": ["3"]}
    assert stacks(table) == expected
    # The earlier feed again changes nothing where the later one is stored, nor does loading twice.
    bid_stack.store_segments(table, parsed(spark, first, [(1, 9), (2, 8)]))
    bid_stack.store_segments(table, parsed(spark, second, [(1, 1), (3, 3)]))
    assert stacks(table) == expected


def test_a_stack_of_many_segments_is_stored_replaced_and_read_in_order(spark, table):
    def steps(count, scale):
        line = F.concat_ws(",", F.lit("20240401"), F.lit("1"), (F.col("id") * scale).cast("string"), F.lit("1"), F.lit("2"), F.lit("1"))
        return bid_stack.parse(spark.range(count).select(
            F.lit("landed/spot_bid_curves.csv").alias("path"), F.lit(0).cast("long").alias("seg"), F.col("id").alias("line_no"), line.alias("line")))

    for count, scale in ((100_000, 1), (60_000, 3)):
        bid_stack.store_segments(table, steps(count, scale))
        stored = table.read()
        assert stored.agg(F.max(F.size("bid"))).first()[0] == bid_stack.SEGMENT_LINES
        first = bid_stack.first_and_size_of_segments(stored).first()
        assert (first.first_price, first.points) == ("0", count)
        prices = [int(row.price) for row in bid_stack.in_order(stored, "20240401_1_1").select("price").toLocalIterator()]
        assert prices == [scale * n for n in range(count)]


def test_sketches_of_parts_merge_to_the_profile(spark):
    rows = [(n % 5, n % 7 if n % 11 else None, n, "x", None) for n in range(20_000)]
    df = spark.createDataFrame(rows, "part int, few int, many int, one string, none string")
    columns = ["few", "many", "one", "none"]
    parts = [reports.sketches(df.filter(F.col("part") == part), columns, ["part"]) for part in range(5)]
    stored = parts[0]
    for part in parts[1:]:
        stored = stored.unionByName(part)
    got = {r["column"]: r for r in reports.profile_of_sketches(stored).collect()}
    exact = {r["column"]: r for r in reports.profile(df, columns).collect()}
    assert {c: (got[c].rows, got[c].nulls, got[c]["values"]) for c in columns} == {c: (20_000, exact[c].nulls, exact[c]["values"]) for c in columns}
    assert all(abs(got[c].distinct_values - exact[c].distinct_values) <= 0.02 * exact[c].distinct_values for c in columns)


def test_layouts_are_found_from_first_lines_alone(spark, tmp_path, monkeypatch):
    body = "x,1\n" * 2000
    land(tmp_path, "b.csv", "連系線,容量\r\n" + body, "cp932")
    land(tmp_path, "a.csv", "容量,備考\n" + body, "cp932")
    land(tmp_path, "c.zip", archive(x__csv=("備考,新\n" + body).encode("cp932"), y__csv=("連系線,容量\n" + body).encode("cp932")))
    land(tmp_path, "d.bin", archive(z__csv=("別,名\n" + body).encode("cp932")))
    land(tmp_path, "e.zip", b"nothing")
    expected = [["容量", "備考"], ["連系線", "容量"], ["備考", "新"], ["別", "名"]]
    assert intertie.layouts(spark, str(tmp_path)) == expected
    read = intertie.read(spark, str(tmp_path))
    assert read.columns == ["容量", "備考", "連系線", "新", "別", "名"] and read.count() == 5 * 2000
    monkeypatch.setattr(intertie, "can_seek", lambda *_: False)
    monkeypatch.setattr(files, "can_seek", lambda *_: False)
    assert intertie.layouts(spark, str(tmp_path)) == expected


SCHEMA = "k int, j string, v double, n int"


def rows_of(df):
    return sorted(map(tuple, df.select("k", "j", "v").collect()))


def test_merges_do_not_move_a_bucketed_table(spark, tmp_path):
    import re

    from gridspark.operators.bucketed import BucketedTable
    from test_plans import physical_plan

    table = BucketedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ["k", "j"], 8)
    made = [(i, "x", float(i), 0) for i in range(200)]
    assert table.insert(spark.createDataFrame(made + made[:9], SCHEMA), ["n"]) == 1
    batch = spark.createDataFrame([(i, "x", -1.0, i) for i in range(190, 210)] + [(5, "y", 5.0, 0), (5, "y", 6.0, 1), (None, "z", 0.0, 0)], SCHEMA)
    for merged in (table.upserted(batch, ["n"]), table.inserted(batch, ["n"])):
        plan = physical_plan(merged)
        # Every shuffle and broadcast stands above the batch; the table is read where it lies.
        scans = [i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line]
        assert scans and "Broadcast" not in plan
        lines = plan.splitlines()
        for at in scans:
            depth = [re.search(r"[A-Z]", line).start() if re.search(r"[A-Z]", line) else 0 for line in lines]
            above, level = [], depth[at]
            for i in range(at - 1, -1, -1):
                if depth[i] < level:
                    above.append(lines[i])
                    level = depth[i]
            assert not any("Exchange" in line for line in above), above
    assert table.upsert(batch, ["n"]) == 2
    expected = {(i, "x"): float(i) for i in range(200)} | {(i, "x"): -1.0 for i in range(190, 210)} | {(5, "y"): 6.0}
    assert rows_of(table.read()) == sorted((k, j, v) for (k, j), v in expected.items())
    assert rows_of(table.read(1)) == sorted((i, "x", float(i)) for i in range(200))
    assert table.insert(batch, ["n"]) == 3 and rows_of(table.read()) == rows_of(table.read(2))


def test_a_bucketed_version_belongs_to_one_writer(spark, tmp_path, monkeypatch):
    from gridspark.operators import bucketed

    table = bucketed.BucketedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema, ["k", "j"], 2)
    table.insert(spark.createDataFrame([(1, "x", 1.0, 0)], SCHEMA), ["n"])
    monkeypatch.setattr(table, "version", lambda: 0)
    with pytest.raises(RuntimeError, match="another writer"):
        table.commit(spark.createDataFrame([(2, "x", 1.0, 0)], SCHEMA))
    monkeypatch.undo()
    assert rows_of(table.read()) == [(1, "x", 1.0)]
