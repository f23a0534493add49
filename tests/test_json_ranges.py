"""JSON answers of any size, read in byte ranges."""

import json
import random

import pytest
from pyspark.sql import functions as F

from gridspark.sources import files, json_ranges, unit_generation
from test_sources import land, unit

NASTY = ['plain', 'quo"te', 'back\\', 'two\\\\', '\\"', '}{][', '","items":[{', '発電所', '😀', 'tab\t', '', 'a' * 60]


def answer(rng, count, **more):
    items = [{rng.choice(NASTY) + str(k): rng.choice([*NASTY, 7, None, True, {"x": [1, {"y": "]"}]}, [1, [2]]]) for k in range(rng.randint(0, 4))}
             for _ in range(count)]
    return {"meta": {"items": [{"no": 1}], "data": {"items": [{"no": 2}]}}, "data": {"page": [[1], {"items": [{"no": 3}]}], "items": items, "next": "}"}, **more}


def elements(spark, path, range_bytes):
    listed = files.named_files(spark, path, lambda name: F.lit(True))
    found = json_ranges.array_elements(listed, range_bytes=range_bytes)
    out = found.orderBy("path", "at").collect()
    return [(row.path.rsplit("/", 1)[1], None if row.element is None else json.loads(row.element), row.issue) for row in out]


@pytest.mark.parametrize("seed,range_bytes,count", [(1, 1, 3), (2, 7, 12), (3, 64, 40), (4, 1000, 200), (5, 65536, 200)])
@pytest.mark.parametrize("style", [{}, {"ensure_ascii": False, "indent": 3}, {"separators": (",", ":")}])
def test_elements_are_the_same_at_every_range_size(spark, tmp_path, seed, range_bytes, count, style):
    made = answer(random.Random(seed), count)
    path = land(tmp_path, "a.json", json.dumps(made, **style))
    assert elements(spark, path, range_bytes) == [("a.json", item, None) for item in made["data"]["items"]]


def test_what_has_no_items_says_why(spark, tmp_path):
    for name, text in (("a", '{"data":{"items":[]}}'), ("b", '{"data":{"other":[{}]}}'), ("c", '{"data":{"items":[{"x":1}'), ("d", '[{"x":1}]'),
                       ("e", '{"data":{"items":[{"x":"open}]}}'), ("f", '{"items":[{"x":1}],"data":[]}'), ("g", '{"data":{"items":[1,null,"x",[{"y":1}]]}}')):
        land(tmp_path, f"{name}.json", text)
    land(tmp_path, "h.json", '{"data":{"items":[{"x":"発電所"}]}}', "cp932")
    land(tmp_path, "i.json", '{"data":{"items":[{"x":"発電所"}]}}')
    expected = {"c": "broken_answer", "e": "broken_answer", "h": "not_utf8", "i": None}
    for range_bytes in (3, 4096):
        got = elements(spark, str(tmp_path), range_bytes)
        assert [(name, issue) for name, _, issue in got] == [(f"{x}.json", expected.get(x, "no_items")) for x in "abcdefghi"]
        assert got[-1][1] == {"x": "発電所"}


def test_large_and_small_answers_give_the_same_rows(spark, tmp_path, rows):
    for n in range(3):
        made = {"data": {"items": [unit(f"2024/05/{d:02d}", unitNm=f"{n}号\\\"{d}") for d in range(1, 29)]}}
        land(tmp_path, f"{n}.json", json.dumps(made, ensure_ascii=n == 0))
    land(tmp_path, "none.json", '{"data":{"items":[]}}')
    land(tmp_path, "broken.json", '{"data":{"items":[')

    def read(**options):
        found = unit_generation.items(unit_generation.scan(spark, str(tmp_path), **options), ["path", "at"])
        return unit_generation.transform(found, ["path"])

    columns = [F.substring_index("path", "/", -1), "master_key", "slot1", "slot48", "total", "issue"]
    whole, split = rows(read(), *columns), rows(read(limit=3, range_bytes=500), *columns)
    assert whole == split and len(whole) == 86


def test_an_element_longer_than_many_ranges(spark, tmp_path):
    made = {"data": {"items": [{"x": "y" * 50_000, "z": ["\\" * 999, {"a": "}" * 5000}]}, {"x": 1}]}}
    path = land(tmp_path, "a.json", json.dumps(made))
    assert [x for _, x, _ in elements(spark, path, 300)] == made["data"]["items"]


def test_ranges_of_a_file_are_read_by_many_tasks(spark, tmp_path):
    path = land(tmp_path, "a.json", json.dumps({"data": {"items": [{"x": n} for n in range(5000)]}}))
    listed = files.named_files(spark, path, lambda name: F.lit(True))
    found = json_ranges.array_elements(listed, range_bytes=2000).withColumn("task", F.spark_partition_id())
    assert found.count() == 5000 and found.select("task").distinct().count() > 4
