"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
import __spark_entry__


def test_stages_keep_the_columns_and_act_on_their_input(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    assert counts[0] > counts[1] > counts[2] >= counts[3] == counts[4]
    before = spark.read.parquet(str(tmp_path / "substring_dedup"))
    assert docs.select("doc_id").distinct().count() == before.count()


def test_stages_take_odd_rows_and_empty_tables(spark, table, stored):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(1, None), (2, ""), (None, "a b"), (None, None), (3, "x " * 30_000), (3, "x " * 30_000)]
    for made in (rows, []):
        docs = stored(table(made))
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf_dir))
        assert docs.select("doc_id").distinct().count() == (3 if made else 0)


def test_all_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))
    assert set(__spark_entry__.oracle_sql()) <= names
