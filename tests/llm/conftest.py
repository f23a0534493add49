import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with the operators' own."""

    def make(rows, **columns):
        full = [(i, text, "en", "src", len(text or ""), 1, "x", 2.5) for i, text in rows]
        schema = SCHEMA + ", row_no int, score string, region double"
        return spark.createDataFrame(full, schema).repartition(3) if columns.get("spread") else spark.createDataFrame(full, schema)

    return make


@pytest.fixture
def stored(tmp_path):
    """The same table as files, whose rows come in one order each time."""

    def store(df):
        path = str(tmp_path / f"t{len(list(tmp_path.iterdir()))}")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return store
