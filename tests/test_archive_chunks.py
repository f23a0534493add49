"""Archives that go to workers and come from them in chunks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from gridspark.plans import landing
from gridspark.sources import archives, files
from test_sources import archive

SIZES = (0, 1, 4096, 4097, 300_000)


def text(n, size):
    """Bytes that hardly pack."""
    return b"".join(b"%x\n" % (hash((n, i)) & (1 << 60) - 1) for i in range(size // 15 + 1))[:size]


def entries(spark, count=3):
    rows = [(f"landed/{n}.zip", f"e{size}.csv", text(n, size)) for n in range(count) for size in SIZES]
    return spark.createDataFrame(rows, "path string, entry string, content binary").repartition(5)


@pytest.mark.parametrize("spool", [100, 1 << 23])
def test_archives_hold_every_byte_of_their_entries(spark, monkeypatch, spool):
    monkeypatch.setattr(archives, "SPOOL_BYTES", spool)
    monkeypatch.setattr(landing, "SPOOL_BYTES", spool)
    pieces = files.archive_pieces(landing.zipped(entries(spark)).coalesce(1), 50_000).collect()
    got = {}
    for piece in sorted(pieces, key=lambda p: (p.path, p.seg)):
        got[piece.path] = got.get(piece.path, b"") + piece.content
    assert got == {f"{r.path}!{r.entry}": bytes(r.content) for r in entries(spark).collect() if r.content}


def test_unreadable_contents_are_one_reject_each(spark, rows):
    good = archive(a__csv="x\n" * 5000)
    found = spark.createDataFrame([("a", good), ("b", good[:40]), ("c", b""), ("d", None), ("e", good)], "path string, content binary").coalesce(1)
    pieces = files.archive_pieces(found)
    assert rows(pieces, "path", F.length("content"), "issue") == [
        ("a!a.csv", 10000, None), ("b", None, "broken_archive"), ("c", None, "broken_archive"), ("d", None, "broken_archive"), ("e!a.csv", 10000, None)]


def test_no_row_that_reaches_a_worker_grows_with_an_archive(spark, monkeypatch):
    sent = []
    for name in ("mapInArrow", "mapInPandas"):
        real = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name, lambda self, *a, real=real, **k: sent.append(self) or real(self, *a, **k))
    assert files.archive_pieces(landing.zipped(entries(spark))).count() == 12
    widest = [df.agg(F.max(F.length(F.to_json(F.struct("*"))))).first()[0] for df in sent]
    assert len(widest) == 2 and max(widest) < 2 * archives.CHUNK_BYTES
