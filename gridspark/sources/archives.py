"""ZIP archives read entry by entry.

The central directory at an archive's end is read by seeking; every entry is then a row of its own
and is inflated as a stream by whichever task it falls to. Neither archives nor entries are ever held
whole. What cannot be read is a piece with an `issue` instead of content: a file that is no archive,
or an entry that does not inflate, fails its checksum, is encrypted or lacks its header line.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from gridspark.sources.seek import dealt, opener

PIECE_BYTES = 4 * 1024 * 1024
# Rows go to workers by thousands: a batch of chunks is some tens of MB.
CHUNK_BYTES, SPOOL_BYTES = 4 * 1024, 8 * 1024 * 1024
PIECES = "path string, seg bigint, first_line bigint, head binary, utf8 boolean, content binary, issue string"
DIRECTORY = "path string, entry string, place int, bytes bigint, issue string"
BROKEN_ARCHIVE, BROKEN_ENTRY, NO_HEADER = "broken_archive", "broken_entry", "no_header"


@dataclass(frozen=True)
class HeadRule:
    """Where the header stands: the n-th line, or the first line with a given first cell."""

    nth: int | None = None
    skip_blank: bool = True
    first_cell: str | None = None


def archive_reader(piece_bytes: int, rule: HeadRule | None):
    """Functions over an open archive: its CSV entries, and the pieces of one of them."""
    nth, skip_blank = (rule.nth, rule.skip_blank) if rule else (None, True)
    marks = [rule.first_cell.encode(charset) for charset in ("utf-8", "cp932")] if rule and rule.first_cell else []
    bom, block = b"\xef\xbb\xbf", 1 << 20

    def lines_in(content):
        return content.count(b"\n") + content.count(b"\r") - content.count(b"\r\n")

    def entries(archive):
        return [(place, info) for place, info in enumerate(archive.infolist()) if info.filename.lower().endswith(".csv")]

    def verdict(archive, info):
        """Whether an entry is UTF-8; None if it cannot be read to its end."""
        import codecs
        import zipfile
        import zlib

        decoder, utf8 = codecs.getincrementaldecoder("utf-8")(), True
        try:
            with archive.open(info) as stream:
                while True:
                    part = stream.read(block)
                    if utf8:
                        try:
                            decoder.decode(part, not part)
                        except UnicodeDecodeError:
                            utf8 = False
                    if not part:
                        return utf8
        except (zipfile.BadZipFile, zlib.error, OSError, EOFError, NotImplementedError, RuntimeError, ValueError):
            return None

    def pieces(archive, info):
        utf8 = verdict(archive, info)
        if utf8 is None:
            yield 0, 0, None, None, None, BROKEN_ENTRY
            return
        head, found, counted = b"", not (nth or marks), 0
        seg, buffer, size, first = 0, [], 0, 0
        with archive.open(info) as stream:
            for number, line in enumerate(stream):
                buffer.append(line)
                size += len(line)
                ended = False
                if not found:
                    bare = line.removeprefix(bom) if number == 0 else line
                    if marks:
                        found = bare.split(b",", 1)[0].replace(b'"', b"").strip() in marks
                        head = line if found else head
                    elif not skip_blank or bare.strip():
                        head, counted = head + line, counted + 1
                        found = counted == nth
                    # Lines up to a late header are a piece without one; below it a new piece begins.
                    ended = found and seg > 0
                if ended or size >= piece_bytes:
                    content = b"".join(buffer)
                    yield seg, first, head if found and not ended else b"", utf8, content, None
                    seg, buffer, size, first = seg + 1, [], 0, first + lines_in(content)
        if buffer:
            yield seg, first, head if found else b"", utf8, b"".join(buffer), None
        if marks and not found:
            yield seg + 1, 0, None, None, None, NO_HEADER

    return entries, pieces




def directory(files: DataFrame) -> DataFrame:
    """One row per CSV entry of each archive in `path`, with its size when packed, or one row with
    the `issue` of a file that is no archive. Only the directories are read."""
    opened, (entries, _), schema = opener(), archive_reader(0, None), DIRECTORY

    def read(batches):
        import zipfile

        import pandas as pd

        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            rows = []
            for path in batch["path"]:
                with opened(path) as file:
                    try:
                        archive = zipfile.ZipFile(file)
                    except (zipfile.BadZipFile, OSError, ValueError, NotImplementedError):
                        rows.append((path, None, -1, 0, BROKEN_ARCHIVE))
                        continue
                    rows += [(path, info.filename, place, info.compress_size, None) for place, info in entries(archive)]
            yield pd.DataFrame(rows, columns=names)

    return files.select("path").mapInPandas(read, schema)


def entry_pieces(files: DataFrame, total_bytes: int, piece_bytes: int = PIECE_BYTES, rule: HeadRule | None = None) -> DataFrame:
    """Pieces of all CSV entries of the archives in `path`, each entry read by the task that has its row."""
    opened, (_, pieces), schema = opener(), archive_reader(piece_bytes, rule), PIECES

    def read(batches):
        import contextlib
        import zipfile

        import pandas as pd

        names = [x.split()[0] for x in schema.split(", ")]
        with contextlib.ExitStack() as stack:
            at, archive = None, None
            for batch in batches:
                for path, entry, place, issue in zip(batch["path"], batch["entry"], batch["place"], batch["issue"]):
                    if issue:
                        yield pd.DataFrame([(path, 0, 0, None, None, None, issue)], columns=names)
                        continue
                    if path != at:
                        stack.close()
                        at, archive = path, zipfile.ZipFile(stack.enter_context(opened(path)))
                    for piece in pieces(archive, archive.infolist()[place]):
                        yield pd.DataFrame([(f"{path}!{entry}", *piece)], columns=names)

    rows = dealt(directory(files), total_bytes, "path", "place").sortWithinPartitions("path", "place")
    return rows.mapInPandas(read, schema)


def entry_heads(files: DataFrame, count: int = 1) -> DataFrame:
    """`path` and the first lines of every CSV entry of the archives in `path`; entries that do not
    begin to inflate have none."""
    opened, (entries, _) = opener(), archive_reader(0, None)

    def read(batches):
        import zipfile
        import zlib

        import pandas as pd

        for batch in batches:
            rows = []
            for path in batch["path"]:
                with opened(path) as file:
                    try:
                        archive = zipfile.ZipFile(file)
                    except (zipfile.BadZipFile, OSError, ValueError, NotImplementedError):
                        continue
                    for _, info in entries(archive):
                        try:
                            with archive.open(info) as stream:
                                rows.append((f"{path}!{info.filename}", b"".join(stream.readline() for _ in range(count))))
                        except (zipfile.BadZipFile, zlib.error, OSError, EOFError, NotImplementedError, RuntimeError, ValueError):
                            continue
            yield pd.DataFrame(rows, columns=["path", "head"])

    return files.select("path").mapInPandas(read, "path string, head binary")


def in_chunks(files: DataFrame, *names: str) -> DataFrame:
    """`content` in rows of bounded size, which follow each other: the columns `names`, `at` from 0, and `part`.
    A file without bytes has one."""
    last = F.greatest(F.ceil(F.length("content") / CHUNK_BYTES), F.lit(1)).cast("int") - 1
    places = files.select(*names, "content", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    return places.select(*names, "at", F.substring("content", F.col("at") * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES)).alias("part"))


def content_pieces(files: DataFrame, piece_bytes: int = PIECE_BYTES, rule: HeadRule | None = None) -> DataFrame:
    """The same from archives whose bytes are at hand as `content`."""
    return chunk_pieces(in_chunks(files, "path"), piece_bytes, rule)


def chunk_pieces(chunks: DataFrame, piece_bytes: int = PIECE_BYTES, rule: HeadRule | None = None) -> DataFrame:
    """The same from archives in rows of `path`, `at` and `part`, one archive's after the other's.

    Workers get few bytes at a time; an archive larger than SPOOL_BYTES lies in a temporary file while it is read."""
    (entries, pieces), spool = archive_reader(piece_bytes, rule), SPOOL_BYTES

    def spooled(batches):
        import tempfile

        path = file = None
        for batch in batches:
            paths, places, parts = (batch.column(name) for name in ("path", "at", "part"))
            for i in range(batch.num_rows):
                if places[i].as_py() == 0:
                    if file is not None:
                        yield path, file
                        file.close()
                    path, file = paths[i].as_py(), tempfile.SpooledTemporaryFile(spool)
                if parts[i].is_valid:
                    file.write(parts[i].as_buffer())
        if file is not None:
            yield path, file
            file.close()

    def read(batches):
        import zipfile

        import pyarrow as pa

        schema = pa.schema([("path", pa.string()), ("seg", pa.int64()), ("first_line", pa.int64()), ("head", pa.binary()),
                            ("utf8", pa.bool_()), ("content", pa.binary()), ("issue", pa.string())])

        def row(*values):
            return pa.RecordBatch.from_arrays([pa.array([value], field.type) for value, field in zip(values, schema)], schema=schema)

        for path, file in spooled(batches):
            try:
                archive = zipfile.ZipFile(file)
            except (zipfile.BadZipFile, OSError, ValueError, NotImplementedError):
                yield row(path, 0, 0, None, None, None, BROKEN_ARCHIVE)
                continue
            for _, info in entries(archive):
                for piece in pieces(archive, info):
                    yield row(f"{path}!{info.filename}", *piece)

    return chunks.select("path", "at", "part").mapInArrow(read, PIECES)


def file_rejects(pieces: DataFrame) -> DataFrame:
    """`path`, of an archive or of an entry in it, and `issue` of what could not be read."""
    return pieces.filter(F.col("issue").isNotNull()).select("path", "issue")
