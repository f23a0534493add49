"""Landed files opened where a worker needs a part of them, instead of loaded as a whole.

Workers read local and object storage through pyarrow. Other file systems, which only the JVM
reads, are left to the binary file source. Readers are built inside functions, so that workers need
no copy of this package.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession, functions as F

# A worker handles about this much of the landed bytes at a time.
BYTES_PER_TASK = 128 * 1024 * 1024


def opener() -> Callable[[str], BinaryIO]:
    """Opens a landed path for reading at any place."""

    def opened(path: str) -> BinaryIO:
        scheme = path.split(":", 1)[0] if ":" in path.split("/", 1)[0] else "file"
        if scheme == "file":
            return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
        from pyarrow import fs

        system, place = fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))
        return system.open_input_file(place)

    return opened


def can_seek(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether workers can open these paths themselves, by their schemes."""
    known = {"file", "s3", "s3a", "gs", "abfs", "abfss"} | ({"hdfs"} if os.environ.get("HADOOP_HOME") else set())
    default = spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").split(":", 1)[0]
    paths = [path] if isinstance(path, str) else path
    return all((p.split(":", 1)[0] if ":" in p.split("/", 1)[0] else default) in known for p in paths)


def dealt(rows: DataFrame, total_bytes: int, *columns: str) -> DataFrame:
    """Rows that each stand for much work, spread over tasks by their number of bytes."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, -(-total_bytes // BYTES_PER_TASK)), *[F.col(name) for name in columns])


def first_lines(paths: DataFrame, count: int = 1) -> DataFrame:
    """`path` and the first lines of each file, undecoded, as `head`; the rest is not read."""
    opened = opener()

    def read(batches):
        import pandas as pd

        for batch in batches:
            heads = []
            for path in batch["path"]:
                with opened(path) as file:
                    heads.append(b"".join(file.readline() for _ in range(count)))
            yield pd.DataFrame({"path": batch["path"], "head": heads})

    return paths.select("path").mapInPandas(read, "path string, head binary")


def first_bytes(paths: DataFrame, count: int) -> DataFrame:
    """`path` and the first bytes of each file as `start`."""
    opened = opener()

    def read(batches):
        import pandas as pd

        for batch in batches:
            starts = []
            for path in batch["path"]:
                with opened(path) as file:
                    starts.append(file.read(count))
            yield pd.DataFrame({"path": batch["path"], "start": starts})

    return paths.select("path").mapInPandas(read, "path string, start binary")
