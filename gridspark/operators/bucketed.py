"""Keyed tables whose rows lie in buckets of their key, so that a merge moves the batch only.

Files are written in buckets and sorted by key. Whatever joins such a table on its key with as many
partitions finds the rows in place: an upsert shuffles the batch into the table's buckets and
neither shuffles nor broadcasts the table. A version is a folder of its own that a log entry, created
exclusively, makes current; the catalog is only told how the folder is laid out.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from gridspark.operators.dedup import keep_first, keep_last
from gridspark.operators.merge import with_key
from gridspark.schemas import require_columns
from gridspark.session import create_exclusively, file_names, remove_folder


class BucketedTable:
    """A table of `schema` under `path`, in `buckets` buckets of `keys`. The number of buckets is
    fixed for good: it bounds the tasks of a merge, so that it should follow the table's final size. With
    fewer buckets than `spark.sql.shuffle.partitions` the engine prefers to move the table."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], buckets: int) -> None:
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets

    def version(self) -> int:
        return max((int(name) for name in file_names(self.spark, f"{self.path}/log") if name.isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """The current or an earlier version."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], self.schema)
        commit = json.loads(self.spark.read.text(f"{self.path}/log/{version:020d}").first()[0])["commit"]
        name, keys = f"bucketed_{commit}", ", ".join(f"`{key}`" for key in self.keys)
        columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in self.schema)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.place(commit)}'")
        return self.spark.table(name)

    def place(self, commit: str) -> str:
        return f"{self.path}/data/{commit}"

    def in_buckets(self, rows: DataFrame) -> DataFrame:
        """Rows moved to the buckets that their keys have in the table."""
        return rows.repartition(self.buckets, *[F.col(key) for key in self.keys])

    def upserted(self, batch: DataFrame, order: list[str]) -> DataFrame:
        """The table after replacing whole rows; the last batch row per key counts."""
        sent = self.in_buckets(keep_last(with_key(batch, self.keys), self.keys, order).select(*self.schema.names))
        old = self.read()
        kept = old.hint("merge").join(sent.select(*self.keys).hint("merge"), self.keys, "left_anti")
        return kept.select(*self.schema.names).unionByName(sent)

    def inserted(self, batch: DataFrame, order: list[str]) -> DataFrame:
        """The table after adding the rows with unknown keys, the first per key."""
        sent = self.in_buckets(keep_first(with_key(batch, self.keys), self.keys, order).select(*self.schema.names))
        old = self.read()
        new = sent.hint("merge").join(old.select(*self.keys).hint("merge"), self.keys, "left_anti")
        return old.unionByName(new.select(*self.schema.names))

    def upsert(self, batch: DataFrame, order: list[str]) -> int:
        return self.commit(self.upserted(require_columns(batch, self.schema.names), order))

    def insert(self, batch: DataFrame, order: list[str]) -> int:
        return self.commit(self.inserted(require_columns(batch, self.schema.names), order))

    def commit(self, rows: DataFrame) -> int:
        """Write a version and make it current; the new version's number."""
        base, commit = self.version(), uuid.uuid4().hex
        name = f"writing_{commit}"
        writer = rows.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", self.place(commit))
        writer.saveAsTable(name)
        # The files stay: a table with a path of its own is external.
        self.spark.sql(f"DROP TABLE {name}")
        if not create_exclusively(self.spark, f"{self.path}/log/{base + 1:020d}", json.dumps({"commit": commit})):
            remove_folder(self.spark, self.place(commit))
            raise RuntimeError(f"{self.path}: another writer has published version {base + 1}")
        return base + 1
