"""Keyed tables whose every change is one commit: readers see all of it or nothing.

A commit writes its files into a folder of its own, then a manifest that lists all files of the new
snapshot, and at last one log entry, created exclusively, that makes the manifest current. A job
that dies before that leaves only files which no manifest names. Writers that started from the same
snapshot notice each other at the log: the later one merges again on top of the earlier one's.

    data/c=<commit>/<partition folders>/…   files       manifests/<commit>/   files of a snapshot
    filters/<commit>/                       key filters log/<version>         commits in order

The batch is evaluated once: it is staged in the table's own layout, whose folders tell which
partitions it touches. Where a change adds the batch as it is, the commit names the staged files
themselves, and only rows that move out of replaced files are written. Every commit stores Bloom filters of its keys per partition. An insert asks
them first and opens only files that may hold one of its keys; what they let through is compared
exactly, so they change what is read and never the result.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from gridspark.operators.merge import new_rows, stored_form, upsert, upsert_columns
from gridspark.schemas import Table
from gridspark.session import create_exclusively, evaluated_once, file_names, observed, remove_folder, shared_folder

MANIFEST = "commit string, folder string, file string, bytes bigint"
FILTERS = "place string, size bigint, bucket bigint, bits binary, commit string"
# Bits of a filter per key, and how many of them a key sets: about one key in 400 passes wrongly.
BITS_PER_KEY, TESTS, BITMAP = 16, 4, 32768
ATTEMPTS = 20
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# From the staged batch, the folders it touches and the whole manifest to the rows that a commit
# writes, the folders or files that they replace, by columns of the manifest, and whether the staged files join the commit as they are.
Decision = Callable[[DataFrame, DataFrame, DataFrame], tuple[DataFrame, DataFrame, bool]]


@dataclass(frozen=True)
class Commit:
    """What a commit did: rows that the batch sent, of them without a key, and rows in its files."""

    version: int
    sent: int
    keyless: int
    written: int


def as_json(names: tuple[str, ...], values: list[Column]) -> Column:
    """Partition values as one text; a null value is a value."""
    return F.to_json(F.struct(*[value.cast("string").alias(name) for name, value in zip(names, values)]), {"ignoreNullFields": "false"})


class SnapshotTable:
    """A stored table under `path`."""

    def __init__(self, spark: SparkSession, path: str, table: Table, use_filters: bool = True) -> None:
        if not table.partitions:
            raise ValueError(f"{table.name} has no partitions")
        self.spark, self.path, self.table, self.use_filters = spark, path.rstrip("/"), table, use_filters

    # --- reading -----------------------------------------------------------------------------

    def version(self) -> int:
        """The current version; 0 before the first commit."""
        return max((int(name) for name in file_names(self.spark, f"{self.path}/log") if name.isdigit()), default=0)

    def entry_of(self, version: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/log/{version:020d}").first()[0])

    def commit_of(self, version: int) -> str:
        return self.entry_of(version)["commit"]

    def parts_of(self, version: int) -> list[str]:
        """The folders of a version's own files: its commit's and, where that names them, the staged ones."""
        entry = self.entry_of(version)
        return [name for name in (entry["commit"], entry.get("stage")) if name]

    def manifest(self, version: int) -> DataFrame:
        """The files of a version."""
        if not version:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/{self.commit_of(version)}")

    def rows_of(self, files: DataFrame) -> DataFrame:
        """Rows of some files of a manifest. Only their names are gathered, as for any scan."""
        names = self.names_of(files)
        return self.scan(names).select(*self.table.stored_schema.names) if names else self.spark.createDataFrame([], self.table.stored_schema)

    def names_of(self, files: DataFrame) -> list[str]:
        return [f"{self.path}/data/c={r.commit}/{r.folder}/{r.file}" for r in files.select("commit", "folder", "file").collect()]

    def scan(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(self.table.stored_schema).option("basePath", f"{self.path}/data").parquet(*names)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of its current or an earlier version, whatever is committed meanwhile."""
        return self.rows_of(self.manifest(self.version() if version is None else version))

    # --- writing -----------------------------------------------------------------------------

    def insert(self, batch: DataFrame, order: list[str]) -> Commit:
        """Add the rows with unknown keys, the first per key; running it again adds nothing."""

        def decide(staged: DataFrame, touched: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
            near = files.join(touched, "folder", "left_semi")
            asked = self.maybe_known(staged, near) if self.use_filters else near
            return new_rows(self.rows_of(asked), staged, list(self.table.key), order), touched.limit(0), False

        return self.change("insert", batch, order, decide)

    def upsert(self, batch: DataFrame, order: list[str], columns: list[str] | None = None) -> Commit:
        """Replace known keys, whole or in some columns, and add unknown ones; the last row per key counts."""
        keys = list(self.table.key)

        def decide(staged: DataFrame, touched: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
            target = self.rows_of(files.join(touched, "folder", "left_semi"))
            return (upsert_columns(target, staged, keys, columns, order) if columns else upsert(target, staged, keys, order)), touched, False

        return self.change("upsert", batch, order, decide)

    def replace_groups(self, batch: DataFrame, group: list[str], newer: str) -> Commit:
        """Replace all stored rows of the groups that the batch names with the batch's own.

        A group stays as it is if its stored rows have a greater `newer` than the batch's, of which
        only those with its greatest count. Partitions must follow from the group. Rows of a group
        are never brought together, so a group may be of any size. If all of the batch counts, its
        staged files join the table as they are.
        """
        named = F.lit(True)
        for name in group:
            named = named & F.col(name).isNotNull()

        def decide(staged: DataFrame, touched: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
            near = files.join(touched, "folder", "left_semi")
            sent = staged.groupBy(*group).agg(
                F.max(newer).alias("__sent"), (~F.min(newer).eqNullSafe(F.max(newer)) | (F.count(newer) % F.count(F.lit(1)) != 0)).alias("__mixed"))
            stored = held.enter_context(evaluated_once(self.groups_of(near, group, newer)))
            known = stored.join(sent.select(*group), group, "left_semi").groupBy(*group).agg(F.max("__newest").alias("__known"))
            wins = named & (F.col("__known").isNull() | F.coalesce(F.col("__sent") >= F.col("__known"), F.lit(False)))
            judged = held.enter_context(evaluated_once(sent.join(known, group, "left").withColumn("__wins", wins)))
            current = judged.filter("__wins").select(*group, "__sent")
            # Files without a replaced group stay, files of replaced groups alone go; only of the others rows move.
            goes = F.col("__sent_too").isNotNull()
            verdicts = held.enter_context(evaluated_once(
                stored.join(current.select(*group, F.lit(True).alias("__sent_too")), group, "left")
                .groupBy("commit", "folder", "file").agg(F.bool_or(goes).alias("goes"), F.bool_or(~goes).alias("stays")).filter("goes")))
            kept = self.rows_of(verdicts.filter("stays")).join(current, group, "left_anti").select(*self.table.stored_schema.names)
            gone = verdicts.select("commit", "folder", "file")
            if judged.filter(~F.col("__wins") | F.col("__mixed")).isEmpty():
                return kept, gone, True
            fresh = staged.join(current, group).filter(F.col(newer).eqNullSafe(F.col("__sent"))).select(*staged.columns)
            return kept.unionByName(fresh.select(*kept.columns)), gone, False

        with ExitStack() as held:
            return self.change("replace_groups", batch, [], decide, in_place=True)

    def groups_of(self, files: DataFrame, group: list[str], newer: str) -> DataFrame:
        """The groups in each file and their greatest `newer`, made distinct where a file is read."""
        place = ["commit", "folder", "file"]
        names = self.names_of(files)
        if not names:
            kinds = [self.table.stored_schema[name] for name in group]
            newest = T.StructField("__newest", self.table.stored_schema[newer].dataType)
            return self.spark.createDataFrame([], T.StructType([*kinds, *[T.StructField(name, T.StringType()) for name in place], newest]))
        uri = F.col("_metadata.file_path").alias("uri")
        found = self.scan(names).select(*group, F.col(newer).alias("__newest"), uri).groupBy(*group, "uri").agg(F.max("__newest").alias("__newest"))
        listing = self.spark.read.format("binaryFile").load(names).select("path", uri)
        return found.join(listing.select(*self.place_of_path(), "uri"), "uri").select(*group, *place, "__newest")

    def replace(self, batch: DataFrame, partitions: DataFrame) -> Commit:
        """Put the batch in the place of whole partitions, also where it has no rows for one of them.

        `partitions` has the table's partition columns; rows of the batch elsewhere are added.
        """
        names = self.table.partitions
        places = partitions.select(as_json(names, [F.col(name) for name in names]).alias("place")).distinct()

        def decide(staged: DataFrame, touched: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
            folders = files.select("folder", self.place_of_folder().alias("place")).distinct()
            return staged, folders.join(places, "place", "left_semi").select("folder"), False

        return self.change("replace", batch, [], decide)

    def change(self, operation: str, batch: DataFrame, order: list[str], decide: Decision, in_place: bool = False) -> Commit:
        """Stage the batch, then merge and publish, again if another writer was first.

        A batch without columns of its own may be staged `in_place`, among the table's files, where a
        commit can name it.
        """
        form = stored_form(batch, self.table, order)
        keyless = F.lit(False)
        for name in self.table.key:
            keyless = keyless | F.col(name).isNull()
        stage, named = uuid.uuid4().hex, False
        folder = f"{self.path}/data/c={stage}" if in_place else f"{shared_folder(self.spark)}/staged-{stage}"
        try:
            sent = self.write(form, folder, keyless)
            staged = self.spark.read.schema(form.schema).parquet(folder).select(*form.columns)
            touched = self.listed(folder, "").select("folder").distinct()
            for _ in range(ATTEMPTS):
                done, named = self.attempt(operation, staged, touched, decide, sent, stage)
                if done:
                    return done
        finally:
            if not named:
                remove_folder(self.spark, folder)
        raise RuntimeError(f"{self.path}: other writers were first {ATTEMPTS} times")

    def attempt(self, operation: str, staged: DataFrame, touched: DataFrame, decide: Decision, sent: dict, stage: str) -> tuple[Commit | None, bool]:
        """The commit, if this writer was first, and whether it names the staged files."""
        base, commit = self.version(), uuid.uuid4().hex
        files = self.manifest(base)
        rows, gone, whole = decide(staged, touched, files)
        data = f"{self.path}/data/c={commit}"
        written = self.write(rows.select(*self.table.stored_schema.names), data, F.lit(False))["sent"]
        kept = files.join(gone, gone.columns, "left_anti")
        if not written and operation == "insert":
            remove_folder(self.spark, data)
            return Commit(base, sent["sent"], sent["keyless"], 0), False
        parts = {commit: data, **({stage: f"{self.path}/data/c={stage}"} if whole else {})}
        for part, folder in parts.items():
            kept = kept.unionByName(self.listed(folder, part))
            if self.use_filters:
                self.write_filters(folder, part)
        kept.write.parquet(f"{self.path}/manifests/{commit}")
        written += sent["sent"] if whole else 0
        entry = json.dumps({"commit": commit, "stage": stage if whole else None, "operation": operation, "written": written, **sent})
        if create_exclusively(self.spark, f"{self.path}/log/{base + 1:020d}", entry):
            return Commit(base + 1, sent["sent"], sent["keyless"], written), whole
        self.forget(commit)
        remove_folder(self.spark, f"{self.path}/filters/{stage}")
        return None, False

    def write(self, rows: DataFrame, folder: str, odd: Column) -> dict:
        """Write rows in the table's layout and count them on the way."""
        seen = Observation()
        counted = rows.observe(seen, F.count(F.lit(1)).alias("sent"), F.count_if(odd).alias("keyless"))
        counted.hint("rebalance", *self.table.partitions).write.partitionBy(*self.table.partitions).parquet(folder)
        return observed(seen, "sent", "keyless")

    def listed(self, folder: str, commit: str) -> DataFrame:
        """The files under a folder as a manifest; no bytes are read."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
        _, *place = self.place_of_path()
        return files.select(F.lit(commit).alias("commit"), *place, F.col("length").alias("bytes"))

    def place_of_path(self) -> list[Column]:
        """`commit`, `folder` and `file` of the `path` of one of the table's files."""
        depth, parts = len(self.table.partitions), F.split("path", "/")
        folder = F.concat_ws("/", F.slice(parts, -depth - 1, depth))
        return [F.substring_index(F.element_at(parts, -depth - 2), "=", -1).alias("commit"), folder.alias("folder"), F.element_at(parts, -1).alias("file")]

    def forget(self, commit: str) -> None:
        for name in (f"data/c={commit}", f"manifests/{commit}", f"filters/{commit}"):
            remove_folder(self.spark, f"{self.path}/{name}")

    def vacuum(self, versions: int = 1) -> int:
        """Remove what only versions before the last `versions` need; the number of commits that went."""
        last = self.version()
        old = {name for v in range(1, max(0, last - versions) + 1) if self.has(v) for name in self.parts_of(v)}
        used = set()
        for version in range(max(1, last - versions + 1), last + 1):
            used |= {*self.parts_of(version), *(row.commit for row in self.manifest(version).select("commit").distinct().collect())}
        stages = {name for v in range(1, max(0, last - versions) + 1) if self.has(v) for name in self.parts_of(v)[1:]}
        gone = {name for name in old - used if file_names(self.spark, f"{self.path}/{'data/c=' if name in stages else 'manifests/'}{name}")}
        for commit in old & used:
            remove_folder(self.spark, f"{self.path}/manifests/{commit}")
        for commit in gone:
            self.forget(commit)
        return len(gone - stages)

    def has(self, version: int) -> bool:
        return f"{version:020d}" in file_names(self.spark, f"{self.path}/log")

    # --- key filters ---------------------------------------------------------------------------

    def place_of_folder(self) -> Column:
        """The partition values that a folder's name stands for."""
        def value(i: int) -> Column:
            raw = F.substring_index(F.get(F.split("folder", "/"), F.lit(i)), "=", -1)
            return F.when(raw != NO_VALUE, F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))))

        return as_json(self.table.partitions, [value(i) for i in range(len(self.table.partitions))])

    def keyed(self, rows: DataFrame) -> DataFrame:
        """`place` and the hashes of each key that decide its bits."""
        values = [F.col(name).cast("string") for name in self.table.key]
        place = as_json(self.table.partitions, [F.col(name) for name in self.table.partitions])
        return rows.select(place.alias("place"), F.array(*[F.xxhash64(F.lit(i), *values) for i in range(TESTS)]).alias("hashes"))

    def write_filters(self, data: str, commit: str) -> None:
        """One filter per partition of a commit, in bitmaps of bounded size."""
        schema = self.table.stored_schema
        keys = self.keyed(self.spark.read.schema(schema).parquet(data))
        size = F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / BITMAP) * BITMAP
        sizes = keys.groupBy("place").agg(size.cast("bigint").alias("size"))
        bits = keys.join(sizes, "place").select("place", "size", F.explode("hashes").alias("hash")).withColumn("bit", F.pmod("hash", "size"))
        filters = bits.groupBy("place", "size", F.expr(f"bit div {BITMAP}").alias("bucket")).agg(
            F.bitmap_construct_agg(F.col("bit") % BITMAP).alias("bits"))
        filters.withColumn("commit", F.lit(commit)).write.parquet(f"{self.path}/filters/{commit}")

    def maybe_known(self, batch: DataFrame, files: DataFrame) -> DataFrame:
        """The files that may hold a key of the batch. Files without a filter may."""
        commits = [row.commit for row in files.select("commit").distinct().collect()]
        have = [commit for commit in commits if file_names(self.spark, f"{self.path}/filters/{commit}")]
        if not have:
            return files
        filters = self.spark.read.schema(FILTERS).parquet(*[f"{self.path}/filters/{commit}" for commit in have])
        sizes = filters.select("commit", "place", "size").distinct()
        tests = self.keyed(batch).distinct().join(sizes, "place").select(
            "commit", "place", "hashes", F.explode("hashes").alias("hash"), "size").withColumn("bit", F.pmod("hash", "size"))
        at = tests.select("commit", "place", "hashes", "bit", F.expr(f"bit div {BITMAP}").alias("bucket"), (F.col("bit") % BITMAP).alias("within"))
        byte = F.conv(F.hex(F.expr("substring(bits, cast(within div 8 as int) + 1, 1)")), 16, 10).cast("int")
        held = F.getbit(byte, (F.col("within") % 8).cast("int")) == 1
        passed = at.join(filters, ["commit", "place", "bucket"]).filter(held).groupBy("commit", "place", "hashes").agg(F.count(F.lit(1)).alias("n"))
        maybe = passed.filter(F.col("n") == TESTS).select("commit", "place").distinct()
        named = files.withColumn("place", self.place_of_folder())
        without = files.filter(~F.col("commit").isin(have))
        return named.join(maybe, ["commit", "place"], "left_semi").select(*files.columns).unionByName(without)
