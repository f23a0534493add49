"""Load area files whose better versions may land later.

A month's file can be published in several versions; the lowest one that has landed counts. The
stream keeps, per area and month, the version in use as state. A file that is no better is passed
over. A better one takes the place of the version in use: every partition that either of the two
reaches is rebuilt, in one commit, from the files that then count. State, table and ledger agree
after a restart, as a repeated batch decides and writes the same again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark.operators.dedup import keep_first
from gridspark.operators.ledger import account, file_outcomes
from gridspark.operators.merge import month_of
from gridspark.operators.snapshots import SnapshotTable
from gridspark.schemas import TABLES
from gridspark.session import ensure_checkpoint_dir, remove_folder, shared_folder
from gridspark.sources import area_supply
from gridspark.sources.files import BINARY_SCHEMA, literal_path

FILES_PER_BATCH = 1000
ORDER = area_supply.ORDER
DECISIONS = "path string, area_code int, period string, version int, action string, replaced string"
STATE = "version int, path string"
LOADED, SUPERSEDED, TOO_LATE = "loaded", "superseded", "after_current_year"


def chooser(current_year: int):
    """The decision on the files of one unit, built so that workers need no copy of this package."""
    schema, loaded, superseded, too_late = DECISIONS, LOADED, SUPERSEDED, TOO_LATE

    def decide(key, frames, state):
        import pandas as pd

        rows = []
        files = pd.concat(list(frames)).sort_values(["version", "path"])
        for path, area, period, version, monthly in zip(*(files[c].tolist() for c in ("path", "area_code", "period", "version", "monthly"))):
            action, replaced = loaded, None
            if monthly:
                best = state.get if state.exists else None
                if best is not None and tuple(best) <= (version, path):
                    action = superseded
                else:
                    replaced = best[1] if best is not None else None
                    state.update((version, path))
            elif isinstance(period, str) and len(period) == 4 and int(period) > current_year:
                action = too_late
            rows.append((path, None if pd.isna(area) else int(area), period, version, action, replaced))
        yield pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])

    return decide


def decisions(files: DataFrame, current_year: int) -> DataFrame:
    """What to do with each file of a stream of `path`."""
    units = area_supply.file_units(files)
    return units.groupBy("unit").applyInPandasWithState(chooser(current_year), DECISIONS, STATE, "append", "NoTimeout")


def ingest_versions(spark: SparkSession, landing: str, target: str, ledger: str, checkpoint: str, current_year: int | None = None,
                    files_per_batch: int = FILES_PER_BATCH, read: Callable[[SparkSession, list[str]], DataFrame] | None = None) -> StreamingQuery:
    """Start a run over everything that has landed since the last one, then stop by itself.

    The table at `target` is a `SnapshotTable`. The ledger has one row per file and batch: what was
    decided and what came of it.
    """
    table = TABLES["tso_area_data"]
    parse = read or (lambda s, paths: area_supply.parse(area_supply.scan(s, paths, every_version=True)))
    kept = tuple(area_supply.KEPT_ISSUES)

    ensure_checkpoint_dir(spark)

    def load(batch: DataFrame, batch_id: int) -> None:
        # The stateful step runs once per batch; it has at most files_per_batch rows.
        found = batch.collect()
        session = batch.sparkSession
        folder = f"{shared_folder(session)}/versions-{uuid.uuid4().hex}"
        try:
            store(session, SnapshotTable(session, target, table), found, batch_id, folder)
        finally:
            remove_folder(session, folder)

    def store(session: SparkSession, stored: SnapshotTable, found: list, batch_id: int, folder: str) -> None:
        loaded = [row.path for row in found if row.action == LOADED]
        names = session.createDataFrame([tuple(row) for row in found], DECISIONS)
        outcomes = session.createDataFrame([], "path string, status string, rows bigint, flagged bigint, unread bigint")
        if loaded:
            parsed = account(parse(session, [literal_path(path) for path in loaded]), f"{folder}/new", kept)
            stored.insert(parsed.accepted, ORDER)
            whole = parsed.accepted.unionByName(parsed.rejected).unionByName(parsed.unread)
            outcomes = file_outcomes(session.createDataFrame([(path,) for path in loaded], "path string"), whole)
        if any(row.replaced for row in found):
            rebuild(session, stored, found, batch_id, folder)
        entries = names.join(outcomes, "path", "left").withColumn("loaded_at", F.current_timestamp()).withColumn("batch_id", F.lit(batch_id))
        writer = entries.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(ledger)

    def active(session: SparkSession, found: list, batch_id: int) -> DataFrame:
        """Loaded files that no later one has replaced, with this batch's."""
        now = session.createDataFrame([tuple(row) for row in found], DECISIONS)
        if batch_id:
            past = session.read.schema(f"{DECISIONS}, batch_id bigint").parquet(ledger).filter(F.col("batch_id") < batch_id)
            now = past.drop("batch_id").unionByName(now)
        gone = now.filter(F.col("replaced").isNotNull()).select(F.col("replaced").alias("path"))
        return now.filter(F.col("action") == LOADED).join(gone, "path", "left_anti")

    def rebuild(session: SparkSession, stored: SnapshotTable, found: list, batch_id: int, folder: str) -> None:
        """Partitions that a replaced file or its successor reaches, anew from the files that count."""
        replaced = [row for row in found if row.replaced]
        both = [path for row in replaced for path in (row.path, row.replaced)]
        reached = account(parse(session, [literal_path(path) for path in both]), f"{folder}/both", kept).accepted
        partitions = reached.select("area_code", month_of(F.col("date")).alias("month")).distinct().checkpoint()
        files = active(session, found, batch_id)
        # Other files can hold rows of those months if their name says that month, its year, or nothing.
        near = files.join(partitions, "area_code").filter(
            F.col("period").isNull() | (F.col("period") == F.col("month")) | (F.col("period") == F.substring("month", 1, 4)))
        chosen = [row.path for row in near.select("path").distinct().collect()]
        sources = sorted({*chosen, *(row.path for row in replaced)})
        again = account(parse(session, [literal_path(path) for path in sources]), f"{folder}/again", kept).accepted
        first = keep_first(again, list(table.key), ORDER).withColumn("month", month_of(F.col("date")))
        within = first.join(partitions, ["area_code", "month"], "left_semi")
        stored.replace(within, partitions)

    files = (
        spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch).load(landing).select("path")
    )
    chosen = decisions(files, current_year or date.today().year)
    writer = chosen.writeStream.foreachBatch(load).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
