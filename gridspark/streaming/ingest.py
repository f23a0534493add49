"""Load only new files, idempotently, with a file stream.

The stream carries names, not contents: each micro-batch hands its file names to the
same readers the batch loads use, so large files and archives take the same routes.
A batch that is repeated after a failure finds its keys in the table already.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from gridspark.operators.ledger import file_outcomes
from gridspark.operators.merge import insert_into, upsert_into
from gridspark.schemas import Table
from gridspark.session import remove_folder, shared_folder
from gridspark.sources.files import BINARY_SCHEMA, literal_path

FILES_PER_BATCH = 1000
ORDER = ["path", "seg", "line_no"]
Reader = Callable[[SparkSession, list[str]], DataFrame]


def ingest_new_files(
    spark: SparkSession, landing: str, read: Reader, table: Table, target: str, ledger: str, checkpoint: str,
    replace: bool = False, order: list[str] = ORDER, kept_issues: tuple[str, ...] = (),
    files_per_batch: int = FILES_PER_BATCH, shape: Callable[[DataFrame], DataFrame] | None = None,
    columns: list[str] | None = None,
) -> StreamingQuery:
    """Start a run over everything that has landed since the last one, then stop by itself.

    `read` parses named files into rows with `path`, the `order` columns and `issue`.
    Known keys are left alone, or replaced when `replace` is set, only in `columns` if given.
    `shape` turns parsed rows that load into rows of the table, such as steps into stacks. The ledger keeps one
    folder per batch, so a repeated batch writes the same entries again.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        # At most files_per_batch names.
        landed = [row.path for row in batch.select("path").collect()]
        if not landed:
            return
        session = batch.sparkSession
        # Parsed once, for the table and the ledger alike; survives lost executors, and goes afterwards.
        folder = f"{shared_folder(session)}/ingest-{uuid.uuid4().hex}"
        try:
            read(session, [literal_path(path) for path in landed]).write.parquet(folder)
            store(session, session.read.parquet(folder), landed, batch_id)
        finally:
            remove_folder(session, folder)

    def store(session: SparkSession, parsed: DataFrame, landed: list[str], batch_id: int) -> None:
        good = parsed.filter(F.col("issue").isNull() | F.col("issue").isin(list(kept_issues)))
        good = shape(good) if shape else good
        if replace:
            upsert_into(session, good, target, table, order, columns)
        else:
            insert_into(session, good, target, table, order)
        files = session.createDataFrame([(path,) for path in landed], "path string")
        entries = file_outcomes(files, parsed).withColumn("loaded_at", F.current_timestamp())
        writer = entries.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(ledger)

    names = (
        spark.readStream.format("binaryFile").schema(BINARY_SCHEMA).option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch).load(landing).select("path")
    )
    writer = names.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
