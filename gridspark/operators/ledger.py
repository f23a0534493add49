"""Ingest ledger and surrogate ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridspark.operators.merge import append_into, read_table
from gridspark.schemas import TABLES, Table
from gridspark.session import ensure_checkpoint_dir, observed

PARTITION_COUNTS_LIMIT = 100_000
# Issues of whole files and archive entries; each stands for one of them, not for a line.
FILE_ISSUES = ["broken_archive", "broken_entry", "no_header", "no_items", "broken_answer", "not_utf8"]


def ledger_entries(attempts: DataFrame, dir_name: Column, day: Column, filename: Column, ok: Column,
                   failure: Column) -> DataFrame:
    """One entry per attempted file, successful or not."""
    return attempts.select(
        dir_name.alias("dir_name"), day.alias("date"), filename.alias("filename"),
        F.when(ok, "success").otherwise(F.concat(F.lit("failed: "), failure)).alias("status"),
    )


def sparse_ids(df: DataFrame, start: Column) -> DataFrame:
    """Unique, growing ids with gaps, as a sequence gives them: no shuffle."""
    return df.withColumn("id", start + F.monotonically_increasing_id())


def next_id(spark: SparkSession, path: str, table: Table) -> int:
    """One above the largest stored id; of the files only that column is read."""
    largest = read_table(spark, path, table).agg(F.max("id")).first()[0]
    return (largest or 0) + 1


def append_entries(entries: DataFrame, path: str) -> None:
    """Append ledger entries with ids and the time of loading."""
    spark, table = entries.sparkSession, TABLES["downloaded_files"]
    stamped = entries.withColumn("downloaded_at", F.current_timestamp())
    append_into(sparse_ids(stamped, F.lit(next_id(spark, path, table))), path, table)


def dense_ids(df: DataFrame, order: list[str], start: int = 1) -> DataFrame:
    """Consecutive ids in `order`, without ever sorting everything in one task.

    Rows are range-partitioned and sorted by `order`, saved, counted per partition, and
    numbered by position plus the counts before. A value that dominates the first order
    column is split by the following ones. The checkpoint keeps the partitions the
    counts were taken from, also when an executor is lost between the two steps.
    """
    ensure_checkpoint_dir(df.sparkSession)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__position", position)
        .checkpoint()
    )
    # One row per partition, so the unpartitioned window sees no more than that.
    counts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    few = placed.rdd.getNumPartitions() <= PARTITION_COUNTS_LIMIT
    joined = placed.join(F.broadcast(offsets) if few else offsets, "__part")
    numbered = joined.withColumn("id", F.lit(start) + F.col("__before") + F.col("__position"))
    return numbered.select("id", *df.columns)


@dataclass(frozen=True)
class Account:
    """Where the rows of one evaluation went; `sent` is the sum of the three counts."""

    accepted: DataFrame
    rejected: DataFrame
    unread: DataFrame
    counts: dict[str, int]

    @property
    def sent(self) -> int:
        return sum(self.counts.values())


def account(parsed: DataFrame, folder: str, kept_issues: tuple[str, ...] = ()) -> Account:
    """Evaluate parsed rows once: one write splits them into rows that load, rejected lines and files
    or entries that could not be read, and counts each kind while it passes."""
    issue = F.col("issue")
    kind = (
        F.when(issue.isNull() | issue.isin(list(kept_issues)), "accepted")
        .when(issue.isin(FILE_ISSUES), "unread").otherwise("rejected")
    )
    seen, kinds = Observation(), ("accepted", "rejected", "unread")
    marked = parsed.withColumn("__kind", kind).observe(seen, *[F.count_if(F.col("__kind") == name).alias(name) for name in kinds])
    marked.write.partitionBy("__kind").parquet(folder)
    schema = StructType([*parsed.schema.fields, StructField("__kind", StringType())])
    stored = parsed.sparkSession.read.schema(schema).parquet(folder)
    parts = [stored.filter(F.col("__kind") == name).drop("__kind") for name in kinds]
    return Account(*parts, observed(seen, *kinds))


def file_outcomes(files: DataFrame, parsed: DataFrame) -> DataFrame:
    """Per attempted file its accepted and flagged rows and what of it was `unread`; a file without
    rows has failed, and one that lost entries loads in part.

    `files` holds `path`; `parsed` holds `path` and `issue` and is counted per task first. Issues in
    FILE_ISSUES stand for a file or an archive's entry, all others for a line.
    """
    unread = F.coalesce(F.col("issue").isin(FILE_ISSUES), F.lit(False))
    counts = parsed.groupBy("path").agg(
        F.count_if(F.col("issue").isNull()).alias("rows"), F.count_if(F.col("issue").isNotNull() & ~unread).alias("flagged"),
        F.count_if(unread).alias("unread"), F.min(F.when(unread, F.col("issue"))).alias("reason"),
    )
    # Entries of an archive count for the archive.
    whole = counts.groupBy(F.substring_index("path", "!", 1).alias("path")).agg(
        *[F.sum(name).alias(name) for name in ("rows", "flagged", "unread")], F.min("reason").alias("reason")
    )
    joined = files.select("path").join(whole, "path", "left")
    rows, flagged, lost = (F.coalesce(name, F.lit(0)).alias(name) for name in ("rows", "flagged", "unread"))
    status = (
        F.when(~(F.coalesce("rows", F.lit(0)) > 0), F.concat(F.lit("failed: "), F.coalesce("reason", F.lit("no rows"))))
        .when(F.col("reason").isNotNull(), F.concat(F.lit("partial: "), F.col("reason")))
        .otherwise("success")
    )
    return joined.select("path", status.alias("status"), rows, flagged, lost)
