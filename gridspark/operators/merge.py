"""Merges into keyed tables, as DataFrames and onto partitioned parquet.

Plain parquet has no MERGE. The DataFrame forms return the table after the merge (or
only its new rows); the `*_into` forms write no more than they must: insert-ignore
appends, upsert rewrites the touched partitions.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from gridspark.operators.dedup import keep_first, keep_last
from gridspark.schemas import MONTH, Table, missing_columns, require_columns
from gridspark.session import evaluated_once

PARTITIONS_TO_PRUNE = 1000
Order = list[str | Column]


def with_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is complete."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return require_columns(df, keys).filter(condition)


def new_rows(target: DataFrame, batch: DataFrame, keys: list[str], order: Order) -> DataFrame:
    """Batch rows whose key the target lacks, the first per key. Of the target only keys are read."""
    first = keep_first(with_key(batch, keys), keys, order)
    return first.join(target.select(*keys), keys, "left_anti").select(*batch.columns)


def existing_rows(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows whose key the target has."""
    return batch.join(target.select(*keys).distinct(), keys, "left_semi").select(*batch.columns)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str], order: Order) -> DataFrame:
    """Target after adding unknown keys; existing rows stay as they are."""
    return target.unionByName(new_rows(target, batch, keys, order).select(*target.columns))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: Order) -> DataFrame:
    """Target after replacing whole rows, nulls included; the last batch row per key wins.

    The batch's keys are made distinct per task before they move, so a repeated key is
    harmless, and the target is not moved at all when those keys fit a broadcast.
    """
    keyed = with_key(batch, keys)
    untouched = target.join(keyed.select(*keys).distinct(), keys, "left_anti").select(*target.columns)
    return untouched.unionByName(keep_last(keyed, keys, order).select(*target.columns))


def upsert_columns(target: DataFrame, batch: DataFrame, keys: list[str], columns: list[str], order: Order) -> DataFrame:
    """Target after replacing only `columns` of known keys and adding unknown keys whole."""
    latest = keep_last(with_key(batch, keys), keys, order).select(*target.columns)
    renamed = latest.withColumnsRenamed({name: f"new_{name}" for name in target.columns if name not in keys})
    joined = target.withColumn("known", F.lit(True)).join(renamed.withColumn("sent", F.lit(True)), keys, "full_outer")

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        replaced = F.col("sent") if name in columns else F.col("known").isNull()
        return F.when(replaced, F.col(f"new_{name}")).otherwise(F.col(name)).alias(name)

    return joined.select(*[value(name) for name in target.columns])


def after_watermark(target: DataFrame, batch: DataFrame, day: str) -> DataFrame:
    """Batch rows newer than the target's latest day; all dated ones when it has none."""
    latest = target.agg(F.max(day).alias("latest")).scalar()
    return batch.filter(F.col(day).isNotNull() & F.coalesce(F.col(day) > latest, F.lit(True)))


def watermark_append(target: DataFrame, batch: DataFrame, keys: list[str], day: str, order: Order) -> DataFrame:
    """Insert-ignore of the rows beyond the target's latest day."""
    return insert_ignore(target, after_watermark(target, batch, day), keys, order)


def affected_counts(target: DataFrame, batch: DataFrame, keys: list[str], order: Order) -> DataFrame:
    """One row: batch rows, rows that insert-ignore adds, rows it leaves out."""
    sent = batch.agg(F.count(F.lit(1)).alias("sent")).scalar()
    added = new_rows(target, batch, keys, order).agg(F.count(F.lit(1)).alias("inserted"))
    return added.withColumn("sent", sent).withColumn("ignored", F.col("sent") - F.col("inserted"))


# --- onto parquet ------------------------------------------------------------------


def read_table(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """The stored table with its month, or an empty one where nothing has been written yet."""
    try:
        return spark.read.schema(table.stored_schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], table.stored_schema)
        raise


def stored_form(batch: DataFrame, table: Table, extra: list[str]) -> DataFrame:
    """Declared columns, the month the files are laid out by, and columns that order the batch."""
    require_columns(batch, table.key)
    absent = {name.lower() for name in missing_columns(batch, table.columns)}
    typed = [
        (F.lit(None) if f.name.lower() in absent else F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in table.schema
    ]
    rows = batch.select(*typed, *[name for name in extra if name not in table.columns])
    return rows.withColumn(MONTH, month_of(F.col("date"))) if MONTH in table.partitions else rows


def month_of(day: Column) -> Column:
    """`YYYYMM` of a date or of a date text with or without separators; one-digit months count."""
    text = F.trim(day.cast("string"))
    parts = F.split(text, "[-/]")
    separated = F.concat(F.get(parts, F.lit(0)), F.lpad(F.get(parts, F.lit(1)), 2, "0"))
    return F.when(F.size(parts) > 1, separated).otherwise(F.substring(text, 1, 6))


def touched(target: DataFrame, batch: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """The target's partitions that the batch falls into.

    The partition values are collected only up to a fixed number, to become a literal
    filter that prunes files; beyond it the engine joins instead. Whole combinations are
    compared, and a null value, which has a folder of its own, equals itself.
    """
    if not partitions:
        return target
    values = batch.select(*partitions).distinct()
    found = values.limit(PARTITIONS_TO_PRUNE + 1).collect()
    if len(found) > PARTITIONS_TO_PRUNE:
        values = values.select(*[F.col(name).alias(f"batch_{name}") for name in partitions])
        same = [F.col(name).eqNullSafe(F.col(f"batch_{name}")) for name in partitions]
        return target.join(values, reduce(and_, same), "left_semi")
    return target.filter(in_partitions(partitions, [tuple(row) for row in found]))


def in_partitions(partitions: tuple[str, ...], found: list[tuple]) -> Column:
    """Whether a row lies in one of the given partitions, as nested lists of values per column."""
    column, rest = F.col(partitions[0]), partitions[1:]
    by_value: dict = {}
    for value, *more in found:
        by_value.setdefault(value, []).append(tuple(more))
    if not rest:
        known = [value for value in by_value if value is not None]
        return column.isin(known) | (column.isNull() if None in by_value else F.lit(False))
    tests = [
        (column.isNull() if value is None else column == F.lit(value)) & in_partitions(rest, more)
        for value, more in by_value.items()
    ]
    return reduce(or_, tests, F.lit(False))


def _write(rows: DataFrame, path: str, table: Table, mode: str) -> None:
    """Write clustered by partition, so that a partition gets few files; the engine
    splits partitions that are too large for one task."""
    clustered = rows.hint("rebalance", *table.partitions) if table.partitions else rows
    writer = clustered.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*table.partitions).parquet(path)


def append_into(batch: DataFrame, path: str, table: Table) -> None:
    """Plain append by column name, without a duplicate check."""
    _write(stored_form(batch, table, []), path, table, "append")


def insert_into(spark: SparkSession, batch: DataFrame, path: str, table: Table, order: list[str]) -> None:
    """Append the rows with unknown keys. Running it again adds nothing. The batch is evaluated once."""
    with evaluated_once(stored_form(batch, table, order)) as rows:
        target = touched(read_table(spark, path, table), rows, table.partitions)
        added = new_rows(target, rows, list(table.key), order)
        _write(added.select(*table.stored_schema.names), path, table, "append")


def upsert_into(spark: SparkSession, batch: DataFrame, path: str, table: Table, order: list[str],
                columns: list[str] | None = None) -> None:
    """Rewrite the touched partitions with the batch merged in, whole rows or some columns.

    Partitions must follow from the key, so that a key never changes its partition.
    Files are swapped when the job commits; a lost task is simply run again. The batch is
    evaluated once. For one commit over all partitions see `gridspark.operators.snapshots`.
    """
    if not table.partitions:
        raise ValueError(f"{table.name} has no partitions to rewrite")
    with evaluated_once(stored_form(batch, table, order)) as rows:
        target = touched(read_table(spark, path, table), rows, table.partitions)
        # The key decides the partition, so only the key is compared; a null month has its own folder.
        keys = list(table.key)
        if columns:
            merged = upsert_columns(target, rows, keys, columns, order)
        else:
            merged = upsert(target, rows, keys, order)
        _write(merged.select(*table.stored_schema.names), path, table, "overwrite")
