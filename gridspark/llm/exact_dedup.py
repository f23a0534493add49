"""Exact deduplication by a heavy-hitter split.

Misra-Gries counters (`freqItems`) find the digests that may be frequent. Exact counts verify
them, and their winners, at most 1 / SUPPORT rows, are broadcast, so rows of large groups of copies
are settled where they lie. The other digests have at most SUPPORT of all rows each and go
through an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gridspark.llm.common import free_name, staged

# A digest with more than this share of all rows is always found; at most 1 / SUPPORT are broadcast.
SUPPORT = 1e-3
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with each run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def winners(rows: DataFrame) -> DataFrame:
    """Smallest id (nulls last), first row among equal ids, and size of each digest's group."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("blank"), F.col("doc_id").alias("id"), F.col("row_no").alias("row")))
    return rows.groupBy("text_sha256").agg(first.alias("first"), F.count("*").alias("group_size"))


def resolve(rows: DataFrame, best: DataFrame) -> DataFrame:
    return rows.join(best, "text_sha256").select(
        "row_no", "doc_id", F.col("first.id").alias("keep_id"), "group_size",
        (F.col("first.row") == F.col("row_no")).alias("kept"), "text_sha256",
    )


def decide(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per input row: row_no, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after white-space runs became one space; a null text
    counts as empty. The smallest doc_id stays; a null id stays only when its group has no other
    id, and among rows that also repeat the id the first row (row_no) stays. An empty table gives
    no rows; further columns are ignored. row_no is the row's place in a scan of `docs`, which
    must return its rows in the same order each time, as files do.
    """
    rows = staged(docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"),
        digest(F.col("text")).alias("text_sha256"),
    ), "digests")
    suspects = F.broadcast(rows.freqItems(["text_sha256"], support).select(F.explode("text_sha256_freqItems").alias("text_sha256")))
    # Verified: exact counts of the suspects alone, combined in each task before anything moves.
    heavy = winners(rows.join(suspects, "text_sha256", "left_semi"))
    light = rows.join(suspects, "text_sha256", "left_anti")
    return resolve(rows, F.broadcast(heavy)).unionByName(resolve(light, winners(light)))


def deduplicate(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    number = free_name(docs)
    dropped = decide(docs, support).filter(~F.col("kept")).select(F.col("row_no").alias(number))
    marked = docs.withColumn(number, F.monotonically_increasing_id())
    return marked.join(dropped, number, "left_anti").drop(number)
