"""Two-pass external shuffle into shards of equal row counts.

Pass one scatters rows uniformly over memory-sized buckets by a seeded hash. Pass two shuffles
each bucket by Fisher-Yates (Spark's `shuffle` of an array) over its row numbers. Buckets in order
form one random order of all rows; shard s gets the s-th equal share of it, so counts differ by
one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridspark.llm.common import free_name, staged

SHARDS = 8
SEED = 20_240_607
# A bucket's texts fit in a task's memory; its row numbers do as well.
BUCKET_BYTES = 32 << 20
BUCKET_ROWS = 50_000
LAW = "rows"


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """Row number, size, checksum and scatter hash of each row. The hash includes the row number, so
    that copies, null ids and repeated rows spread like any others."""
    body = F.coalesce(F.col("text"), F.lit(""))
    row = F.monotonically_increasing_id()
    return docs.select(
        row.alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), row, F.col("doc_id")).alias("scatter"),
    )


def bucket_of(scatter: Column, buckets: int) -> Column:
    return F.pmod(scatter, F.lit(buckets))


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
           bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per input row: row_no, doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law `rows`: shard counts differ by at most one, slots are gapless from 0 within a shard, and
    grown_shard is null. A null text has size 1 and checksum 0; null or repeated ids and repeated
    rows are rows like others; an empty table gives no rows; further columns are ignored.
    """
    rows = staged(sized(docs, seed), "sizes")
    total = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    buckets = max(1, -(-total["bytes"] // bucket_bytes), -(-total["rows"] // bucket_rows))
    placed = rows.withColumn("bucket", bucket_of(F.col("scatter"), buckets))
    counts = placed.groupBy("bucket").agg(F.count("*").alias("n"))
    # One row per bucket; the order is staged because `shuffle` depends on the task it runs in.
    orders = staged(counts.repartition(min(buckets, 200), "bucket").sortWithinPartitions("bucket").select(
        "bucket", "n", F.shuffle(F.sequence(F.lit(0), F.col("n").cast("int") - 1), seed=F.lit(seed)).alias("order")), "orders")
    starts = orders.select("bucket", F.coalesce(
        F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("begin"))
    numbered = placed.withColumn("place", F.row_number().over(Window.partitionBy("bucket").orderBy("scatter", "row_no")) - 1)
    position = F.col("begin") + F.element_at("order", F.col("place") + 1)
    share, count = F.lit(shards), F.lit(max(1, total["rows"]))
    return numbered.join(orders.select("bucket", "order"), "bucket").join(starts, "bucket").select(
        "row_no", "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), position.alias("position")).select(
        "row_no", "doc_id", "size", "text_crc32", "law",
        F.expr(f"(position * {shards}) div {max(1, total['rows'])}").cast("int").alias("shard"), "position").select(
        "row_no", "doc_id", "size", "text_crc32", "law", "shard",
        # The shard's first position is the smallest p with p * shards >= shard * rows.
        (F.col("position") - F.ceil(F.col("shard").cast("decimal(38,0)") * count / share).cast("long")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write the rows of `docs`, in shuffled order, to one folder per shard under `path`.

    Each shard folder is written by several tasks, as its share of buckets needs; `slot` orders it.
    """
    number = free_name(docs)
    order = assign(docs, shards, seed).select(F.col("row_no").alias(number), F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))
    marked = docs.withColumn(number, F.monotonically_increasing_id())
    full = marked.join(order, number).drop(number)
    full.repartitionByRange("__shard", "__slot").sortWithinPartitions("__shard", "__slot").write.partitionBy("__shard").parquet(path)
