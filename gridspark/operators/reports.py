"""Read-side queries: ranges, previews, counts, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridspark.dims import check_area_ids

LISTED_VALUES = 10


def in_range(df: DataFrame, day: str, first: Column, last: Column) -> DataFrame:
    """Days between two bounds, both inclusive; on a stored date column it reaches the scan."""
    return df.filter(F.col(day).between(first, last))


def preview(df: DataFrame, order: list[Column], n: int = 10) -> DataFrame:
    """The first n rows by `order`: a top-k, never a full sort."""
    return df.orderBy(*order).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def head_with_total(df: DataFrame, order: list[Column], n: int = 5) -> DataFrame:
    """The first n rows, each with the number of all rows."""
    return preview(df, order, n).withColumn("total_rows", row_count(df).scalar())


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-null values and how often they occur, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.desc("rows"), column)


def find_column(df: DataFrame, hints: list[str]) -> str | None:
    """The first column whose name holds one of the hints."""
    return next((name for name in df.columns if any(hint in name for hint in hints)), None)


def time_span(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("earliest"), F.max(column).alias("latest"))


def batches_per_source(df: DataFrame, source: str, batch: str) -> DataFrame:
    """Number of batches and rows per source."""
    per_batch = df.groupBy(source, batch).agg(F.count(F.lit(1)).alias("rows"))
    return per_batch.groupBy(source).agg(F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"))


def run_totals(per_source: DataFrame) -> DataFrame:
    return per_source.agg(F.count(F.lit(1)).alias("sources"), F.sum("batches").alias("batches"),
                          F.sum("rows").alias("rows"))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: nulls, distinct values, and the values themselves when fewer than ten.

    Values are counted per task before they move, and only the ten smallest per column
    are ever gathered.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value")) for name in columns
    ]))
    counted = df.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(F.count(F.lit(1)).alias("rows"))
    totals = counted.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct_values"),
    )
    smallest = Window.partitionBy("column").orderBy("value")
    listed = (
        counted.filter(F.col("value").isNotNull())
        .withColumn("n", F.row_number().over(smallest))
        .filter(F.col("n") <= LISTED_VALUES)
        .groupBy("column")
        .agg(F.array_join(F.sort_array(F.collect_list("value")), ",").alias("smallest"))
    )
    few = F.when(F.col("distinct_values") < LISTED_VALUES, F.coalesce("smallest", F.lit("")))
    return totals.join(listed, "column", "left").select("column", "nulls", "distinct_values", few.alias("values"))


# 2 ** 15 registers estimate distinct values within about 0.6 percent; more frequent values than this are told apart.
SKETCH_K, SKETCH_ITEMS = 15, 4096


def sketches(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """Per part of the data (`by`) and column: rows, nulls, and mergeable sketches of the distinct and
    of the frequent values. Store them beside each partition: a new partition adds its own, and no
    other is read again."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value")) for name in columns
    ]))
    return df.select(*by, pairs.alias("p")).select(*by, "p.column", "p.value").groupBy(*by, "column").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value").isNull()).alias("nulls"),
        F.hll_sketch_agg("value", F.lit(SKETCH_K)).alias("distinct_sketch"),
        F.expr(f"approx_top_k_accumulate(value, {SKETCH_ITEMS})").alias("frequent_sketch"),
    )


def profile_of_sketches(stored: DataFrame) -> DataFrame:
    """The profile of all parts from their sketches: as `profile`, with the number of distinct values
    estimated. Values are listed, exactly, when fewer than ten."""
    merged = stored.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent_sketch, {SKETCH_ITEMS}), {LISTED_VALUES})").alias("frequent"),
    )
    # Null is one of the frequent items.
    values = F.sort_array(F.filter(F.transform("frequent", lambda entry: entry["item"]), lambda item: item.isNotNull()))
    few = F.when(F.col("distinct_values") < LISTED_VALUES, F.array_join(values, ","))
    return merged.select("column", "rows", "nulls", "distinct_values", few.alias("values"))


def failed_parses(df: DataFrame, raw: str, parsed: str, examples: int = 5) -> DataFrame:
    """Number of texts that did not parse, with a few of them."""
    failed = df.filter(F.col(raw).isNotNull() & F.col(parsed).isNull())
    sample = failed.orderBy(raw).limit(examples).agg(F.sort_array(F.collect_list(raw)).alias("examples"))
    return sample.withColumn("failed", row_count(failed).scalar())


def select_areas(df: DataFrame, area_ids: list[str]) -> DataFrame:
    """Rows of the named areas; an unknown id fails while the plan is built."""
    return df.filter(F.col("area_code").isin(check_area_ids(area_ids)))
