"""CSV export."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def export_csv(df: DataFrame, target: str, partitions: list[str]) -> None:
    """Headed UTF-8 CSV, one folder per partition value.

    Rows are clustered by the partition columns; the engine splits a partition that is
    too large for one task, so a dominant value still writes from many tasks.
    """
    df.hint("rebalance", *partitions).write.mode("overwrite").option("header", True).partitionBy(*partitions).csv(target)


def export_weather(weather: DataFrame, target: str) -> None:
    """Weather rows by station and month."""
    month = F.date_format(F.col("date").try_cast("date"), "yyyyMM")
    export_csv(
        weather.withColumn("station", F.col("station_id")).withColumn("month", month), target, ["station", "month"]
    )
