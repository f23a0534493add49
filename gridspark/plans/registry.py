"""Registry of contract queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridspark.functions.dates import slot_of_stamp
from gridspark.session import configure

Build = Callable[[SparkSession, str], DataFrame]
PLANS: dict[str, "Plan"] = {}
AREA_COUNT = 9


@dataclass(frozen=True)
class Plan:
    """A query over the given tables and, where SQL can say it, the same in SQL."""

    build: Build
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(configure(spark), sf_dir)


def plan(sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query under its function name."""

    def register(build: Build) -> Build:
        PLANS[build.__name__] = Plan(build, sql)
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the area, day and half-hour slot they stand for."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        (F.col("user_id") % AREA_COUNT + 1).cast("int").alias("area_code"),
        F.to_date("ts").alias("dt"), slot_of_stamp(F.col("ts")).alias("slot"),
    )


# The same columns in SQL; `v` is the value as an exact decimal.
EVENTS_SQL = """ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(user_id % 9 + 1 AS INTEGER) AS area_code,
         CAST(ts AS DATE) AS dt,
         CAST(hour(ts) * 2 + CASE WHEN minute(ts) < 30 THEN 1 ELSE 2 END AS INTEGER) AS slot,
         CAST(value AS DECIMAL(18,2)) AS v
  FROM events)"""
EXACT = "decimal(18,2)"
