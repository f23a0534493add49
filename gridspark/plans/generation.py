"""Unit generation: JSON answers, the 48-slot matrix, plant operation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import PLANT_HEADERS
from gridspark.dims import lookup
from gridspark.functions.text import settled
from gridspark.operators.wide import rows_to_slots, slots_to_rows
from gridspark.plans.registry import EVENTS_SQL, plan, slot_events
from gridspark.schemas import SLOT_COLUMNS
from gridspark.sources import plant_operation, unit_generation
from gridspark.sources.lines import attach_heads

# Generation names an event type is written as; unknown names fall to the default type.
WRITTEN_AS = {"view": "原子力", "click": "火力（ガス）", "purchase": "その他", "signup": "太陽光"}


def unit_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON answer per day, plant and unit. Slots without energy are left out."""
    amount = F.floor("value")
    events = slot_events(spark, sf_dir)
    wide = rows_to_slots(events.withColumn("kwh", amount), ["dt", "user_id", "event_type"], "kwh")
    total = sum((F.col(name) for name in SLOT_COLUMNS[1:]), F.col(SLOT_COLUMNS[0]))
    slots = [
        F.when(F.col(column) != 0, F.col(column).cast("string")).alias(field)
        for field, column in unit_generation.slot_fields().items()
    ]
    item = F.struct(
        F.col("user_id").cast("string").alias("htdnsCd"),
        F.lpad((F.col("user_id") % 9 + 1).cast("string"), 2, "0").alias("areaCd"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("unitNm"),
        F.date_format("dt", "yyyy/MM/dd").alias("tgtDate"),
        F.concat(F.lit("発電所"), F.col("user_id").cast("string")).alias("htdnsNm"),
        lookup(WRITTEN_AS, F.col("event_type")).alias("htdnNm"),
        *slots, total.cast("string").alias("dayElr"),
    )
    answer = F.struct(F.struct(F.array(item).alias("items")).alias("data"))
    return settled(wide.select(F.to_json(answer).alias("text")))


def unit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_generation.accepted(unit_generation.transform(unit_generation.items(unit_answers(spark, sf_dir))))


UNITS_SQL = f"""{EVENTS_SQL}, u AS (
  SELECT strftime(dt, '%Y%m%d') AS date, CAST(user_id AS VARCHAR) AS plant_code,
         CASE WHEN event_type <> 'error' THEN event_type END AS unit_num,
         CAST(user_id % 9 + 1 AS INTEGER) AS area_code, '発電所' || user_id AS plant_name,
         CASE event_type WHEN 'view' THEN 'nuclear' WHEN 'click' THEN 'LNG' WHEN 'purchase' THEN 'biomass'
              WHEN 'signup' THEN 'solar' ELSE 'other_fire' END AS gen_method,
         slot, CAST(floor(value) AS BIGINT) AS kwh FROM ev)"""
UNIT_KEY = "date, plant_code, unit_num, area_code, plant_name, gen_method"
MASTER_KEY_SQL = "date || '_' || plant_code || '_' || coalesce(unit_num, 'NA')"


@plan(f"""WITH {UNITS_SQL} SELECT {MASTER_KEY_SQL} AS master_key, {UNIT_KEY}, {", ".join(
    f"CAST(coalesce(sum(kwh) FILTER (slot = {n}), 0) AS INTEGER) AS slot{n}" for n in range(1, 49))},
  CAST(sum(kwh) AS BIGINT) AS total FROM u GROUP BY {UNIT_KEY}""")
def unit_generation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_rows(spark, sf_dir).drop("dt")


@plan(f"""WITH {UNITS_SQL} SELECT {MASTER_KEY_SQL} AS master_key, slot, CAST(sum(kwh) AS INTEGER) AS kwh
FROM u GROUP BY {UNIT_KEY}, slot HAVING sum(kwh) <> 0""")
def unit_generation_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = slots_to_rows(unit_rows(spark, sf_dir).select("master_key", *SLOT_COLUMNS))
    return long.filter(F.col("kwh") != 0)


@plan(f"""WITH {UNITS_SQL} SELECT gen_method, area_code, CAST(sum(kwh) AS BIGINT) AS kwh
FROM u GROUP BY gen_method, area_code""")
def generation_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_rows(spark, sf_dir).groupBy("gen_method", "area_code").agg(F.sum("total").alias("kwh"))


@plan(f"""WITH {EVENTS_SQL} SELECT CAST(user_id AS VARCHAR) AS plant_code, event_type AS plant_type, dt AS date, event_id AS line_no,
  CAST(hour(ts) AS VARCHAR) || ':30' AS label, CAST(v AS DOUBLE) AS output_kwh, DATE '2024-02-01' AS processing_date FROM ev""")
def plant_operation_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = [f"{hour}:30" for hour in range(24)]
    header = ",".join([*PLANT_HEADERS, *[f"{label}[kWh]" for label in hours]])
    amounts: list[Column] = [F.when(F.hour("ts") == hour, F.col("value").cast("decimal(18,2)").cast("string")).otherwise("")
                             for hour in range(24)]
    known = [F.col("user_id").cast("string"), F.col("area_code").cast("string"), F.lit("発電所"), F.lit("１号機"),
             F.col("event_type"), F.date_format("dt", "yyyy/MM/dd")]
    text = settled(slot_events(spark, sf_dir).select(
        F.concat(F.lit("landed/plant_"), F.col("area_code").cast("string")).alias("path"),
        F.lit(0).cast("bigint").alias("seg"), F.col("event_id").alias("line_no"),
        F.concat_ws(",", *known, *amounts).alias("line"),
    ))
    heads = spark.range(1, 10).select(
        F.concat(F.lit("landed/plant_"), F.col("id").cast("string")).alias("path"),
        F.lit(-1).cast("bigint").alias("head_at"), F.lit(header).alias("header"),
    )
    lines = attach_heads(text, heads, plant_operation.positions(F.col("header")), broadcast=True)
    long = plant_operation.long_form(plant_operation.parse(lines, date(2024, 2, 1)))
    return long.filter(F.col("output_kwh").isNotNull()).select(
        "plant_code", "plant_type", "date", "line_no", F.col("time").alias("label"), "output_kwh", "processing_date"
    )
