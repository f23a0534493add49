"""Expected grids and gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridspark.constants import AREAS, STATIONS
from gridspark.operators.coverage import expected_days, expected_months, expected_spans, gaps, span_of
from gridspark.plans.registry import EVENTS_SQL, plan, slot_events, table


def _unfold(span: DataFrame, name: str, values: list) -> DataFrame:
    """One row per value, each with the span; the list is a fixed dimension."""
    return span.withColumn(name, F.explode(F.array(*[F.lit(value) for value in values])))


AREA_CODES = [code for _, _, code, _ in AREAS]
STATION_IDS = [station for station, _ in STATIONS]


@plan("""WITH s AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
m AS (SELECT CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS DATE)
  AS month_start FROM s)
SELECT CAST(area_code AS INTEGER) AS area_code, month_start FROM m, range(1, 11) r(area_code)""")
def expected_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    areas = _unfold(span_of(orders, "day"), "area_code", AREA_CODES)
    return expected_months(areas, F.col("first_day"), F.col("last_day")).select("area_code", "month_start")


STATION_SQL = ", ".join(f"('{station}')" for station in STATION_IDS)


@plan(f"""WITH s AS (SELECT CAST(min(l_shipdate) AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS b FROM lineitem),
m AS (SELECT a, b, CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS DATE) AS m
  FROM s), st(station_id) AS (VALUES {STATION_SQL})
SELECT station_id, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month,
  CAST(day(greatest(m, a)) AS INTEGER) AS first_day, CAST(day(least(last_day(m), b)) AS INTEGER) AS last_day FROM m, st""")
def month_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    stations = _unfold(span_of(shipped, "day"), "station_id", STATION_IDS)
    renamed = stations.withColumnsRenamed({"first_day": "start", "last_day": "end"})
    return expected_spans(renamed, F.col("start"), F.col("end")).drop("start", "end")


@plan(f"""WITH {EVENTS_SQL}, s AS (SELECT min(dt) AS a, max(dt) AS b FROM ev),
d AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM s),
g AS (SELECT day, CAST(area_code AS INTEGER) AS area_code, CAST(slot AS INTEGER) AS slot
  FROM d, range(1, 11) r(area_code), range(1, 49) t(slot))
SELECT area_code, day, slot FROM g WHERE NOT EXISTS (
  SELECT 1 FROM ev WHERE ev.area_code = g.area_code AND ev.dt = g.day AND ev.slot = g.slot)""")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = slot_events(spark, sf_dir)
    areas = _unfold(span_of(events, "dt"), "area_code", AREA_CODES)
    days = expected_days(areas, F.col("first_day"), F.col("last_day"))
    expected = _unfold(days, "slot", list(range(1, 49))).select("area_code", "day", "slot")
    return gaps(expected, events.withColumnRenamed("dt", "day"), ["area_code", "day", "slot"])


@plan(f"""WITH {EVENTS_SQL}, s AS (SELECT min(dt) AS a, max(dt) AS b FROM ev),
g AS (SELECT CAST(area_code AS INTEGER) AS area_code, (b - a + 1) * 48 AS expected FROM s, range(1, 11) r(area_code)),
l AS (SELECT area_code, count(DISTINCT (dt, slot)) AS loaded FROM ev GROUP BY area_code)
SELECT g.area_code, CAST(expected AS BIGINT) AS expected, CAST(coalesce(loaded, 0) AS BIGINT) AS loaded
FROM g LEFT JOIN l USING (area_code)""")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = slot_events(spark, sf_dir)
    areas = _unfold(span_of(events, "dt"), "area_code", AREA_CODES)
    days = (F.date_diff("last_day", "first_day") + 1).cast("bigint")
    present = events.select("area_code", "dt", "slot").distinct().groupBy("area_code").agg(F.count(F.lit(1)).alias("loaded"))
    return areas.join(present, "area_code", "left").select(
        "area_code", (days * 48).alias("expected"), F.coalesce("loaded", F.lit(0)).alias("loaded")
    )
