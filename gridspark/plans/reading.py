"""Read-side queries: ranges, previews, counts, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridspark.dims import AREA_IDS
from gridspark.functions.dates import slashed_date
from gridspark.functions.text import fixed_or_na, thousands_or_na
from gridspark.operators import reports
from gridspark.plans.registry import EVENTS_SQL, plan, slot_events, table

FIRST, LAST = "1996-01-01", "1996-06-30"


def orders_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = (F.lit(day).cast("timestamp_ntz") for day in (FIRST, LAST))
    return reports.in_range(table(spark, sf_dir, "orders"), "o_orderdate", first, last)


RANGE_SQL = f"o_orderdate BETWEEN TIMESTAMP '{FIRST}' AND TIMESTAMP '{LAST}'"


@plan(f"""SELECT o_orderdate, o_orderkey, o_custkey, printf('%.2f', o_totalprice) AS price, format('{{:,}}', o_custkey * 1000) AS qty
FROM orders WHERE {RANGE_SQL} ORDER BY o_orderdate, o_orderkey LIMIT 10""")
def range_preview_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.preview(orders_in_range(spark, sf_dir), [F.col("o_orderdate"), F.col("o_orderkey")], 10)
    return rows.select("o_orderdate", "o_orderkey", "o_custkey", fixed_or_na(F.col("o_totalprice")).alias("price"),
                       thousands_or_na(F.col("o_custkey") * 1000).alias("qty"))


@plan("SELECT o_orderdate, o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5")
def range_preview_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    return reports.preview(orders, [F.desc("o_orderdate"), F.col("o_orderkey")], 5)


@plan(f"""SELECT o_orderkey, o_orderdate, (SELECT count(*) FROM orders WHERE {RANGE_SQL}) AS total_rows FROM orders
WHERE {RANGE_SQL} ORDER BY o_orderdate, o_orderkey LIMIT 5""")
def head_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_in_range(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return reports.head_with_total(orders, [F.col("o_orderdate"), F.col("o_orderkey")], 5)


@plan(f"SELECT count(*) AS rows FROM orders WHERE {RANGE_SQL}")
def range_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.row_count(orders_in_range(spark, sf_dir))


@plan("SELECT event_type, count(*) AS rows FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return reports.value_counts(events, reports.find_column(events, ["_type"]))


@plan("SELECT min(ts) AS earliest, max(ts) AS latest FROM events")
def span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.time_span(table(spark, sf_dir, "events"), "ts")


@plan(f"""WITH {EVENTS_SQL} SELECT area_code, count(DISTINCT dt) AS batches, CAST(count(*) AS BIGINT) AS rows
FROM ev GROUP BY area_code""")
def per_source_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.batches_per_source(slot_events(spark, sf_dir), "area_code", "dt")


@plan(f"""WITH {EVENTS_SQL}, b AS (SELECT area_code, count(DISTINCT dt) AS batches, count(*) AS rows FROM ev GROUP BY area_code)
SELECT count(*) AS sources, CAST(sum(batches) AS BIGINT) AS batches, CAST(sum(rows) AS BIGINT) AS rows FROM b""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.run_totals(reports.batches_per_source(slot_events(spark, sf_dir), "area_code", "dt"))


PROFILED = ["l_returnflag", "l_linestatus", "l_linenumber", "l_partkey", "l_suppkey"]


def _profile_sql(name: str) -> str:
    return f"""SELECT '{name}' AS "column", count(*) - count({name}) AS nulls, count(DISTINCT {name}) AS distinct_values,
  CASE WHEN count(DISTINCT {name}) < 10 THEN (SELECT coalesce(string_agg(v, ',' ORDER BY v), '')
    FROM (SELECT DISTINCT CAST({name} AS VARCHAR) AS v FROM lineitem)) END AS "values" FROM lineitem"""


@plan(" UNION ALL ".join(_profile_sql(name) for name in PROFILED))
def batch_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.profile(table(spark, sf_dir, "lineitem"), PROFILED)


ALL_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate"]


def _sketch_sql(name: str) -> str:
    return f"""SELECT '{name}' AS "column", count(*) AS rows, count(*) - count({name}) AS nulls, count(DISTINCT {name}) AS distinct_values, TRUE AS close,
  CASE WHEN count(DISTINCT {name}) < 10 THEN (SELECT coalesce(string_agg(v, ',' ORDER BY v), '')
    FROM (SELECT DISTINCT CAST({name} AS VARCHAR) AS v FROM lineitem)) END AS "values" FROM lineitem"""


@plan(" UNION ALL ".join(_sketch_sql(name) for name in ALL_COLUMNS))
def profile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns from the sketches of each ship month, beside the exact number of distinct values
    and whether the estimate is within two percent of it."""
    items = table(spark, sf_dir, "lineitem").select(*ALL_COLUMNS, F.date_format("l_shipdate", "yyyyMM").alias("month"))
    merged = reports.profile_of_sketches(reports.sketches(items, ALL_COLUMNS, ["month"]))
    exact = reports.profile(items, ALL_COLUMNS).select("column", F.col("distinct_values").alias("exact"))
    off = F.abs(F.col("distinct_values") - F.col("exact"))
    return merged.join(exact, "column").select("column", "rows", "nulls", F.col("exact").alias("distinct_values"),
                                               (100 * off <= 2 * F.col("exact")).alias("close"), "values")


@plan("""WITH f AS (SELECT props AS raw FROM events WHERE props IS NOT NULL)
SELECT (SELECT CAST(to_json(list(raw ORDER BY raw)) AS VARCHAR) FROM (SELECT raw FROM f ORDER BY raw LIMIT 5)) AS examples,
       (SELECT count(*) FROM f) AS failed""")
def failed_parses(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("props").alias("raw"))
    failed = reports.failed_parses(events.withColumn("day", slashed_date(F.col("raw"))), "raw", "day")
    return failed.select(F.to_json("examples").alias("examples"), "failed")


CHOSEN = ["tohoku", "kansai", "kyushu"]
CHOSEN_CODES = ", ".join(str(code) for code, area_id in AREA_IDS.items() if area_id in CHOSEN)


@plan(f"""WITH {EVENTS_SQL} SELECT event_id, area_code, dt, slot FROM ev WHERE area_code IN ({CHOSEN_CODES})""")
def area_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.select_areas(slot_events(spark, sf_dir), CHOSEN).select("event_id", "area_code", "dt", "slot")


@plan("SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey")
def area_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes in number order, also when they are stored as text."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return nation.orderBy(F.col("n_nationkey").cast("string").cast("int"))
