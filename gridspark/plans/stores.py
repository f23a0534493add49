"""Stored forms: what is written to a table, a payload store or a CSV folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridspark.constants import PRICE_CELLS
from gridspark.functions.dates import compact_text
from gridspark.functions.text import joined_key
from gridspark.operators import merge
from gridspark.operators.ledger import account
from gridspark.operators.routing import area_table
from gridspark.plans.landing import supply_files
from gridspark.plans.registry import EVENTS_SQL, EXACT, plan, slot_events, table
from gridspark.plans.supply import damaged_supply
from gridspark.schemas import TABLES, enforce
from gridspark.session import scratch_folder
from gridspark.sources import area_supply, export, spot_price
from gridspark.sources.files import area_of_path, store_payloads, stored_pieces
from gridspark.sources.lines import nth_line, piece_lines

SUPPLY = TABLES["tso_area_data"]


def supply_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of the area table, several to a key; most measures are absent."""
    text = compact_text(F.col("dt"))
    return slot_events(spark, sf_dir).select(
        "area_code", joined_key(text, F.col("slot").cast("string")).alias("master_key"), text.alias("date"), "slot",
        F.col("value").cast(EXACT).cast("double").alias("area_demand"), F.col("event_id"))


ROWS_SQL = """s AS (SELECT area_code, strftime(dt, '%Y%m%d') || '_' || slot AS master_key, strftime(dt, '%Y%m%d') AS date, slot,
  CAST(v AS DOUBLE) AS area_demand, event_id FROM ev)"""


@plan(f"""WITH {EVENTS_SQL}, {ROWS_SQL} SELECT area_code, master_key, date, slot, area_demand, CAST(NULL AS DOUBLE) AS nuclear, count(*) AS copies,
  substr(date, 1, 6) AS month FROM s GROUP BY ALL""")
def append_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain appends by column name in two batches; nothing is checked, so repeated rows stay."""
    path, rows = scratch_folder(spark, "append"), supply_rows(spark, sf_dir)
    for batch in (rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1").select("event_id", "area_demand", "slot", "date", "master_key", "area_code")):
        merge.append_into(batch, path, SUPPLY)
    stored = merge.read_table(spark, path, SUPPLY)
    return stored.groupBy("area_code", "master_key", "date", "slot", "area_demand", "nuclear", "month").agg(F.count(F.lit(1)).alias("copies"))


KEEP_SQL = "row_number() OVER (PARTITION BY area_code, master_key ORDER BY event_id % 2, event_id) AS n"


@plan(f"""WITH {EVENTS_SQL}, {ROWS_SQL}, k AS (SELECT *, {KEEP_SQL} FROM s)
SELECT master_key, slot, area_demand FROM k WHERE n = 1 AND area_code = 3""")
def area_table_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One area's rows of the stored dataset after two insert-ignores; other folders are not read."""
    path, rows = scratch_folder(spark, "insert"), supply_rows(spark, sf_dir)
    for odd in (0, 1):
        merge.insert_into(spark, rows.filter(F.col("event_id") % 2 == odd), path, SUPPLY, ["event_id"])
    return area_table(spark, path, 3).select("master_key", "slot", "area_demand")


@plan(f"""WITH {EVENTS_SQL}, {ROWS_SQL}, l AS (SELECT *, row_number() OVER (PARTITION BY area_code, master_key ORDER BY event_id % 2 DESC, event_id DESC) AS n FROM s)
SELECT area_code, master_key, slot, area_demand FROM l WHERE n = 1""")
def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored upserts of two batches: the last row per key of the last batch that has the key."""
    path, rows = scratch_folder(spark, "upsert"), supply_rows(spark, sf_dir)
    for odd in (0, 1):
        merge.upsert_into(spark, rows.filter(F.col("event_id") % 2 == odd), path, SUPPLY, ["event_id"])
    return merge.read_table(spark, path, SUPPLY).select("area_code", "master_key", "slot", "area_demand")


@plan(f"""WITH {EVENTS_SQL}, d AS (SELECT area_code, strftime(dt, '%Y%m%d') AS day, count(*) AS lines, CAST(sum(v) AS DOUBLE) AS demand FROM ev
  WHERE area_code <> 5 GROUP BY area_code, dt) SELECT area_code, day, lines, demand FROM d""")
def payload_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files kept with an id, their feed and day, and parsed from the store later."""
    path, files = scratch_folder(spark, "payloads"), supply_files(spark, sf_dir)
    feed = F.regexp_extract("path", r"landed/(\w+)/", 1)
    store_payloads(files, path, feed, F.to_date(F.regexp_extract("path", r"day_(\d{8})", 1), "yyyyMMdd"))
    stored = spark.read.schema(TABLES["downloaded_csv"].schema).parquet(path)
    area = area_of_path(F.col("path"))
    lines = piece_lines(stored_pieces(stored), nth_line(area_supply.HEADER_LINE),
                        lambda head, at: area_supply.positions(F.get(head, at.cast("int")), area), labels={"area_code": area})
    accepted = area_supply.accepted(area_supply.parse(lines))
    return accepted.groupBy("area_code", F.col("date").alias("day")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("area_demand").cast(EXACT)).cast("double").alias("demand"))


@plan("""SELECT CAST(c_custkey AS VARCHAR) AS primary_key, '47' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS station_id,
  strftime(DATE '2024-01-01' + CAST(c_custkey % 90 AS INTEGER), '%Y-%m-%d') AS date,
  strftime(DATE '2024-01-01' + CAST(c_custkey % 90 AS INTEGER), '%Y%m') AS month, c_name || ', "' || c_mktsegment || '"' AS weather_description
FROM customer""")
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as weather rows, written as CSV by station and month and read back with their quotes."""
    path, customer = scratch_folder(spark, "export"), table(spark, sf_dir, "customer")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 90).cast("int"))
    rows = customer.select(
        F.col("c_custkey").cast("string").alias("primary_key"), F.concat(F.lit("47"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("station_id"),
        F.date_format(day, "yyyy-MM-dd").alias("date"), F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"')).alias("weather_description"))
    export.export_weather(rows, path)
    schema = "primary_key string, station_id string, date string, weather_description string, station string, month string"
    read = spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", "\\").csv(path)
    return read.filter(F.col("station") == F.col("station_id")).select("primary_key", "station_id", "date", "month", "weather_description")


RENAMED = [name for _, _, name in PRICE_CELLS][2:6]


@plan(f"""SELECT CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) AS {RENAMED[0]}, CAST(NULL AS BIGINT) AS {RENAMED[1]}, strftime(o_orderdate, '%Y/%m/%d') AS date,
  CAST(o_orderkey % 48 + 1 AS INTEGER) AS slot FROM orders""")
def headers_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read with its published headers, renamed and projected onto the declared columns:
    texts get their types, and absent columns are null."""
    headers = {name: header for _, header, name in PRICE_CELLS}
    published = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias(headers[RENAMED[0]]), F.date_format("o_orderdate", "yyyy/MM/dd").alias(headers["date"]),
        (F.col("o_orderkey") % 48 + 1).cast("string").alias(headers["slot"]), F.lit("x").alias("another"))
    typed = enforce(spot_price.rename_headers(published), TABLES["jepx_da_price"])
    return typed.select(*RENAMED[:2], "date", "slot")


@plan(f"""WITH {EVENTS_SQL}, k AS (SELECT CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN 'rejected' ELSE 'accepted' END AS kind FROM ev)
SELECT kind, count(*) AS rows, (SELECT count(*) FROM ev) AS sent FROM k GROUP BY kind""")
def one_pass_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged files evaluated once: what loads, what does not, and that nothing is missing."""
    found = account(damaged_supply(spark, sf_dir), scratch_folder(spark, "account"), tuple(area_supply.KEPT_ISSUES))
    parts = [part.select(F.lit(kind).alias("kind")) for kind, part in (("accepted", found.accepted), ("rejected", found.rejected), ("unread", found.unread))]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy("kind").agg(F.count(F.lit(1)).alias("rows")).withColumn("sent", F.lit(found.sent).cast("bigint"))
