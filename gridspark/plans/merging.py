"""Merges: insert-ignore, upserts, watermark loads, routing, ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.dims import AREA_IDS, area_code_of, area_id_of, lookup
from gridspark.functions.dates import clamp_future_year
from gridspark.operators import merge
from gridspark.operators.bucketed import BucketedTable
from gridspark.operators.dedup import duplicate_groups, duplicate_rows, duplicate_summary, first_usable, keep_first
from gridspark.operators.ledger import dense_ids, ledger_entries
from gridspark.operators.routing import table_name, with_area
from gridspark.operators.snapshots import SnapshotTable
from gridspark.plans.registry import EVENTS_SQL, plan, slot_events, table
from gridspark.schemas import TABLES
from gridspark.session import scratch_folder

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
              "l_linestatus", "l_shipdate"]
LINE_COLUMNS = [*LINE_KEY, *LINE_ORDER]


def line_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A keyed target from one half of the line items, and the other half as a batch."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    odd = F.col("l_partkey") % 2 == 1
    return keep_first(lines.filter(odd), LINE_KEY, LINE_ORDER), lines.filter(~odd)


LINE_RANK_SQL = f"row_number() OVER (PARTITION BY {', '.join(LINE_KEY)} ORDER BY {', '.join(LINE_ORDER)}) AS n"
LINES_SQL = f"""target AS (SELECT * FROM (SELECT *, {LINE_RANK_SQL} FROM lineitem WHERE l_partkey % 2 = 1) WHERE n = 1),
batch AS (SELECT * FROM (SELECT *, {LINE_RANK_SQL} FROM lineitem WHERE l_partkey % 2 = 0) WHERE n = 1),
added AS (SELECT b.* FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM target t WHERE t.l_orderkey = b.l_orderkey AND t.l_linenumber = b.l_linenumber))"""
LINE_OUT = ", ".join(LINE_COLUMNS)


@plan(f"WITH {LINES_SQL} SELECT {LINE_OUT} FROM target UNION ALL SELECT {LINE_OUT} FROM added")
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = line_halves(spark, sf_dir)
    return merge.insert_ignore(target, batch, LINE_KEY, LINE_ORDER)


@plan(f"""WITH {LINES_SQL}, s AS (SELECT count(*) AS sent FROM lineitem WHERE l_partkey % 2 = 0),
a AS (SELECT count(*) AS inserted FROM added)
SELECT inserted, sent, sent - inserted AS ignored FROM s, a""")
def affected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = line_halves(spark, sf_dir)
    return merge.affected_counts(target, batch, LINE_KEY, LINE_ORDER)


@plan(f"""WITH {LINES_SQL}, b AS (SELECT * FROM lineitem WHERE l_partkey % 2 = 0)
SELECT b.l_returnflag, count(t.l_orderkey) AS updates, count(*) - count(t.l_orderkey) AS inserts
FROM b LEFT JOIN target t ON t.l_orderkey = b.l_orderkey AND t.l_linenumber = b.l_linenumber GROUP BY b.l_returnflag""")
def update_insert_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = line_halves(spark, sf_dir)
    total = batch.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"))
    known = merge.existing_rows(target, batch, LINE_KEY).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("updates"))
    updates = F.coalesce("updates", F.lit(0))
    return total.join(known, "l_returnflag", "left").select(
        "l_returnflag", updates.alias("updates"), (F.col("rows") - updates).alias("inserts")
    )


# --- stored tables that change by commits -----------------------------------------------------------


def price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as price rows: many share a day and slot."""
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), (F.col("o_custkey") % 4 + 1).cast("int").alias("slot"),
        F.col("o_orderkey").alias("sell_bid_qty_kwh"), F.col("o_custkey").cast("bigint").alias("buy_bid_qty_kwh"))


def odd_then_even(spark: SparkSession, sf_dir: str) -> tuple[SnapshotTable, DataFrame]:
    """A stored table of the odd orders, and the even ones as the next batch."""
    rows, odd = price_rows(spark, sf_dir), F.col("sell_bid_qty_kwh") % 2 == 1
    stored = SnapshotTable(spark, scratch_folder(spark, "prices"), TABLES["jepx_da_price"])
    stored.insert(rows.filter(odd), ["sell_bid_qty_kwh"])
    return stored, rows.filter(~odd)


PRICE_ROWS_SQL = """p AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(o_custkey % 4 + 1 AS INTEGER) AS slot, o_orderkey AS sell_bid_qty_kwh,
  CAST(o_custkey AS BIGINT) AS buy_bid_qty_kwh, o_orderkey % 2 AS odd FROM orders)"""


@plan(f"""WITH {PRICE_ROWS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY date, slot ORDER BY odd DESC, sell_bid_qty_kwh) AS n FROM p)
SELECT date, slot, sell_bid_qty_kwh, buy_bid_qty_kwh FROM n WHERE n = 1""")
def snapshot_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two commits that add only unknown keys, the second past the key filters of the first."""
    stored, batch = odd_then_even(spark, sf_dir)
    stored.insert(batch, ["sell_bid_qty_kwh"])
    return stored.read().select("date", "slot", "sell_bid_qty_kwh", "buy_bid_qty_kwh")


@plan(f"""WITH {PRICE_ROWS_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY date, slot ORDER BY sell_bid_qty_kwh) AS n FROM p WHERE odd = 1),
e AS (SELECT *, row_number() OVER (PARTITION BY date, slot ORDER BY sell_bid_qty_kwh DESC) AS n FROM p WHERE odd = 0),
t AS (SELECT * FROM o WHERE n = 1), b AS (SELECT * FROM e WHERE n = 1)
SELECT coalesce(t.date, b.date) AS date, coalesce(t.slot, b.slot) AS slot, coalesce(b.sell_bid_qty_kwh, t.sell_bid_qty_kwh) AS sell_bid_qty_kwh,
  coalesce(t.buy_bid_qty_kwh, b.buy_bid_qty_kwh) AS buy_bid_qty_kwh FROM t FULL JOIN b ON t.date = b.date AND t.slot = b.slot""")
def snapshot_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A commit that replaces known keys in one column and adds unknown ones, on top of an insert."""
    stored, batch = odd_then_even(spark, sf_dir)
    stored.upsert(batch, ["sell_bid_qty_kwh"], ["sell_bid_qty_kwh"])
    return stored.read().select("date", "slot", "sell_bid_qty_kwh", "buy_bid_qty_kwh")


BUCKETED_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def bucketed_lines(spark: SparkSession, sf_dir: str) -> tuple[BucketedTable, DataFrame]:
    """A bucketed table of the line items with odd parts, and the others as the next batch."""
    lines = table(spark, sf_dir, "lineitem").select(*BUCKETED_COLUMNS)
    stored = BucketedTable(spark, scratch_folder(spark, "lines"), lines.schema, LINE_KEY, 8)
    stored.insert(lines.filter("l_partkey % 2 = 1"), ["l_partkey", "l_suppkey"])
    return stored, lines.filter("l_partkey % 2 = 0")


BUCKETED_SQL = """l AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey % 2 AS odd FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS n FROM l WHERE odd = 1),
e AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS first,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey DESC, l_suppkey DESC) AS last FROM l WHERE odd = 0)"""


@plan(f"""WITH {BUCKETED_SQL} SELECT {", ".join(BUCKETED_COLUMNS)} FROM e WHERE last = 1 UNION ALL
SELECT {", ".join("o." + c for c in BUCKETED_COLUMNS)} FROM o ANTI JOIN e ON o.l_orderkey = e.l_orderkey AND o.l_linenumber = e.l_linenumber WHERE n = 1""")
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows replaced in a table that lies in buckets of its key and does not move."""
    stored, batch = bucketed_lines(spark, sf_dir)
    stored.upsert(batch, ["l_partkey", "l_suppkey"])
    return stored.read()


@plan(f"""WITH {BUCKETED_SQL} SELECT {", ".join(BUCKETED_COLUMNS)} FROM o WHERE n = 1 UNION ALL
SELECT {", ".join("e." + c for c in BUCKETED_COLUMNS)} FROM e ANTI JOIN o ON o.l_orderkey = e.l_orderkey AND o.l_linenumber = e.l_linenumber WHERE first = 1""")
def bucketed_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows with unknown keys added to the same table."""
    stored, batch = bucketed_lines(spark, sf_dir)
    stored.insert(batch, ["l_partkey", "l_suppkey"])
    return stored.read()


@plan("""WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL)
SELECT count(*) FILTER (copies > 1) AS repeated_keys, CAST(sum(copies) FILTER (copies > 1) AS BIGINT) AS rows_in_groups,
       CAST(sum(copies - 1) FILTER (copies > 1) AS BIGINT) AS rows_removed FROM g""")
def duplicate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_summary(table(spark, sf_dir, "lineitem"), LINE_KEY)


@plan("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "lineitem"), LINE_KEY)


@plan("""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem) WHERE copies > 1""")
def duplicate_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_partkey", "l_shipdate")
    return duplicate_rows(lines, LINE_KEY)


# --- upserts ---------------------------------------------------------------------

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
TARGET_END = "1999-01-01"
BATCH_START = "1997-01-01"


def order_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders up to a day as target; from an earlier day on as batch, some keys sent twice
    and some columns sent as null."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    target = orders.filter(F.col("o_orderdate") < F.lit(TARGET_END).cast("timestamp_ntz"))
    sent = orders.filter(F.col("o_orderdate") >= F.lit(BATCH_START).cast("timestamp_ntz"))
    first = sent.withColumn("o_orderpriority", F.lit("first")).withColumn("batch_seq", F.lit(1))
    again = sent.filter(F.col("o_custkey") % 2 == 1).withColumn("batch_seq", F.lit(2)).withColumn(
        "o_orderpriority", F.when(F.col("o_orderstatus") != "F", "second")
    )
    return target, first.unionByName(again).withColumn("o_totalprice", F.col("o_totalprice") + 1)


ORDERS_SQL = f"""target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{TARGET_END}'),
latest AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
    CASE WHEN o_custkey % 2 = 0 THEN 'first' WHEN o_orderstatus <> 'F' THEN 'second' END AS o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '{BATCH_START}')"""
ORDER_OUT = ", ".join(ORDER_COLUMNS)


@plan(f"""WITH {ORDERS_SQL} SELECT {ORDER_OUT} FROM latest UNION ALL
SELECT {ORDER_OUT} FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM latest)""")
def upsert_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = order_halves(spark, sf_dir)
    return merge.upsert(target, batch, ["o_orderkey"], ["batch_seq"])


@plan(f"""WITH {ORDERS_SQL} SELECT o_orderkey, coalesce(t.o_custkey, b.o_custkey) AS o_custkey,
  coalesce(t.o_orderstatus, b.o_orderstatus) AS o_orderstatus, coalesce(t.o_totalprice, b.o_totalprice) AS o_totalprice,
  coalesce(t.o_orderdate, b.o_orderdate) AS o_orderdate,
  CASE WHEN b.o_custkey IS NOT NULL THEN b.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority
FROM target t FULL JOIN latest b USING (o_orderkey)""")
def upsert_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = order_halves(spark, sf_dir)
    return merge.upsert_columns(target, batch, ["o_orderkey"], ["o_orderpriority"], ["batch_seq"])


@plan(f"""WITH {ORDERS_SQL} SELECT {ORDER_OUT} FROM target UNION ALL
SELECT {ORDER_OUT} FROM latest WHERE o_orderdate > (SELECT max(o_orderdate) FROM target)""")
def watermark_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = order_halves(spark, sf_dir)
    return merge.watermark_append(target, batch, ["o_orderkey"], "o_orderdate", [F.desc("batch_seq")])


@plan("""SELECT o_orderkey, CASE WHEN year(o_orderdate) > 1998
    THEN TRY_CAST('1998' || strftime(o_orderdate, '-%m-%d') AS DATE) ELSE CAST(o_orderdate AS DATE) END AS day
FROM orders WHERE NOT (year(o_orderdate) > 1998 AND month(o_orderdate) = 2 AND day(o_orderdate) = 29)""")
def future_year_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = clamp_future_year(F.to_date("o_orderdate"), 1998)
    return table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day")).filter(F.col("day").isNotNull())


# --- routing, candidates, ledger -------------------------------------------------


def area_values() -> str:
    return ", ".join(f"({code}, '{area_id}')" for code, area_id in AREA_IDS.items())


def area_id_or_foreign() -> Column:
    """Area ids of events; errors come from an area nobody knows."""
    known = lookup(AREA_IDS, F.col("area_code"))
    return F.when(F.col("event_type") == "error", F.concat(F.lit("x"), known)).otherwise(known)


@plan(f"""WITH {EVENTS_SQL}, a(code, tso_id) AS (VALUES {area_values()})
SELECT event_id, CASE WHEN event_type = 'error' THEN 'x' || tso_id || '_demand'
    ELSE 'tso_area_' || code || '_data' END AS table_name,
  CASE WHEN event_type = 'error' THEN 'load' ELSE 'load_' || tso_id END AS prefixed_name,
  CASE WHEN event_type <> 'error' THEN area_code END AS found_code, tso_id AS found_id
FROM ev JOIN a ON a.code = area_code""")
def append_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = slot_events(spark, sf_dir).withColumn("tso_id", area_id_or_foreign())
    return events.select(
        "event_id", table_name(F.col("tso_id"), "demand").alias("table_name"),
        table_name(F.col("tso_id"), "demand", "load").alias("prefixed_name"),
        area_code_of(F.col("tso_id")).alias("found_code"), area_id_of(F.col("area_code")).alias("found_id"),
    )


@plan(f"""WITH {EVENTS_SQL}, a(code, tso_id) AS (VALUES {area_values()})
SELECT tso_id, area_code, count(*) AS events FROM ev JOIN a ON a.code = area_code GROUP BY tso_id, area_code""")
def area_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = slot_events(spark, sf_dir).groupBy("area_code").agg(F.count(F.lit(1)).alias("events"))
    return with_area(counted).select("tso_id", "area_code", "events")


@plan("""SELECT p_brand, p_type, p_partkey, p_size FROM (SELECT *, row_number() OVER (
  PARTITION BY p_brand, p_type ORDER BY p_size, p_partkey) AS n FROM part WHERE length(p_name) > 9) WHERE n = 1""")
def candidate_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable = F.length("p_name") > 9
    best = first_usable(table(spark, sf_dir, "part"), ["p_brand", "p_type"], ["p_size", "p_partkey"], usable)
    return best.select("p_brand", "p_type", "p_partkey", "p_size")


def file_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attempt per day and event type; days of few events count as failed."""
    return slot_events(spark, sf_dir).groupBy("dt", "event_type").agg(F.count(F.lit(1)).alias("rows"))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("event_type", F.lit("_"), F.date_format("dt", "yyyyMMdd"), F.lit(".csv"))
    return ledger_entries(
        file_attempts(spark, sf_dir), F.col("event_type"), F.col("dt"), name, F.col("rows") % 10 != 0,
        F.col("rows").cast("string"),
    )


LEDGER_SQL = f"""{EVENTS_SQL}, f AS (SELECT dt, event_type, count(*) AS rows FROM ev GROUP BY ALL),
l AS (SELECT event_type AS dir_name, dt AS date, event_type || '_' || strftime(dt, '%Y%m%d') || '.csv' AS filename,
  CASE WHEN rows % 10 <> 0 THEN 'success' ELSE 'failed: ' || rows END AS status FROM f)"""


@plan(f"WITH {LEDGER_SQL} SELECT dir_name, date, filename, status FROM l")
def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark, sf_dir)


@plan(f"WITH {LEDGER_SQL} SELECT row_number() OVER (ORDER BY date, filename) AS id, dir_name, date, filename, status FROM l")
def surrogate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dense_ids(entries(spark, sf_dir), ["date", "filename"])
