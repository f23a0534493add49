"""Market data: day-ahead prices and bid stacks from raw text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import BID_FEEDS, PRICE_CELLS, PRICE_HEADER_CELL
from gridspark.functions.text import fixed_or_na, settled, thousands_or_na
from gridspark.operators.dedup import keep_last
from gridspark.operators.reports import in_range, preview
from gridspark.operators.snapshots import SnapshotTable
from gridspark.plans.registry import EXACT, plan, table
from gridspark.schemas import TABLES
from gridspark.session import scratch_folder
from gridspark.sources import bid_stack as bids, spot_price
from gridspark.sources.lines import attach_heads, first_cell_heads

HEADER_WIDTH = 48


def price_text(orders: DataFrame) -> DataFrame:
    """Orders as price files, one per status: a title, a header, a blank line, then data.

    Quantities carry a decimal part, one status writes short rows, some prices are text.
    """
    amount = F.col("o_totalprice").cast(EXACT).cast("string")
    filled = {
        0: F.date_format("o_orderdate", "yyyy/MM/dd"),
        1: (F.col("o_orderkey") % 48 + 1).cast("string"),
        2: F.concat(F.col("o_custkey").cast("string"), F.lit(".0")),
        4: amount,
        5: amount,
        8: F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.col("o_custkey").cast("string")),
        22: amount,
        47: F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(".125")),
    }
    full = F.concat_ws(",", *[filled.get(i, F.lit("")) for i in range(48)])
    short = F.concat_ws(",", *[filled.get(i, F.lit("")) for i in range(9)])
    path = F.concat(F.lit("landed/spot_"), F.col("o_orderstatus"), F.lit(".csv"))
    data = orders.select(
        path.alias("path"), F.lit(0).cast("bigint").alias("seg"), (F.col("o_orderkey") + 10).alias("line_no"),
        F.when(F.col("o_orderstatus") == "P", short).otherwise(full).alias("line"),
    )
    headers = dict((number, header) for number, header, _ in PRICE_CELLS)
    header = ",".join(headers.get(i, "") for i in range(HEADER_WIDTH))
    preamble = F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("line_no"), F.lit(line).alias("line"))
        for i, line in [(0, "spot"), (1, header), (2, ",,,")]
    ])
    heads = orders.select(path.alias("path")).distinct().select(
        "path", F.lit(0).cast("bigint").alias("seg"), F.inline(preamble)
    )
    return settled(heads.unionByName(data))


def parsed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = price_text(table(spark, sf_dir, "orders"))
    lines = attach_heads(text, first_cell_heads(text, PRICE_HEADER_CELL), F.array(F.lit(0)), broadcast=True)
    return spot_price.parse(lines.filter(F.col("positions").isNotNull()))


PRICES_SQL = """p AS (
  SELECT *, row_number() OVER (PARTITION BY dt, slot ORDER BY o_orderstatus DESC, o_orderkey DESC) AS n FROM (
    SELECT *, CAST(o_orderdate AS DATE) AS dt, CAST(o_orderkey % 48 + 1 AS INTEGER) AS slot FROM orders)),
price AS (
  SELECT strftime(dt, '%Y-%m-%d') AS date, slot, o_custkey AS sell_bid_qty_kwh,
         CAST(NULL AS BIGINT) AS buy_bid_qty_kwh,
         CAST(floor(o_totalprice) AS BIGINT) AS contract_qty_kwh,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS ap0_system,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS DOUBLE) END AS ap3_tokyo,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END
           AS avoidable_cost_national,
         CASE WHEN o_orderstatus <> 'P' THEN o_custkey + 0.13 END AS fip_ref_price_kyushu
  FROM p WHERE n = 1)"""


def latest_prices(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    """The last price per day and slot; the day is part of the key, so a range is cut out first."""
    accepted = spot_price.accepted(parsed_prices(spark, sf_dir))
    if days:
        accepted = in_range(accepted, "dt", *[F.lit(day).cast("date") for day in days])
    return keep_last(accepted, ["date", "slot"], ["path", "seg", "line_no"])


@plan(f"""WITH {PRICES_SQL} SELECT date, slot, sell_bid_qty_kwh, buy_bid_qty_kwh, contract_qty_kwh, ap0_system, ap3_tokyo,
  avoidable_cost_national, CAST(fip_ref_price_kyushu AS DOUBLE) AS fip_ref_price_kyushu FROM price""")
def spot_price_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_prices(spark, sf_dir).select(
        "date", "slot", "sell_bid_qty_kwh", "buy_bid_qty_kwh", "contract_qty_kwh",
        *[F.col(n).cast("double").alias(n)
          for n in ("ap0_system", "ap3_tokyo", "avoidable_cost_national", "fip_ref_price_kyushu")],
    )


@plan(f"""WITH {PRICES_SQL} SELECT date, slot, printf('%.2f', ap0_system) AS system_price,
  CASE WHEN ap3_tokyo IS NULL THEN 'N/A' ELSE printf('%.2f', ap3_tokyo) END AS tokyo_price,
  format('{{:,}}', contract_qty_kwh) AS contract_qty
FROM price WHERE date BETWEEN '1996-01-01' AND '1997-12-31' ORDER BY date, slot LIMIT 10""")
def price_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = latest_prices(spark, sf_dir, ("1996-01-01", "1997-12-31"))
    return preview(prices, [F.col("date"), F.col("slot")]).select(
        "date", "slot", fixed_or_na(F.col("ap0_system")).alias("system_price"),
        fixed_or_na(F.col("ap3_tokyo")).alias("tokyo_price"), thousands_or_na(F.col("contract_qty_kwh")).alias("contract_qty"),
    )


# --- bids ------------------------------------------------------------------------

STEP_ORDER = ["seg", "line_no", *bids.POINT]


def exact_text(name: str) -> Column:
    return F.col(name).cast(EXACT).cast("string")


def bid_text(lineitem: DataFrame) -> DataFrame:
    """Line items as price steps; order and line number are the position in the file."""
    line = F.concat_ws(
        ",", F.date_format("l_shipdate", "yyyyMMdd"), (F.col("l_orderkey") % 48 + 1).cast("string"),
        exact_text("l_extendedprice"), exact_text("l_quantity"), exact_text("l_discount"),
        (F.col("l_suppkey") % 9 + 1).cast("string"),
    )
    return lineitem.select(
        F.col("l_orderkey").alias("seg"), F.col("l_linenumber").cast("bigint").alias("line_no"), line.alias("line")
    )


def bid_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bids.accepted(bids.parse(bid_text(table(spark, sf_dir, "lineitem"))))


def bid_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounded arrays: a key's steps of neighbouring orders."""
    return bids.segments(bid_steps(spark, sf_dir), STEP_ORDER, [F.floor(F.col("seg") / 1024)])


BIDS_SQL = """b AS (
  SELECT strftime(l_shipdate, '%Y%m%d') AS date, CAST(l_orderkey % 48 + 1 AS INTEGER) AS slot,
         CAST(l_suppkey % 9 + 1 AS INTEGER) AS area_code, l_orderkey AS k1, l_linenumber AS k2,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
         CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS sell_qty,
         CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) AS buy_qty FROM lineitem),
k AS (SELECT date || '_' || slot || '_' || area_code AS id, * FROM b)"""
BID_LIST_SQL = """CAST(to_json(list({'price': price, 'sell_qty': sell_qty, 'buy_qty': buy_qty}
  ORDER BY k1, k2, price, sell_qty, buy_qty)) AS VARCHAR)"""


@plan(f"WITH {BIDS_SQL} SELECT id, date, slot, area_code, {BID_LIST_SQL} AS bid FROM k GROUP BY id, date, slot, area_code")
def bid_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bids.stacks(bid_parts(spark, sf_dir)).withColumn("bid", bids.bid_json(F.col("bid")))


@plan(f"""WITH {BIDS_SQL} SELECT id, date, slot, area_code, k1 // 1024 AS segment, {BID_LIST_SQL} AS bid
FROM k GROUP BY id, date, slot, area_code, k1 // 1024""")
def bid_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bid_parts(spark, sf_dir).select(
        *bids.KEY, F.col("segment.segment0").alias("segment"), bids.bid_json(F.col("bid")).alias("bid")
    )


@plan(f"""WITH {BIDS_SQL} SELECT id, date, slot, area_code, first(price ORDER BY k1, k2, price, sell_qty, buy_qty) AS first_price,
  first(sell_qty ORDER BY k1, k2, price, sell_qty, buy_qty) AS first_sell_qty,
  first(buy_qty ORDER BY k1, k2, price, sell_qty, buy_qty) AS first_buy_qty, CAST(count(*) AS INTEGER) AS points
FROM k GROUP BY id, date, slot, area_code""")
def bid_stack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bids.first_and_size_of_steps(bid_steps(spark, sf_dir), ["seg", "line_no"])


@plan("""WITH l AS (SELECT strftime(l_shipdate, '%Y%m%d') || '_' || (l_orderkey % 48 + 1) || '_' || (l_suppkey % 9 + 1) AS id,
  l_returnflag = 'R' AS later, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price, l_orderkey * 8 + l_linenumber AS place FROM lineitem),
m AS (SELECT *, bool_or(later) OVER (PARTITION BY id) AS replaced FROM l),
n AS (SELECT id, price, place, row_number() OVER (PARTITION BY id, place ORDER BY price) AS k FROM m WHERE later OR NOT replaced)
SELECT id, first(price ORDER BY place, price) AS first_price, count(*) AS points FROM n GROUP BY id""")
def bid_segment_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as two feeds stored one after the other: an id of the later feed replaces the whole
    stack of the earlier one. Stacks are stored in segments and never as one row."""
    item = table(spark, sf_dir, "lineitem")
    text = item.select(
        F.concat_ws(",", F.date_format("l_shipdate", "yyyyMMdd"), (F.col("l_orderkey") % 48 + 1).cast("string"), exact_text("l_extendedprice"),
                    exact_text("l_quantity"), exact_text("l_discount"), (F.col("l_suppkey") % 9 + 1).cast("string")).alias("line"),
        F.lit(0).cast("bigint").alias("seg"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_no"), "l_returnflag")
    stored = SnapshotTable(spark, scratch_folder(spark, "bid-segments"), TABLES["jepx_bid_segments"], use_filters=False)
    for feed, rows in ((BID_FEEDS[0], text), (BID_FEEDS[1], text.filter("l_returnflag = 'R'"))):
        bids.store_segments(stored, bids.parse(rows.drop("l_returnflag").withColumn("path", F.lit(f"landed/{feed}.csv"))))
    return bids.first_and_size_of_segments(stored.read()).select("id", "first_price", "points")


@plan(f"""WITH {BIDS_SQL}, s AS (SELECT id, first(price ORDER BY k1, k2, price, sell_qty, buy_qty) AS price,
  first(sell_qty ORDER BY k1, k2, price, sell_qty, buy_qty) AS sell_qty,
  first(buy_qty ORDER BY k1, k2, price, sell_qty, buy_qty) AS buy_qty,
  count(*) AS n, date, slot, area_code FROM k GROUP BY id, date, slot, area_code)
SELECT date, slot, area_code, price AS first_price, sell_qty AS first_sell_qty, buy_qty AS first_buy_qty,
  n || ' points' AS total_points FROM s
WHERE date BETWEEN '19960101' AND '19971231' ORDER BY date, slot, area_code LIMIT 10""")
def bid_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = bid_steps(spark, sf_dir).filter(F.col("date").between("19960101", "19971231"))
    firsts = bids.first_and_size_of_steps(steps, ["seg", "line_no"])
    return preview(firsts, [F.col("date"), F.col("slot"), F.col("area_code")]).select(
        "date", "slot", "area_code", "first_price", "first_sell_qty", "first_buy_qty", F.concat("points", F.lit(" points")).alias("total_points")
    )
