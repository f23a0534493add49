"""Landed bytes: files and archives made of the given tables, read by the same readers as real ones.

Files are bounded by what they stand for: an area's day, a day's line items, a status and month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import COMPACT_DATE_AREA, PRICE_CELLS, PRICE_HEADER_CELL
from gridspark.dims import AREA_IDS, lookup
from gridspark.functions.dates import clock_of_slot
from gridspark.functions.text import BOM, JAPANESE
from gridspark.operators.dedup import keep_first
from gridspark.operators.ledger import file_outcomes
from gridspark.plans.market import HEADER_WIDTH, exact_text
from gridspark.plans.registry import EVENTS_SQL, EXACT, plan, slot_events, table
from gridspark.sources import area_supply, bid_stack, spot_price, unit_generation, weather
from gridspark.sources.archives import CHUNK_BYTES, SPOOL_BYTES, file_rejects, in_chunks
from gridspark.sources.files import archive_pieces, area_of_path, whole_pieces
from gridspark.sources.lines import first_cell_line, nth_line, piece_lines, with_headless


def written(lines: DataFrame, head: Column, charset: Column | None = None) -> DataFrame:
    """`path` and `content` of files whose lines follow a head by `place`; Japanese code page where
    `charset` says so, UTF-8 with a byte-order mark elsewhere."""
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "\r\n")
    files = lines.groupBy("path").agg(F.first(head).alias("head"), F.first(charset if charset is not None else F.lit(True)).alias("legacy"), body.alias("body"))
    text = F.concat("head", F.lit("\r\n"), "body", F.lit("\r\n"))
    content = F.when(F.col("legacy"), F.encode(text, JAPANESE)).otherwise(F.concat(F.lit(BOM), text).cast("binary"))
    return files.select("path", content.alias("content"))


# --- plain files ---------------------------------------------------------------------------

NO_DATE_AREA = 5


def supply_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one file per area and day: odd areas in the Japanese code page, one area without a date column."""
    events = slot_events(spark, sf_dir)
    area = F.col("area_code")
    day = F.when(area == COMPACT_DATE_AREA, F.date_format("dt", "yyyyMMdd")).otherwise(F.date_format("dt", "yyyy/MM/dd"))
    cells = F.concat_ws(",", clock_of_slot(F.col("slot")), F.concat(F.lit('"'), F.format_number("value", 2), F.lit('"')))
    head = F.concat(F.lit("表題\r\n\r\n"), F.when(area == NO_DATE_AREA, "TIME,エリア需要").otherwise("DATE,TIME,エリア需要"))
    lines = events.select(
        F.concat(F.lit("landed/"), lookup(AREA_IDS, area), F.lit("/day_"), F.date_format("dt", "yyyyMMdd"), F.lit(".csv")).alias("path"),
        F.col("event_id").alias("place"), F.when(area == NO_DATE_AREA, cells).otherwise(F.concat_ws(",", day, cells)).alias("line"),
        head.alias("head"), (area % 2 == 1).alias("legacy"),
    )
    return written(lines, F.col("head"), F.col("legacy"))


def landed_supply_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = area_of_path(F.col("path"))
    lines = piece_lines(whole_pieces(supply_files(spark, sf_dir)), nth_line(area_supply.HEADER_LINE),
                        lambda head, at: area_supply.positions(F.get(head, at.cast("int")), area), labels={"area_code": area})
    return area_supply.parse(lines)


@plan(f"""WITH {EVENTS_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY area_code, dt, slot ORDER BY event_id) AS n FROM ev)
SELECT area_code, strftime(dt, '%Y%m%d') || '_' || slot AS master_key, slot, CAST(v AS DOUBLE) AS area_demand
FROM f WHERE n = 1 AND area_code <> {NO_DATE_AREA}""")
def landed_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return area_supply.canonical(landed_supply_rows(spark, sf_dir)).select("area_code", "master_key", "slot", "area_demand")


@plan(f"""WITH {EVENTS_SQL} SELECT area_code, strftime(dt, '%Y%m%d') AS day,
  CASE WHEN area_code = {NO_DATE_AREA} THEN 'missing_required_column' END AS issue, count(*) AS lines
FROM ev GROUP BY area_code, dt""")
def landed_supply_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per file and issue: a file that lacks a required column rejects them all."""
    day = F.regexp_extract("path", r"day_(\d+)", 1).alias("day")
    return landed_supply_rows(spark, sf_dir).groupBy("area_code", day, "issue").agg(F.count(F.lit(1)).alias("lines"))


DAILY_HEAD = "\r\n".join(["a", "b", "c", "年月日,平均気温(℃),平均気温(℃),合計全天日射量(MJ/㎡),降水量(mm),日照時間(時間)", ",,品質情報,,,"])


def station_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as daily weather files, one per nation and segment; some days are hourly stamps."""
    customer = table(spark, sf_dir, "customer")
    station = F.concat(F.lit("47"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0"))
    day = F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), (F.col("c_custkey") % 365).cast("int")), "yyyy/M/d")
    stamp = F.when(F.col("c_custkey") % 10 == 0, F.concat(day, F.lit(" 1:00"))).otherwise(day)
    values = [stamp, exact_text("c_acctbal"), F.lit("8"), F.lit("10.5"), F.lit("--"), F.col("c_custkey").cast("string")]
    return written(customer.select(
        F.concat(F.lit("landed/jma_weather_"), station, F.lit("_"), F.col("c_mktsegment"), F.lit(".csv")).alias("path"),
        F.col("c_custkey").alias("place"), F.concat_ws(",", *values).alias("line")), F.lit(DAILY_HEAD))


@plan("""WITH c AS (SELECT '47' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS station_id, DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS dt, *
  FROM customer WHERE c_custkey % 10 <> 0),
f AS (SELECT *, row_number() OVER (PARTITION BY station_id, dt ORDER BY c_mktsegment, c_custkey) AS n FROM c)
SELECT station_id || '_' || strftime(dt, '%Y%m%d') || '0000' AS primary_key, station_id, strftime(dt, '%Y-%m-%d') AS date, '00:00' AS time,
  CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS temperature, CAST(c_custkey AS DOUBLE) AS sunshine_duration,
  CAST(10.5 AS DOUBLE) AS global_solar_radiation, CAST(NULL AS DOUBLE) AS precipitation
FROM f WHERE n = 1""")
def landed_daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    def place(head: Column) -> Column:
        return weather.positions(F.get(head, F.lit(weather.UPPER_HEADER_LINE - 1)), F.get(head, F.lit(weather.LOWER_HEADER_LINE - 1)), "daily")

    lines = piece_lines(whole_pieces(station_files(spark, sf_dir)), nth_line(weather.LOWER_HEADER_LINE, skip_blank=False),
                        lambda head, at: place(head), JAPANESE, {"station_id": weather.station_of_path(F.col("path"))})
    accepted = weather.accepted(weather.parse(lines, "daily"))
    return keep_first(accepted, ["primary_key"], weather.ORDER).select(
        "primary_key", "station_id", "date", "time", "temperature", "sunshine_duration", "global_solar_radiation", "precipitation")


# --- bid lines that are short or unreadable ------------------------------------------------


def bid_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as one bid file per day; some lines lack cells, some name no slot or no area."""
    item, number = table(spark, sf_dir, "lineitem"), F.col("l_linenumber")
    slot = F.when(number == 6, "slot").otherwise((F.col("l_orderkey") % 48 + 1).cast("string"))
    cells = [F.date_format("l_shipdate", "yyyyMMdd"), slot, exact_text("l_extendedprice"), exact_text("l_quantity")]
    rest = [exact_text("l_discount"), F.when(number == 5, "").otherwise((F.col("l_suppkey") % 9 + 1).cast("string"))]
    line = F.when(number == 7, F.concat_ws(",", *cells)).otherwise(F.concat_ws(",", *cells, *rest))
    return written(item.select(
        F.concat(F.lit("landed/spot_bid_curves_"), F.date_format("l_shipdate", "yyyyMMdd"), F.lit(".csv")).alias("path"),
        (F.col("l_orderkey") * 8 + number).alias("place"), line.alias("line")), F.lit("date,slot,price,sell,buy,area"), F.lit(False))


@plan("""WITH l AS (SELECT strftime(l_shipdate, '%Y%m%d') AS day, CASE l_linenumber WHEN 7 THEN 'too_few_cells' WHEN 6 THEN 'invalid_slot'
  WHEN 5 THEN 'invalid_area' END AS issue FROM lineitem),
a AS (SELECT * FROM l UNION ALL SELECT DISTINCT day, 'invalid_slot' FROM l)
SELECT day, issue, count(*) AS lines FROM a GROUP BY day, issue""")
def landed_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per file and issue; a file's header is one more line without a slot."""
    parsed = bid_stack.parse(bid_stack.piece_steps(whole_pieces(bid_files(spark, sf_dir))))
    day = F.regexp_extract("path", r"_(\d{8})\.csv$", 1).alias("day")
    return parsed.groupBy(day, "issue").agg(F.count(F.lit(1)).alias("lines"))


# --- archives --------------------------------------------------------------------------------


def zipped(files: DataFrame) -> DataFrame:
    """Archives of the files in `path`, `entry`, `content`, in chunks: rows of `path`, `at` and `part`, one
    archive's after the other's. An archive names an entry once."""
    size, spool = CHUNK_BYTES, SPOOL_BYTES

    def pack(batches):
        import tempfile
        import zipfile

        import pyarrow as pa

        def packed(path, file):
            file.seek(0)
            at = 0
            while some := file.read(size * 256):
                parts = [some[i:i + size] for i in range(0, len(some), size)]
                columns = [pa.array([path] * len(parts), pa.string()), pa.array(range(at, at + len(parts)), pa.int32()), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["path", "at", "part"])
                at += len(parts)
            file.close()

        open_path = file = target = entry = None
        for batch in batches:
            paths, names, places, parts = (batch.column(name) for name in ("path", "entry", "at", "part"))
            for i in range(batch.num_rows):
                path = paths[i].as_py()
                if places[i].as_py() == 0:
                    if entry is not None:
                        entry.close()
                    if target is None or path != open_path:
                        if target is not None:
                            target.close()
                            yield from packed(open_path, file)
                        open_path, file = path, tempfile.SpooledTemporaryFile(spool)
                        target = zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED)
                    entry = target.open(names[i].as_py(), "w")
                if parts[i].is_valid:
                    entry.write(parts[i].as_buffer())
        if target is not None:
            entry.close()
            target.close()
            yield from packed(open_path, file)

    chunks = in_chunks(files, "path", "entry").repartition("path").sortWithinPartitions("path", "entry", "at")
    return chunks.mapInArrow(pack, "path string, at int, part binary")


def price_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as archives per status and month with two entries: in June one of them has no header,
    and the archives of pending orders are cut short."""
    orders, header = table(spark, sf_dir, "orders"), ",".join({n: h for n, h, _ in PRICE_CELLS}.get(i, "") for i in range(HEADER_WIDTH))
    odd = F.col("o_orderkey") % 2 == 1
    stem = F.concat(F.col("o_orderstatus"), F.lit("_"), F.date_format("o_orderdate", "yyyyMM"))
    line = F.concat_ws(",", F.date_format("o_orderdate", "yyyy/MM/dd"), (F.col("o_orderkey") % 48 + 1).cast("string"),
                       F.col("o_orderkey").cast("string"), F.lit(""), F.lit(""), F.col("o_totalprice").cast(EXACT).cast("string"))
    bare = odd & (F.month("o_orderdate") == 6)
    lines = orders.select(
        F.concat(F.lit("landed/"), stem, F.lit(".zip|"), F.when(odd, "y.csv").otherwise("x.csv")).alias("path"), F.col("o_orderkey").alias("place"),
        line.alias("line"), F.when(bare, "注意,,").otherwise("spot\r\n" + header).alias("head"))
    files = written(lines, F.col("head"))
    entries = files.select(F.substring_index("path", "|", 1).alias("path"), F.substring_index("path", "|", -1).alias("entry"), "content")
    cut = F.col("path").contains("/P_")
    sent = zipped(entries).filter(~cut | (F.col("at") == 0))
    return sent.withColumn("part", F.when(cut, F.expr("substring(part, 1, 40)")).otherwise(F.col("part")))


def landed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = first_cell_line(PRICE_HEADER_CELL)
    pieces = archive_pieces(price_archives(spark, sf_dir), rule=rule.rule)
    lines = piece_lines(pieces, rule, lambda head, at: F.when(at.isNotNull(), F.array(F.lit(0))), JAPANESE)
    return spot_price.parse(with_headless(lines))


HAS_HEADER_SQL = "NOT (o_orderkey % 2 = 1 AND month(o_orderdate) = 6)"


@plan(f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(o_orderkey % 48 + 1 AS INTEGER) AS slot, o_orderkey AS sell_bid_qty_kwh,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS ap0_system
FROM orders WHERE o_orderstatus <> 'P' AND {HAS_HEADER_SQL}""")
def landed_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every price that the archives hold below a header."""
    good = spot_price.accepted(landed_prices(spark, sf_dir))
    return good.select("date", "slot", "sell_bid_qty_kwh", F.col("ap0_system").cast("double").alias("ap0_system"))


@plan(f"""WITH o AS (SELECT *, 'landed/' || o_orderstatus || '_' || strftime(o_orderdate, '%Y%m') || '.zip' AS path FROM orders)
SELECT DISTINCT path, 'broken_archive' AS issue FROM o WHERE o_orderstatus = 'P' UNION ALL
SELECT DISTINCT path || '!y.csv' AS path, 'no_header' AS issue FROM o WHERE o_orderstatus <> 'P' AND NOT ({HAS_HEADER_SQL})""")
def archive_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the archives could not be read, one row each."""
    rule = first_cell_line(PRICE_HEADER_CELL)
    return file_rejects(archive_pieces(price_archives(spark, sf_dir), rule=rule.rule))


@plan(f"""WITH o AS (SELECT *, 'landed/' || o_orderstatus || '_' || strftime(o_orderdate, '%Y%m') || '.zip' AS path FROM orders),
c AS (SELECT path, o_orderstatus = 'P' AS cut, count(*) FILTER ({HAS_HEADER_SQL}) AS n, bool_or(NOT ({HAS_HEADER_SQL})) AS bare FROM o GROUP BY path, cut)
SELECT path, CASE WHEN cut THEN 'failed: broken_archive' WHEN n = 0 THEN 'failed: no_header' WHEN bare THEN 'partial: no_header' ELSE 'success' END AS status,
  CASE WHEN cut THEN 0 ELSE n END AS rows, CAST(0 AS BIGINT) AS flagged, CAST(CASE WHEN cut OR bare THEN 1 ELSE 0 END AS BIGINT) AS unread
FROM c""")
def archive_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger's account of every archive: rows in, rows flagged, entries unread."""
    files = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("landed/"), "o_orderstatus", F.lit("_"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".zip")).alias("path")).distinct()
    return file_outcomes(files, landed_prices(spark, sf_dir))


# --- answers -----------------------------------------------------------------------------------


@plan(f"""WITH {EVENTS_SQL}, a AS (SELECT 'landed/answer_' || user_id || '.json' AS path, CASE user_id % 4 WHEN 1 THEN 'no_items' WHEN 2 THEN 'broken_answer' END AS issue,
  count(DISTINCT dt) AS n FROM ev GROUP BY user_id)
SELECT path, issue, CASE WHEN issue IS NULL THEN n ELSE 1 END AS rows FROM a""")
def answer_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per answer and issue; answers without items, or cut short, are one reject each."""
    day = F.struct(F.date_format("dt", "yyyy/MM/dd").alias("tgtDate"), F.col("user_id").cast("string").alias("htdnsCd"))
    users = slot_events(spark, sf_dir).groupBy("user_id").agg(F.collect_set(day).alias("items"))
    text = F.to_json(F.struct(F.struct("items").alias("data")))
    kind = F.col("user_id") % 4
    sent = F.when(kind == 1, '{"data":{"items":[]}}').when(kind == 2, F.expr("substring(whole, 1, length(whole) - 2)")).otherwise(F.col("whole"))
    answers = users.withColumn("whole", text).select(
        F.concat(F.lit("landed/answer_"), F.col("user_id").cast("string"), F.lit(".json")).alias("path"), sent.alias("text"))
    found = unit_generation.transform(unit_generation.items(answers, ["path"]), ["path"])
    return found.groupBy("path", "issue").agg(F.count(F.lit(1)).alias("rows"))
