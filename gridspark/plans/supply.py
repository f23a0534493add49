"""Area supply: keys, half-hour tables, raw text parsing, wide tables, rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import SUPPLY_MEASURES
from gridspark.dims import lookup
from gridspark.functions.dates import clock_of_slot, compact_text, slot_of_clock, slot_of_stored_clock
from gridspark.functions.numbers import ASCII, FULL_WIDTH
from gridspark.functions.text import JAPANESE, decode_ladder, joined_key, settled
from gridspark.operators.dedup import keep_first
from gridspark.operators.wide import WIDE_AREAS, wide_areas as widen
from gridspark.plans.registry import EVENTS_SQL, EXACT, plan, slot_events
from gridspark.sources import area_supply
from gridspark.sources.lines import attach_heads

# Which measure an event type stands for; anything else is the default measure.
EVENT_MEASURE = {"view": "nuclear", "click": "LNG", "purchase": "hydro", "signup": "solar_actual"}
DEFAULT_MEASURE = "other_fire"
SUMMED = ["area_demand", "total"]
MEASURE_SQL = (
    "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_MEASURE.items())
    + f" ELSE '{DEFAULT_MEASURE}' END"
)


def measure_of_event() -> Column:
    return F.coalesce(lookup(EVENT_MEASURE, F.col("event_type")), F.lit(DEFAULT_MEASURE))


def _is(measure: str) -> str:
    return "TRUE" if measure in SUMMED else f"m = '{measure}'"


@plan(f"""WITH {EVENTS_SQL}
SELECT event_id, area_code, strftime(dt, '%Y%m%d') AS date, slot,
       strftime(dt, '%Y%m%d') || '_' || slot AS master_key,
       lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || CASE WHEN minute(ts) < 30 THEN ':00' ELSE ':30' END AS clock
FROM ev""")
def slot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = slot_events(spark, sf_dir).withColumn("clock", clock_of_slot(F.col("slot")))
    text, slot = compact_text(F.col("dt")), slot_of_clock(F.col("clock"))
    return events.select(
        "event_id", "area_code", text.alias("date"), slot.alias("slot"),
        joined_key(text, slot.cast("string")).alias("master_key"), "clock",
    )


@plan("""SELECT event_id, strftime(ts, '%H:%M') AS label,
       CAST(hour(ts) * 2 + CASE WHEN minute(ts) = 0 THEN 1 ELSE 2 END AS INTEGER) AS parsed_slot,
       CAST(hour(ts) * 2 + CASE WHEN minute(ts) = 30 THEN 1 ELSE 0 END + 1 AS INTEGER) AS stored_slot
FROM events""")
def slot_importer_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.date_format("ts", "HH:mm")
    return slot_events(spark, sf_dir).select(
        "event_id", label.alias("label"), slot_of_clock(label).alias("parsed_slot"),
        slot_of_stored_clock(label).alias("stored_slot"),
    )


def half_hour_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical half-hour rows: one aggregation with partial sums, every measure present."""
    amount = F.col("value").cast(EXACT)
    events = slot_events(spark, sf_dir).withColumn("m", measure_of_event())
    sums = {name: F.sum(amount if name in SUMMED else F.when(F.col("m") == name, amount))
            for name in SUPPLY_MEASURES if name in SUMMED or name in [*EVENT_MEASURE.values(), DEFAULT_MEASURE]}
    grouped = events.groupBy("area_code", "dt", "slot").agg(*[s.alias(name) for name, s in sums.items()])
    text = compact_text(F.col("dt"))
    return grouped.select(
        "area_code", joined_key(text, F.col("slot").cast("string")).alias("master_key"), text.alias("date"), "slot",
        *[F.coalesce(F.col(n).cast("double") if n in sums else F.lit(0.0), F.lit(0.0)).alias(n)
          for n in SUPPLY_MEASURES],
    )


HALF_HOUR_SQL = f"""WITH {EVENTS_SQL}, m AS (SELECT *, {MEASURE_SQL} AS m FROM ev)
SELECT area_code, strftime(dt, '%Y%m%d') || '_' || slot AS master_key, strftime(dt, '%Y%m%d') AS date, slot, {", ".join(
    f'CAST(coalesce(sum(CASE WHEN {_is(n)} THEN v END), 0) AS DOUBLE) AS "{n}"' for n in SUPPLY_MEASURES)}
FROM m GROUP BY area_code, dt, slot"""


@plan(HALF_HOUR_SQL)
def area_supply_halfhour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return half_hour_sums(spark, sf_dir)


# --- raw text --------------------------------------------------------------------

# Areas write their headers in two spellings and orders.
LONG_HEADER = ["DATE", "TIME", "エリア需要", "原子力", "火力(LNG)", "火力(その他)", "水力", "太陽光発電実績", "合計"]
SHORT_HEADER = ["TIME", "DATE", "合計", "太陽光実績", "水力", "火力（その他）", "火力（ＬＮＧ）", "原子力", "エリア需要"]


def file_of_area(area_code: Column) -> Column:
    return F.concat(F.lit("landed/area_"), area_code.cast("string"), F.lit(".csv"))


def area_heads(spark: SparkSession) -> DataFrame:
    """Header line of each of the nine area files; even areas use the short spelling."""
    rows = [(a, ",".join(SHORT_HEADER if a % 2 == 0 and a != 4 else LONG_HEADER)) for a in WIDE_AREAS]
    heads = spark.createDataFrame(rows, "area_code int, header string")
    return heads.select(
        "area_code", file_of_area(F.col("area_code")).alias("path"), F.lit(0).cast("bigint").alias("head_seg"),
        F.lit(-1).cast("bigint").alias("head_at"), "header",
    )


def supply_text(events: DataFrame, date_text: Column, time_text: Column) -> DataFrame:
    """Each event as a line of its area's file. Values carry thousands commas in quotes,
    even areas write full-width digits, empty cells stand for absent values."""
    shown = F.format_number(F.col("value"), 2)
    number = F.when(F.col("area_code") % 2 == 0, F.translate(shown, ASCII, FULL_WIDTH)).otherwise(shown)
    number = F.when(shown.contains(","), F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)

    def of(measure: str) -> Column:
        return F.when(F.col("m") == measure, number).otherwise("")

    cells_of = {"DATE": date_text, "TIME": time_text, "エリア需要": number, "原子力": of("nuclear"),
                "LNG": of("LNG"), "OTHER": of("other_fire"), "水力": of("hydro"), "SOLAR": of("solar_actual"),
                "合計": number}
    long_order = ["DATE", "TIME", "エリア需要", "原子力", "LNG", "OTHER", "水力", "SOLAR", "合計"]
    short_order = ["TIME", "DATE", "合計", "SOLAR", "水力", "OTHER", "LNG", "原子力", "エリア需要"]
    long_line = F.concat_ws(",", *[cells_of[name] for name in long_order])
    short_line = F.concat_ws(",", *[cells_of[name] for name in short_order])
    short = (F.col("area_code") % 2 == 0) & (F.col("area_code") != 4)
    return settled(events.withColumn("m", measure_of_event()).select(
        file_of_area(F.col("area_code")).alias("path"), F.lit(0).cast("bigint").alias("seg"),
        F.col("event_id").alias("line_no"), F.when(short, short_line).otherwise(long_line).alias("line"),
    ))


def parsed_supply(spark: SparkSession, text: DataFrame) -> DataFrame:
    heads = area_heads(spark)
    positions = area_supply.positions(F.col("header"), F.col("area_code"))
    # Nine files by construction, so their heads may be broadcast.
    lines = attach_heads(text, heads, positions, broadcast=True)
    code = F.regexp_extract("path", r"area_(\d+)", 1).cast("int")
    return area_supply.parse(lines.withColumn("area_code", code))


def slashed_text() -> Column:
    return F.date_format("dt", "yyyy/M/d")


def area_date_text() -> Column:
    """Area nine writes its dates without slashes."""
    return F.when(F.col("area_code") == 9, F.date_format("dt", " yyyyMMdd ")).otherwise(slashed_text())


@plan(f"""WITH {EVENTS_SQL}, m AS (SELECT *, {MEASURE_SQL} AS m,
  row_number() OVER (PARTITION BY area_code, dt, slot ORDER BY event_id) AS n FROM ev)
SELECT area_code, strftime(dt, '%Y%m%d') || '_' || slot AS master_key, strftime(dt, '%Y%m%d') AS date, slot, {", ".join(
    f'CAST(CASE WHEN {_is(n)} THEN v ELSE 0 END AS DOUBLE) AS "{n}"' for n in SUPPLY_MEASURES)}
FROM m WHERE n = 1""")
def area_supply_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = slot_events(spark, sf_dir)
    text = supply_text(events, area_date_text(), clock_of_slot(F.col("slot")))
    return area_supply.canonical(parsed_supply(spark, text)).drop("dt")


@plan(f"""WITH {EVENTS_SQL}, r AS (SELECT *, CAST(CASE WHEN event_id % 3 = 0 THEN hour(ts) * 2 + 2
    ELSE hour(ts) * 2 + CASE WHEN minute(ts) = 0 THEN 1 ELSE 2 END END AS INTEGER) AS repaired FROM ev)
SELECT event_id, strftime(dt, '%Y%m%d') AS date, repaired AS slot,
       strftime(dt, '%Y%m%d') || '_' || repaired AS master_key, CAST(v AS DOUBLE) AS area_demand
FROM r""")
def area9_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = slot_events(spark, sf_dir).withColumn("area_code", F.lit(9))
    kind = F.col("event_id") % 3
    time_text = (
        F.when(kind == 0, F.date_format("ts", "H"))
        .when(kind == 1, F.date_format("ts", "H:mm:ss"))
        .otherwise(F.date_format("ts", "HH:mm"))
    )
    date_text = F.when(kind == 1, F.date_format("dt", " yyyy/MM/dd")).otherwise(F.date_format("dt", "yyyyMMdd "))
    parsed = parsed_supply(spark, supply_text(events, date_text, time_text))
    return area_supply.accepted(parsed).select(
        F.col("line_no").alias("event_id"), "date", "slot", "master_key", "area_demand"
    )


REJECT_SQL = """CASE WHEN event_id % 11 = 0 THEN 'invalid_date'
       WHEN event_id % 7 = 0 THEN 'repeated_header'
       WHEN event_id % 5 = 0 THEN 'slot_out_of_range' END"""


def damaged_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as text, many of the lines damaged."""
    events = slot_events(spark, sf_dir)
    key = F.col("event_id")
    date_text = F.when(key % 11 == 0, "2024-13-45").when(key % 7 == 0, "DATE").otherwise(area_date_text())
    time_text = (
        F.when(key % 11 == 0, "0:00").when(key % 7 == 0, "TIME").when(key % 5 == 0, "24:00")
        .otherwise(clock_of_slot(F.col("slot")))
    )
    return parsed_supply(spark, supply_text(events, date_text, time_text))


@plan(f"""WITH {EVENTS_SQL} SELECT area_code, event_id AS line_no, {REJECT_SQL} AS issue
FROM ev WHERE {REJECT_SQL} IS NOT NULL""")
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return area_supply.rejects(damaged_supply(spark, sf_dir)).select("area_code", "line_no", "issue")


@plan(f"""WITH {EVENTS_SQL}, j AS (SELECT area_code, {REJECT_SQL} AS issue FROM ev)
SELECT area_code, count(*) AS lines, count(*) FILTER (issue IS NULL OR issue = 'slot_out_of_range') AS accepted,
       count(issue) AS flagged
FROM j GROUP BY area_code""")
def reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = damaged_supply(spark, sf_dir)
    kept = F.col("issue").isNull() | F.col("issue").isin(area_supply.KEPT_ISSUES)
    return parsed.groupBy("area_code").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(kept).alias("accepted"), F.count("issue").alias("flagged")
    )


@plan(f"""WITH {EVENTS_SQL}
SELECT area_code, strftime(dt, '%Y%m%d') || '_' || slot AS master_key,
       strftime(CASE WHEN year(dt) > 2023 THEN make_date(2023, month(dt), day(dt)) ELSE dt END, '%Y%m%d') AS date,
       CAST(hour(ts) * 2 + CASE WHEN minute(ts) = 30 THEN 1 ELSE 0 END + 1 AS INTEGER) AS slot,
       CAST(v AS DOUBLE) AS area_demand
FROM ev WHERE event_id % 7 <> 0 AND event_id % 5 <> 0 AND NOT (month(dt) = 2 AND day(dt) = 29)""")
def stored_batch_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = slot_events(spark, sf_dir)
    key = F.col("event_id")
    label = F.when(key % 7 == 0, "TIME").when(key % 5 == 0, "early").otherwise(F.date_format("ts", "HH:mm"))
    date_text = compact_text(F.col("dt"))
    batch = events.select(
        "area_code", joined_key(date_text, F.col("slot").cast("string")).alias("master_key"), date_text.alias("date"),
        label.alias("slot"), F.col("value").alias("area_demand"),
    )
    return area_supply.clean_batch(batch, 2023).drop("dt")


@plan("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '火力（ＬＮＧ）' WHEN event_id % 3 = 1 THEN '太陽光実績'
       ELSE '連系線' END || ',' || event_type || ',' || props AS line FROM events""")
def text_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    label = F.when(key % 3 == 0, "火力（ＬＮＧ）").when(key % 3 == 1, "太陽光実績").otherwise("連系線")
    events = slot_events_with_props(spark, sf_dir).withColumn("text", F.concat_ws(",", label, "event_type", "props"))
    content = F.when(key % 2 == 0, F.encode("text", "UTF-8")).otherwise(F.encode("text", JAPANESE))
    return events.select("event_id", decode_ladder(content).alias("line"))


def slot_events_with_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "props")


# --- wide ------------------------------------------------------------------------


def _wide_sql() -> str:
    filled = ", ".join(f'CAST(CASE WHEN {_is(n)} THEN v ELSE 0 END AS DOUBLE) AS "{n}"' for n in SUPPLY_MEASURES)
    spread = ", ".join(
        f'max(CASE WHEN area_code = {a} THEN "{n}" END) AS "{a}_{n}"' for a in WIDE_AREAS for n in SUPPLY_MEASURES
    )
    return f"""WITH {EVENTS_SQL}, m AS (SELECT *, {MEASURE_SQL} AS m,
  row_number() OVER (PARTITION BY area_code, dt, slot ORDER BY event_id) AS n FROM ev),
f AS (SELECT area_code, dt, slot, {filled} FROM m WHERE n = 1)
SELECT strftime(dt, '%Y%m%d') || '_' || lpad(CAST(slot AS VARCHAR), 2, '0') AS master_key, dt AS date, slot, {spread}
FROM f GROUP BY dt, slot HAVING count(*) FILTER (area_code = 1) > 0"""


@plan(_wide_sql())
def wide_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = slot_events(spark, sf_dir).withColumn("m", measure_of_event())
    used = [*EVENT_MEASURE.values(), DEFAULT_MEASURE]
    amounts = [
        (F.col("value") if n in SUMMED else F.when(F.col("m") == n, F.col("value")).otherwise(0.0) if n in used
         else F.lit(0.0)).alias(n) for n in SUPPLY_MEASURES
    ]
    return widen(events.select("event_id", "area_code", "dt", "slot", *amounts), ["event_id"])


@plan(f"""WITH {EVENTS_SQL} SELECT area_code, dt, slot, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY area_code, dt, slot ORDER BY ts, event_id) AS n FROM ev) WHERE n = 1""")
def first_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = slot_events(spark, sf_dir)
    first = keep_first(events, ["area_code", "dt", "slot"], ["ts", "event_id"])
    return first.select("area_code", "dt", "slot", "event_id", "event_type", "value")


