"""Weather: raw observation files and directories of standardised files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridspark.constants import BEARINGS, CALM
from gridspark.functions.text import settled
from gridspark.operators.dedup import keep_first
from gridspark.plans.registry import EVENTS_SQL, EXACT, plan, slot_events, table
from gridspark.schemas import TABLES
from gridspark.sources import weather, weather_table
from gridspark.sources.lines import attach_heads, nth_line_heads

WEATHER_COLUMNS = TABLES["jma_weather"].columns
UPPER = ["年月日時", "気温(℃)", "気温(℃)", "風速(m/s)", "風速(m/s)", "日照時間(時間)", "全天日射量(MJ/㎡)", "天気", "降雪(cm)", "降水量(mm)"]
LOWER = ["", "", "品質情報", "", "風向", "", "", "", "", ""]


def weather_text(events: DataFrame) -> DataFrame:
    """Events as hourly files, one per area, with preamble, two header lines and a quality row."""
    station = F.concat(F.lit("4740"), F.col("area_code").cast("string"))
    path = F.concat(F.lit("landed/jma_weather_"), station, F.lit("_202401.csv"))
    amount = F.col("value").cast(EXACT).cast("string")
    turn = (F.col("event_id") % (len(BEARINGS) + 2)).cast("int")
    bearing = F.get(F.array(*[F.lit(name) for name in [*BEARINGS, CALM, "?"]]), turn)
    values = [
        F.date_format("ts", "yyyy/M/d H:mm:ss"), F.when(F.col("event_type") != "error", amount).otherwise("--"), F.lit("8"),
        F.when(turn == len(BEARINGS), "0.0").otherwise(amount), bearing, F.lit(""), F.lit("1.5"), F.col("event_type"),
        F.lit("x"), F.lit("0.5"),
    ]
    data = events.select(
        path.alias("path"), F.lit(0).cast("bigint").alias("seg"), (F.col("event_id") + 10).alias("line_no"),
        F.concat_ws(",", *values).alias("line"),
    )
    preamble = ["downloaded", "", ",station", ",".join(UPPER), ",".join(LOWER), "," * 9]
    top = F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("line_no"), F.lit(line).alias("line")) for i, line in enumerate(preamble)
    ])
    heads = events.select(path.alias("path")).distinct().select("path", F.lit(0).cast("bigint").alias("seg"), F.inline(top))
    return settled(heads.unionByName(data))


def parsed_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = weather_text(slot_events(spark, sf_dir))
    heads = nth_line_heads(text, weather.LOWER_HEADER_LINE, skip_blank=False)
    head = F.col("head")
    places = weather.positions(head[weather.UPPER_HEADER_LINE - 1], head[weather.LOWER_HEADER_LINE - 1], "hourly")
    lines = attach_heads(text, heads, places, broadcast=True)
    return weather.parse(lines.withColumn("station_id", weather.station_of_path(F.col("path"))), "hourly")


def _component_sql(function: str) -> str:
    return f"""CASE WHEN event_id % 18 < 16 THEN round({function}(radians((event_id % 18) * 22.5)), 4) + 0.0
       WHEN event_id % 18 = 16 THEN 0.0 WHEN v = 0 THEN 0.0 END"""


@plan(f"""WITH {EVENTS_SQL}, w AS (SELECT *, '4740' || area_code AS station_id, strftime(ts, '%Y%m%d%H%M') AS stamp FROM ev),
f AS (SELECT *, row_number() OVER (PARTITION BY station_id, stamp ORDER BY event_id) AS n FROM w)
SELECT station_id || '_' || stamp AS primary_key, station_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H:%M') AS time,
  CASE WHEN event_type <> 'error' THEN CAST(v AS DOUBLE) END AS temperature, CAST(NULL AS DOUBLE) AS sunshine_duration,
  CAST(1.5 AS DOUBLE) AS global_solar_radiation,
  CASE WHEN event_id % 18 = 16 THEN CAST(0 AS DOUBLE) ELSE CAST(v AS DOUBLE) END AS wind_speed,
  {_component_sql('sin')} AS wind_direction_sin, {_component_sql('cos')} AS wind_direction_cos,
  event_type AS weather_description, CAST(NULL AS DOUBLE) AS snowfall_depth
FROM f WHERE n = 1""")
def weather_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = weather.accepted(parsed_weather(spark, sf_dir))
    return keep_first(accepted, ["primary_key"], weather.ORDER).select(*WEATHER_COLUMNS)


@plan(f"""WITH {EVENTS_SQL} SELECT DISTINCT '4740' || area_code AS station_id, CAST(5 AS BIGINT) AS line_no,
  'quality_row' AS issue FROM ev""")
def weather_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.rejects(parsed_weather(spark, sf_dir)).select("station_id", "line_no", "issue")


FULL_HEADER = WEATHER_COLUMNS
SHORT_HEADER = ["time", "date", "station_id", "primary_key", "temperature"]


@plan("""WITH c AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_nationkey % 2, c_custkey) AS n
  FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT c_nationkey || '_' || c_mktsegment AS primary_key, CAST(c_nationkey AS VARCHAR) AS station_id, '2024-01-01' AS date,
  '00:00' AS time, CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) END AS temperature,
  CASE WHEN c_nationkey % 2 = 0 THEN CAST(c_custkey AS DOUBLE) END AS sunshine_duration,
  CASE WHEN c_nationkey % 2 = 0 AND c_mktsegment <> 'FURNITURE' THEN c_name ELSE '' END AS weather_description
FROM c WHERE n = 1""")
def na_directory_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as two files: one with all columns, one with few columns in another order."""
    customer = table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    key = F.when(segment == "BUILDING", "#N/A").otherwise(F.concat_ws("_", F.col("c_nationkey").cast("string"), segment))
    balance = F.when(segment == "MACHINERY", "--").otherwise(F.col("c_acctbal").cast(EXACT).cast("string"))
    written = {
        "primary_key": key, "station_id": F.col("c_nationkey").cast("string"), "date": F.lit("2024-01-01"),
        "time": F.lit("00:00"), "temperature": balance, "sunshine_duration": F.col("c_custkey").cast("string"),
        "weather_description": F.when(segment == "FURNITURE", "nan").otherwise(F.col("c_name")),
    }

    def line(header: list[str]):
        return F.concat_ws(",", *[written.get(name, F.lit("")) for name in header])

    even = F.col("c_nationkey") % 2 == 0
    text = settled(customer.select(
        F.when(even, "jma_weather_a.csv").otherwise("jma_weather_b.csv").alias("path"),
        F.lit(0).cast("bigint").alias("seg"), F.col("c_custkey").alias("line_no"),
        F.when(even, line(FULL_HEADER)).otherwise(line(SHORT_HEADER)).alias("line"),
    ))
    rows = [("jma_weather_a.csv", ",".join(FULL_HEADER)), ("jma_weather_b.csv", ",".join(SHORT_HEADER))]
    heads = spark.createDataFrame(rows, "path string, header string").withColumn("head_at", F.lit(-1).cast("bigint"))
    lines = attach_heads(text, heads, weather_table.positions(F.col("header")), broadcast=True)
    combined = weather_table.combine(weather_table.parse(lines))
    return combined.select("primary_key", "station_id", "date", "time", "temperature", "sunshine_duration", "weather_description")
