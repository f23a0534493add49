"""Declared tables: columns, types and keys, and the projection that enforces them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from gridspark.constants import PRICE_CELLS, SUPPLY_MEASURES

INT = T.IntegerType()
LONG = T.LongType()
TEXT = T.StringType()
REAL = T.DoubleType()
DATE = T.DateType()
STAMP = T.TimestampType()
PRICE = T.DecimalType(9, 2)
MONTH = "month"
SLOT_COLUMNS = [f"slot{n}" for n in range(1, 49)]
BID_POINT = T.StructType([T.StructField(n, TEXT) for n in ("price", "sell_qty", "buy_qty")])


@dataclass(frozen=True)
class Table:
    """A table's columns, its key and the columns its files are laid out by."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    partitions: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def stored_schema(self) -> T.StructType:
        """Declared columns plus the month folder, which the key's date determines."""
        month = [T.StructField(MONTH, TEXT)] if MONTH in self.partitions else []
        return T.StructType([*self.schema.fields, *month])

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def _price_type(name: str) -> T.DataType:
    if name == "date":
        return TEXT
    if name == "slot":
        return INT
    return LONG if name.endswith("_qty_kwh") else PRICE


PRICE_COLUMNS = [name for _, _, name in PRICE_CELLS]

TABLES = {
    table.name: table
    for table in [
        Table("jepx_da_price", _schema(*[(n, _price_type(n)) for n in PRICE_COLUMNS]), ("date", "slot"), (MONTH,)),
        Table("jepx_bid_data",
              _schema(("id", TEXT), ("date", TEXT), ("slot", INT), ("area_code", INT),
                      ("bid", T.ArrayType(BID_POINT))), ("id",), (MONTH,)),
        # The same stacks in bounded pieces: a key's steps in the order of path, seg and part.
        Table("jepx_bid_segments",
              _schema(("id", TEXT), ("date", TEXT), ("slot", INT), ("area_code", INT), ("feed", INT), ("path", TEXT),
                      ("seg", LONG), ("part", LONG), ("bid", T.ArrayType(BID_POINT))), ("id", "path", "seg", "part"), (MONTH,)),
        Table("downloaded_files",
              _schema(("id", LONG), ("dir_name", TEXT), ("date", DATE), ("filename", TEXT),
                      ("status", TEXT), ("downloaded_at", STAMP)), ("id",)),
        Table("downloaded_csv",
              _schema(("id", LONG), ("dir_name", TEXT), ("date", TEXT), ("content", T.BinaryType()),
                      ("downloaded_at", STAMP)), ("id",), ("dir_name",)),
        Table("jma_weather",
              _schema(("primary_key", TEXT), ("station_id", TEXT), ("date", TEXT), ("time", TEXT),
                      ("temperature", REAL), ("sunshine_duration", REAL), ("global_solar_radiation", REAL),
                      ("wind_speed", REAL), ("wind_direction_sin", REAL), ("wind_direction_cos", REAL),
                      ("weather_description", TEXT), ("snowfall_depth", REAL)), ("primary_key",), (MONTH,)),
        Table("tso_areas",
              _schema(("id", INT), ("tso_id", TEXT), ("name", TEXT), ("area_code", INT), ("region", TEXT)),
              ("id",)),
        # One dataset for all areas: the area joins the key and lays out the files.
        Table("tso_area_data",
              _schema(("area_code", INT), ("master_key", TEXT), ("date", TEXT), ("slot", INT),
                      *[(n, REAL) for n in SUPPLY_MEASURES]),
              ("area_code", "master_key"), ("area_code", MONTH)),
        Table("tso_data",
              _schema(("master_key", TEXT), ("date", DATE), ("slot", INT),
                      *[(f"{a}_{n}", REAL) for a in range(1, 10) for n in SUPPLY_MEASURES]),
              ("master_key",)),
        Table("occto_30min_generation",
              _schema(("master_key", TEXT), ("date", TEXT), ("plant_code", TEXT), ("unit_num", TEXT),
                      ("area_code", INT), ("plant_name", TEXT), ("gen_method", TEXT),
                      *[(n, INT) for n in SLOT_COLUMNS], ("total", LONG)), ("master_key",), (MONTH,)),
        Table("occto_interconnection",
              _schema(("date", DATE), ("hour", INT), ("line_id", TEXT), ("forecast", T.DecimalType(10, 2)),
                      ("actual", T.DecimalType(10, 2))), ("date", "hour", "line_id")),
        Table("occto_reserve",
              _schema(("date", DATE), ("hour", INT), ("area", TEXT), ("reserve_rate", T.DecimalType(5, 2))),
              ("date", "hour", "area")),
        Table("occto_plant_operation",
              _schema(("date", DATE), ("time", TEXT), ("area", TEXT), ("plant_name", TEXT),
                      ("plant_type", TEXT), ("output_kw", T.DecimalType(18, 6)), ("processing_date", DATE)),
              ("date", "time", "plant_name")),
        Table("futures_prices",
              _schema(("date", DATE), ("contract", TEXT), ("price", T.DecimalType(10, 2)), ("volume", INT),
                      ("exchange", TEXT)), ("date", "contract", "exchange")),
    ]
}


def missing_columns(df: DataFrame, required: list[str] | tuple[str, ...]) -> list[str]:
    present = {name.lower() for name in df.columns}
    return [name for name in required if name.lower() not in present]


def require_columns(df: DataFrame, required: list[str] | tuple[str, ...]) -> DataFrame:
    """Fail while the plan is built, not after hours of scanning."""
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    return df


def enforce(df: DataFrame, table: Table) -> DataFrame:
    """Project onto a declared table: by name, in order, absent columns as null."""
    require_columns(df, table.key)
    absent = {name.lower() for name in missing_columns(df, table.columns)}

    def column(field: T.StructField) -> Column:
        source = F.lit(None) if field.name.lower() in absent else F.col(f"`{field.name}`")
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in table.schema])
