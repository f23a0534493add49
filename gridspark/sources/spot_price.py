"""Day-ahead price files: 48 cells per half hour, found below a header row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import PRICE_CELLS, PRICE_HEADER_CELL
from gridspark.functions.dates import iso_text, slashed_date
from gridspark.functions.numbers import exact_decimal, exact_int
from gridspark.functions.text import JAPANESE, cells, cells_at, settled
from gridspark.schemas import PRICE, PRICE_COLUMNS, TABLES
from gridspark.sources.files import WHOLE_FILE_LIMIT
from gridspark.sources.lines import file_issue, first_cell_heads, first_cell_line, headed_lines

TABLE = TABLES["jepx_da_price"]
ORDER = ["path", "seg", "line_no"]
PRICE_KIND = PRICE.simpleString()


def scan(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT) -> DataFrame:
    """Lines below each file's header row; a file without one is a reject."""
    return headed_lines(
        spark, path, first_cell_line(PRICE_HEADER_CELL), lambda head, at: F.when(at.isNotNull(), F.array(F.lit(0))),
        lambda large: first_cell_heads(large, PRICE_HEADER_CELL), F.array(F.lit(0)), limit, JAPANESE, must_have_head=True,
    )


def parse(lines: DataFrame) -> DataFrame:
    """Every non-blank line as a typed row with `issue`. Needs `path, seg, line_no, line`."""
    lines = lines.withColumn("file_issue", file_issue(lines))
    filled = lines.filter((F.translate("line", ',"', "") != "") | F.col("file_issue").isNotNull())
    split = filled.withColumn("cells", cells(F.col("line")))
    whole = [(number, name) for number, _, name in PRICE_CELLS if name.endswith("_qty_kwh")]
    prices = [(number, name) for number, _, name in PRICE_CELLS if name not in ("date", "slot", *[n for _, n in whole])]

    def read(columns: list[tuple[int, str]], convert) -> Column:
        return cells_at(F.col("cells"), F.array(*[F.lit(number) for number, _ in columns]), convert)

    typed = split.select(
        *ORDER, "line", "file_issue", slashed_date(F.get("cells", F.lit(0))).alias("dt"),
        exact_int(F.get("cells", F.lit(1))).try_cast("int").alias("slot"),
        read(whole, exact_int).alias("whole"), read(prices, lambda text: exact_decimal(text, PRICE_KIND)).alias("prices"),
    )
    place = {name: ("whole", i) for i, (_, name) in enumerate(whole)}
    place |= {name: ("prices", i) for i, (_, name) in enumerate(prices)}
    measures = [F.get(place[name][0], F.lit(place[name][1])).alias(name) for name in PRICE_COLUMNS if name in place]
    issue = F.when(F.col("file_issue").isNotNull(), F.col("file_issue")).when(F.col("dt").isNull(), "invalid_date").when(F.col("slot").isNull(), "invalid_slot")
    return settled(
        typed.select(iso_text(F.col("dt")).alias("date"), "slot", *measures, "dt", *ORDER, "line", issue.alias("issue"))
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("issue").isNull()).select(*PRICE_COLUMNS, "dt", *ORDER)


def rename_headers(df: DataFrame) -> DataFrame:
    """Rename a table read with its published headers."""
    return df.withColumnsRenamed({header: name for _, header, name in PRICE_CELLS})
