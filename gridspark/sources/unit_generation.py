"""Unit-level generation: JSON answers of 48 end-labelled half hours per day and unit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridspark.constants import UNIT_FIELDS, UNIT_SLOT_PREFIX
from gridspark.dims import generation_type_of
from gridspark.functions.dates import compact_text, slashed_date
from gridspark.functions.numbers import int_or_zero, nullable_int
from gridspark.functions.text import decode_ladder, is_zip, joined_key, or_na, settled
from gridspark.schemas import SLOT_COLUMNS, TABLES
from gridspark.sources.files import WHOLE_FILE_LIMIT, fail_on, has_archive_name, named_files, scan_pieces
from gridspark.sources.json_ranges import BROKEN_ANSWER, NO_ITEMS, RANGE_BYTES, array_elements
from gridspark.sources.lines import file_issue
from gridspark.sources.seek import can_seek, first_bytes

TABLE = TABLES["occto_30min_generation"]
ANSWER_LIMIT = 512 * 1024 * 1024
ITEM = "map<string,string>"
ANSWER = f"data struct<items: array<{ITEM}>>"


def slot_fields() -> dict[str, str]:
    """Source field to slot column; labels name the end of the half hour, 0030 to 2400."""
    ends = [(30 * n) for n in range(1, 49)]
    return {f"{UNIT_SLOT_PREFIX}{end // 60:02d}{end % 60:02d}": name for end, name in zip(ends, SLOT_COLUMNS)}


def scan(spark: SparkSession, path: str | list[str], limit: int = WHOLE_FILE_LIMIT, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Items of landed answers as `(path, at, item, file_issue)`; `at` orders the items of an answer.

    Answers up to `limit` are parsed as a whole, larger ones in byte ranges by many tasks. On file
    systems where workers cannot seek, all are parsed as a whole, and the load fails on an answer
    above ANSWER_LIMIT. What has no items is one row that says why.
    """
    seek = can_seek(spark, path)
    if not seek:
        fail_on(oversize(spark, path))
    pieces = scan_pieces(spark, path, limit if seek else ANSWER_LIMIT)
    whole = parsed(pieces.select("path", "issue", decode_ladder(F.col("content"), F.col("utf8")).alias("text")), ["path"])
    if not seek:
        return whole
    large = named_files(spark, path, lambda name: ~has_archive_name(name), over=limit)
    zipped = first_bytes(large, 4).filter(is_zip(F.col("start"))).select("path")
    found = array_elements(large.join(zipped, "path", "left_anti"), range_bytes=range_bytes)
    return whole.unionByName(found.select(
        "path", "at", F.from_json("element", ITEM).alias("item"), F.col("issue").alias("file_issue")))


def oversize(spark: SparkSession, path: str | list[str], limit: int | None = None) -> DataFrame:
    """Answers too large to parse as a whole, for file systems without seeking; only their names are read."""
    return named_files(spark, path, lambda name: ~has_archive_name(name), over=limit or ANSWER_LIMIT).withColumn("issue", F.lit("answer_too_large"))


def parsed(answers: DataFrame, kept: list[str]) -> DataFrame:
    """Items of answers that are at hand as `text`."""
    found = answers.withColumn("found", F.from_json("text", ANSWER)["data"]["items"])
    why = F.when(F.try_parse_json("text").isNull(), BROKEN_ANSWER).otherwise(NO_ITEMS)
    reason = F.coalesce(F.col("issue"), why) if "issue" in answers.columns else why
    # Worked out once per answer, and only for those without items.
    missing = F.when(F.coalesce(F.size("found"), F.lit(0)) < 1, reason)
    # Before the items are taken apart, so that no row carries its whole answer.
    rows = found.withColumn("file_issue", missing).select(*kept, "file_issue", F.posexplode_outer("found").alias("pos", "item"))
    return rows.select(*kept, F.coalesce("pos", F.lit(0)).cast("bigint").alias("at"), "item", "file_issue")


def items(answers: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per item of a scan, or of answers with their `text`, with the columns to keep."""
    if "item" in answers.columns:
        return answers.select(*(keep or []), "item", "file_issue")
    kept = keep if keep is not None else [name for name in answers.columns if name not in ("text", "issue")]
    return parsed(answers, kept).drop("at")


def transform(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Items to table rows with `dt` and `issue`; absent slots and bad numbers are 0."""
    kept = keep or []

    def field(name: str) -> Column:
        return F.try_element_at("item", F.lit(name))

    source = {target: name for name, target in UNIT_FIELDS.items()}
    dt = slashed_date(field(source["date"]))
    text = compact_text(dt)
    key = joined_key(text, or_na(field(source["plant_code"])), or_na(field(source["unit_num"])))
    fields = F.array(*[F.lit(name) for name in slot_fields()])
    typed = raw.select(
        *kept, "item", file_issue(raw).alias("file_issue"), dt.alias("dt"), text.alias("date"), key.alias("master_key"),
        F.transform(fields, lambda name: int_or_zero(F.try_element_at("item", name))).alias("slots"),
    )
    return settled(typed.select(
        *kept, "master_key", "date", field(source["plant_code"]).alias("plant_code"),
        field(source["unit_num"]).alias("unit_num"), nullable_int(field(source["area_code"])).alias("area_code"),
        field(source["plant_name"]).alias("plant_name"),
        generation_type_of(field(source["gen_method"])).alias("gen_method"),
        *[F.get("slots", F.lit(i)).alias(name) for i, name in enumerate(SLOT_COLUMNS)],
        int_or_zero(field(source["total"]), "bigint").alias("total"), "dt",
        F.coalesce("file_issue", F.when(F.col("dt").isNull(), "invalid_date")).alias("issue"),
    ))


def accepted(transformed: DataFrame) -> DataFrame:
    return transformed.filter(F.col("issue").isNull()).select(*TABLE.columns, "dt")
