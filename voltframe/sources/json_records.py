"""JSON files that hold an array, one object, or one object per line, with or without a BOM. What is no JSON goes to quarantine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.scalars import strip_bom
from voltframe.operators.quality import quarantine, split_required
from voltframe.sources.files import whole_text

SHOWN = 200     # characters of a malformed part that its quarantine row shows
HOLIDAY = "countryCode: string, `date`: string, localName: string, name: string, `global`: boolean"


def parsed(texts: DataFrame, text: str, record: str) -> DataFrame:
    """One row per record, keeping the other columns of `texts`, and one row per malformed part with `_malformed` set.

    A text is first read as a whole: an array, or an object however many lines it takes. Only where that fails its lines are
    read one by one; lines that are no JSON value are malformed, and so is, in one piece, a text without any line that is.
    Put in brackets, a text with anything behind its value is no JSON, so nothing is left out silently. Values of another
    type than declared are NULL. No text stops the job; empty texts and NULL give nothing.
    """
    def values(part: Column) -> Column:
        """The records of a JSON value; NULL if the part is malformed."""
        boxed = F.concat(F.lit("["), part, F.lit("]"))
        return F.when(F.ltrim(part).startswith("["), F.flatten(F.from_json(boxed, f"array<{many}>"))).otherwise(F.from_json(boxed, many))

    many = f"array<struct<{record}>>"
    kept = [c for c in texts.columns if c != text]
    once = texts.select(*kept, F.inline(F.array(F.struct(strip_bom(text).alias("_body")))))
    whole = once.select(*kept, "_body", F.inline(F.array(F.struct(values(F.col("_body")).alias("_whole")))))
    lines = F.filter(F.split("_body", r"\r?\n"), lambda line: F.trim(line) != "")
    by_line = F.when(F.col("_whole").isNull() & F.col("_body").isNotNull(), lines)
    read = F.transform(by_line, lambda line: F.struct(line.alias("line"), values(line).alias("records")))
    tried = whole.select(*kept, "_body", "_whole", F.inline(F.array(F.struct(read.alias("_lines")))))
    some = F.exists("_lines", lambda x: x["records"].isNotNull())
    good = F.coalesce("_whole", F.flatten(F.transform("_lines", lambda x: F.coalesce(x["records"], F.array().cast(many)))))
    bad_lines = F.transform(F.filter("_lines", lambda x: x["records"].isNull()), lambda x: x["line"])
    bad = F.when(F.col("_whole").isNotNull(), F.array().cast("array<string>")).when(some, bad_lines).otherwise(F.array("_body"))
    row = T.StructType.fromDDL(record)

    def out(record_: Column, malformed: Column) -> Column:
        return F.struct(*[record_.getField(f.name).alias(f.name) for f in row], malformed.alias("_malformed"))

    rows = F.concat(F.transform(good, lambda r: out(r, F.lit(None).cast("string"))),
                    F.transform(bad, lambda x: out(F.lit(None).cast(f"struct<{record}>"), x)))
    return tried.where(F.col("_body").isNotNull()).select(*kept, F.inline(rows))


def records(texts: DataFrame, text: str, record: str) -> DataFrame:
    """The sound records of all texts."""
    return parsed(texts, text, record).where(F.col("_malformed").isNull()).drop("_malformed")


def malformed(read: DataFrame, table: str, source_file: str, detected_at: str | None = None) -> DataFrame:
    """Quarantine rows of the malformed parts of `parsed`, told apart by a hash of the part."""
    bad = read.where(F.col("_malformed").isNotNull()).withColumn("_part", F.md5(F.col("_malformed").cast("binary")))
    return quarantine(bad, table, [source_file, "_part"], "malformed_json", F.substring("_malformed", 1, SHOWN), source_file, detected_at)


def read_holiday_files(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """Records and malformed parts of all holiday files below a folder, or of the listed ones."""
    return parsed(whole_text(spark, root, "*.json"), "text", HOLIDAY)


def holiday_files(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """The sound records of the files, typed."""
    return holidays(records(whole_text(spark, root, "*.json"), "text", HOLIDAY))


def holidays(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("countryCode").alias("country_code"), F.col("date").alias("date_str"),
                      F.col("localName").alias("local_name"), "name", F.col("global").alias("is_nationwide"),
                      F.col("source_file").alias("_source_file"),
                      F.try_to_timestamp("date", F.lit("yyyy-MM-dd")).cast("date").alias("holiday_date"))


def clean_holidays(typed: DataFrame, detected_at: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(holidays with one row per key, quarantine rows for records lacking a required field)."""
    good, bad = split_required(typed, ["country_code", "holiday_date", "name"])
    rejected = quarantine(bad, "silver_holiday", ["country_code", "date_str", "name"], "missing_required_field",
                          "country_code, date or name is null", "_source_file", detected_at)
    rest = F.struct("local_name", "is_nationwide", "_source_file")
    unique = (good.groupBy("country_code", "holiday_date", "name").agg(F.min(rest).alias("r"))
                  .select("country_code", "holiday_date", "r.local_name", "name",
                          F.coalesce("r.is_nationwide", F.lit(True)).alias("is_nationwide"), "r._source_file"))
    return unique, rejected
