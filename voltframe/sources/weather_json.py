"""Weather files: parallel hourly arrays flattened to one row per location and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.functions.scalars import any_present, file_name
from voltframe.operators.quality import enforce
from voltframe.sources.files import listed, relative_path

VARIABLES = ["temperature_2m", "wind_speed_10m", "wind_speed_100m",
             "shortwave_radiation", "cloud_cover", "precipitation"]     # fixed values
UTC_NAMES = ["GMT", "UTC"]                                              # fixed values

SCHEMA = ("timezone string, hourly struct<time: array<string>, "
          + ", ".join(f"{v}: array<double>" for v in VARIABLES) + ">")


def read(spark: SparkSession, root: str | list[str]) -> DataFrame:
    return (spark.read.schema(SCHEMA).option("multiLine", True).option("recursiveFileLookup", "true").json(root)
            .select(file_name("_metadata.file_path").alias("file_name"), "timezone", "hourly"))


def scan(spark: SparkSession, base: str, group: DataFrame) -> DataFrame:
    """The files of one scan group of the audit log, and no others, with `file_path` as the log has it."""
    return (spark.read.schema(SCHEMA).option("multiLine", True).json(listed(base, group))
            .select(relative_path("_metadata.file_path", base).alias("file_path"), "timezone", "hourly"))


def flatten(raw: DataFrame, *keep: str) -> DataFrame:
    """Hours with at least one value; short or absent arrays are padded with NULL."""
    none = F.array().cast("array<double>")
    hours = F.arrays_zip(F.col("hourly.time").alias("time"),
                         *[F.coalesce(F.col(f"hourly.{v}"), none).alias(v) for v in VARIABLES])
    return (raw.select(*keep, F.inline(hours))
            .withColumn("ts_utc", F.to_timestamp("time", "yyyy-MM-dd'T'HH:mm")).drop("time")
            .where(any_present(*VARIABLES)))


def parse(raw: DataFrame, files: DataFrame, locations: DataFrame) -> DataFrame:
    """Flattened hours joined to the audit log, by path where `raw` has it and by file name else, and to the location's country.

    A time zone other than UTC or a location missing in the reference fails the job.
    """
    in_utc = enforce(raw, F.col("timezone").isin(*UTC_NAMES),
                     F.concat(F.lit("weather times must be UTC, got "), F.coalesce("timezone", F.lit("none"))))
    source = F.when(F.col("dataset").contains("archive"), "archive").otherwise("forecast")
    on = "file_path" if "file_path" in raw.columns else "file_name"
    meta = files.select((F.col(on) if on == "file_path" else file_name("file_path")).alias("_at"), F.col("area_key").alias("location_code"),
                        source.alias("data_source"), F.col("file_path").alias("_source_file"),
                        F.col("ingested_at_utc").alias("_bronze_ingested_at"))
    hours = flatten(in_utc.withColumnRenamed(on, "_at"), "_at")
    parsed = (hours.join(meta, "_at")
              .join(locations.select("location_code", "country_code"), "location_code", "left").drop("_at"))
    return enforce(parsed, F.col("country_code").isNotNull(),
                   F.concat(F.lit("location missing in the reference: "), F.col("location_code")))
