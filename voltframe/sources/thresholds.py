"""KPI threshold file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.schemas import SILVER
from voltframe.sources.files import csv_table


def read(spark: SparkSession, path: str) -> DataFrame:
    return csv_table(spark, path, SILVER["silver_kpi_threshold"]).withColumn("country_code", F.upper("country_code"))
