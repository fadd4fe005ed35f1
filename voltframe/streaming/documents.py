"""Raw documents as a stream: every file that arrives below a folder is parsed and merged into silver, once in effect.

The checkpoint knows which files a batch holds. A batch whose merge fails is read again by the next start, and a batch that
was merged but not yet marked as done is merged again; both change nothing that is there already, because rows are replaced
only by what came in later and rejected documents are noted once. So the tables depend on the files alone, not on how they
were dealt to batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.operators.tables import Lake
from voltframe.plans import silver
from voltframe.sources import files, grid_xml, json_records
from voltframe.streaming.events import drain

FILE = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(spark: SparkSession, root: str, pattern: str = "*", most_files: int = 1000) -> DataFrame:
    """Files below a folder as they arrive, in the order of their modification; a batch holds `most_files` at most.

    Columns: `file_path` below the folder, its first two steps as `dataset` and `area_key` (see `files.raw_path`; a
    `name=` before the value is dropped), the modification time as `ingested_at_utc`, and `text`.
    """
    raw = (spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", most_files).load(root))

    def step(i: int) -> Column:
        return F.regexp_replace(F.get(F.split("file_path", "/"), F.lit(i)), "^[^=]*=", "")

    placed = raw.select(files.relative_path("path", root).alias("file_path"), F.col("modificationTime").alias("ingested_at_utc"),
                        F.col("content").cast("string").alias("text"))
    return placed.withColumns({"dataset": step(0), "area_key": F.replace(step(1), F.lit("_to_"), F.lit(">"))})


def grid_to_silver(lake: Lake, root: str, checkpoint: str, as_of: str, production_type: DataFrame | None = None,
                   pattern: str = "*.xml", most_files: int = 1000) -> None:
    """Drain the grid documents that have arrived since the checkpoint into their silver tables and the quarantine.

    A file is parsed once per batch; rows and faults of all datasets are written together and merged dataset by dataset.
    Files of datasets that silver has no table for are left alone.
    """
    def apply(batch: DataFrame, _: int) -> None:
        with lake.scratch():
            known = batch.where(F.col("dataset").isin(*silver.GRID_TABLES))
            parsed = lake.staged("parsed", grid_xml.intervals(grid_xml.read_documents(known), "area_key", "file_path", "ingested_at_utc", faults=True))
            for dataset in sorted(r[0] for r in parsed.select("dataset").distinct().collect()):
                silver.merge_intervals(lake, parsed.where(F.col("dataset") == dataset), dataset, as_of, production_type)

    stream = file_stream(lake.spark, root, pattern, most_files)
    drain(stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))


def holidays_to_silver(lake: Lake, root: str, checkpoint: str, as_of: str, most_files: int = 1000) -> None:
    """Drain holiday files: new and changed holidays are merged, malformed parts and incomplete records quarantined. Unlike the
    snapshot load, a file that vanishes removes nothing."""
    def apply(batch: DataFrame, _: int) -> None:
        with lake.scratch():
            texts = batch.select(F.col("file_path").alias("source_file"), "text")
            read = lake.staged("holidays", json_records.parsed(texts, "text", json_records.HOLIDAY))
            silver.merge_holidays(lake, read, as_of)

    stream = file_stream(lake.spark, root, "*.json", most_files)
    drain(stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))
