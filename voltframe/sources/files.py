"""Raw-file scans and the raw folder layout."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.scalars import file_name

GROUP_BYTES, GROUP_FILES, UNKNOWN_BYTES = 4 << 30, 20_000, 1 << 20
GLOB_SIGNS, BACKSLASHED = r"[\[\]{}*?\\]", r"\\\g<0>"


def grouped(pending: DataFrame, most_bytes: int = GROUP_BYTES, most_files: int = GROUP_FILES) -> DataFrame:
    """Adds `scan_group` to a list of files: groups hold `most_files` files and `most_bytes` plus one file at most.

    Files are dealt to as many buckets as their bytes ask for by a hash of their path, and each bucket is cut where its
    running bytes or files reach the bound, so no task sees the whole list. Files of unknown size count as `UNKNOWN_BYTES`.
    """
    size = F.coalesce(F.col("bytes"), F.lit(UNKNOWN_BYTES)) if "bytes" in pending.columns else F.lit(UNKNOWN_BYTES)
    total = pending.agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("n")).first()
    buckets = max(1, -(-(total["b"] or 0) // most_bytes), -(-total["n"] // most_files))
    dealt = pending.withColumn("_bucket", F.pmod(F.xxhash64("file_path"), F.lit(buckets)))
    order = Window.partitionBy("_bucket").orderBy("file_path")
    before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = F.format_string("%06d-%06d-%06d", F.col("_bucket"), F.floor(before / most_bytes), F.floor((F.row_number().over(order) - 1) / most_files))
    return dealt.withColumn("scan_group", cut).drop("_bucket")


def scan_groups(todo: DataFrame) -> list[str]:
    """Names of the groups of a written list; their number grows with the bytes of the backlog, not with its files."""
    return sorted(r[0] for r in todo.select("scan_group").distinct().collect())


def listed(base: str, group: DataFrame) -> list[str]:
    """Full paths of the files of one group, taken literally."""
    root = base.rstrip("/")
    return [f"{root}/{re.sub(GLOB_SIGNS, BACKSLASHED, r[0])}" for r in group.select("file_path").distinct().collect()]


def relative_path(path: Column | str, base: str) -> Column:
    """A path as the audit log has it, `base` being the raw folder. Schemes and authorities of both may be written differently."""
    place = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", base).rstrip("/") + "/"
    whole = F.col(path) if isinstance(path, str) else path
    return F.substr(whole, F.locate(place, whole) + F.lit(len(place)))


def binary_files(spark: SparkSession, root: str | list[str], pattern: str = "*", modified_after: str | None = None) -> DataFrame:
    """(path, file_name, content); the modification-time filter is applied before any file is opened."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true").load(root))
    if modified_after:
        files = files.where(F.col("modificationTime") >= F.lit(modified_after).cast("timestamp"))
    return files.select("path", file_name("path").alias("file_name"), "content")


def whole_text(spark: SparkSession, root: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """(source_file, text), one row per file, folders included."""
    return (spark.read.text(root if isinstance(root, str) else list(root), wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
            .select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("text")))


def documents(spark: SparkSession, base: str, group: DataFrame, pattern: str = "*",
              modified_after: str | None = None) -> DataFrame:
    """Content of the files of one scan group (paths relative to `base`) with their audit-log columns.

    Only the listed files are looked up and opened, whatever else lies in their folders; a listed file that is not there
    stops the job. Files and list meet by path. Pass `group` as part of a written table: Spark then knows its size and
    joins it by broadcast while it is small, leaving the contents unshuffled.
    """
    found = binary_files(spark, listed(base, group), pattern, modified_after).select(
        relative_path("path", base).alias("file_path"), F.col("content").cast("string").alias("text"))
    return found.join(group, "file_path")


def raw_path(dataset: Column, area_key: Column, start: Column, end: Column, run_id: Column, extension: str) -> Column:
    """dataset/area/yyyy/mm/dataset__area__start_end__run, the pair separator written out."""
    safe = F.replace(area_key, F.lit(">"), F.lit("_to_"))
    stamp = "yyyyMMdd'T'HHmm"
    name = F.concat(dataset, F.lit("__"), safe, F.lit("__"), F.date_format(start, stamp), F.lit("_"),
                    F.date_format(end, stamp), F.lit("__"), run_id, F.lit(f".{extension}"))
    return F.concat_ws("/", dataset, safe, F.date_format(start, "yyyy"), F.date_format(start, "MM"), name)


def write_raw(docs: DataFrame, root: str) -> None:
    """Store documents as a table partitioned the way the raw folders are."""
    (docs.withColumns({"year": F.date_format("request_start_utc", "yyyy"), "month": F.date_format("request_start_utc", "MM"),
                       "area": F.replace("area_key", F.lit(">"), F.lit("_to_"))})
         .write.mode("append").partitionBy("dataset", "area", "year", "month").parquet(root))


def csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Comma-separated text with a header row and no quoting."""
    return spark.read.schema(schema).option("header", True).option("quote", "").csv(path)
