"""Token-id files: documents in ascending id order, coded with Simple-8b into segments of Parquet files.

A file row is one segment: its ids as Simple-8b words, the first word of each block, and its documents with their counts, so
a segment is decoded on its own and its blocks side by side. Documents are range-partitioned by id, each partition
writes its segments in order, and a document's place among all ids is its place in the partition plus the ids of the
partitions before. Rows with equal ids follow each other in an order fixed by their text; NULL ids come first. NULL and empty
texts hold the end id alone; repeated rows are written each on its own; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.llm import simple8b
from voltframe.llm.common import read, ship, slices, staged, text_bytes
from voltframe.llm.vocab import WORD_VOCAB, encode_rows, tokenizer_path

END_ID = 2

SEGMENT = T.StructType([
    T.StructField("part", T.LongType(), False), T.StructField("segment", T.LongType(), False),
    T.StructField("n_ids", T.LongType(), False), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("doc_tokens", T.BinaryType(), False), T.StructField("offsets", T.BinaryType(), False),
    T.StructField("words", T.BinaryType(), False)])
_SEGMENT = pa.schema([("part", pa.int64()), ("segment", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                      ("doc_tokens", pa.binary()), ("offsets", pa.binary()), ("words", pa.binary())])
DOCUMENT = "part long, segment long, doc_id long, before long, n_tokens long, ids_crc32 long"


def segments(docs: DataFrame, path: str, end_id: int | None = END_ID) -> DataFrame:
    """Segment rows of all documents, in ascending order of `doc_id`."""
    ship(docs.sparkSession)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
               .withColumn("__tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "__tie").sortWithinPartitions("doc_id", "__tie").drop("__tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            ids, n = encode_rows(*text_bytes(batch, "text"), path, end_id)
            words, offsets = simple8b.encode(ids)
            doc_ids = pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), batch.column("doc_id"))
            raw = (n.astype("<u4"), offsets.astype("<u4"), words.astype("<u8"))
            yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in (part, number, len(ids))), doc_ids,
                                              *(pa.array([memoryview(v).cast("B") if len(v) else b""], pa.binary()) for v in raw)], schema=_SEGMENT)
            number += 1

    return ordered.mapInArrow(run, SEGMENT)


def decoded(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a segment and the count of each of its documents."""
    ids = simple8b.decode(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["offsets"], "<u4").astype(np.int64), row["n_ids"])
    return ids.astype("<u4"), np.frombuffer(row["doc_tokens"], "<u4").astype(np.int64)


def write(docs: DataFrame, path: str, end_id: int | None = END_ID, folder: str | None = None) -> DataFrame:
    """Write the files to a folder, or to the shared one until the application ends; the returned rows are read from them."""
    made = segments(docs, path, end_id)
    if folder is None:
        return staged(made, "token-files")
    made.write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(SEGMENT).parquet(folder)


def documents_in(files: DataFrame) -> DataFrame:
    """Every document of the files: ids of its partition before it, its count, the checksum of its decoded ids."""
    ship(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_buffer() if pa.types.is_binary(batch.schema.field(name).type) else batch.column(name)[i].as_py()
                       for name in batch.schema.names if name != "doc_ids"}
                ids, n = decoded(row)
                ends = np.cumsum(n)
                raw = memoryview(ids).cast("B") if len(ids) else b""
                yield pa.RecordBatch.from_pydict({
                    "part": np.full(len(n), row["part"]), "segment": np.full(len(n), row["segment"]),
                    "doc_id": batch.column("doc_ids")[i].values, "before": ends - n, "n_tokens": n,
                    "ids_crc32": np.array([zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), n.tolist())], np.int64)})

    return files.mapInArrow(run, DOCUMENT)


def starts(files: DataFrame) -> DataFrame:
    """Ids before each segment. The window over all partitions sees one row per partition of the writing job."""
    sizes = files.select("part", "segment", "n_ids")
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    across = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("base"))
    return (sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
            .join(base, "part").select("part", "segment", (F.col("base") + F.col("inside")).alias("first")))


def op4_token_files(spark, sf_dir):
    """Writes all documents as token-id files and describes each document from the files read back."""
    files = write(read(spark, sf_dir, "documents"), tokenizer_path(WORD_VOCAB))
    return (documents_in(files).join(starts(files), ["part", "segment"])
            .select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"))
