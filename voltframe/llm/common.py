"""What the operators of this subpackage share: reading tables, text buffers inside tasks, staged tables.

Words are runs of bytes other than ASCII white space; `bytes.split()` and `bytes.lower()` follow exactly that definition,
so text is handled as UTF-8 bytes and non-ASCII letters are never folded.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import count
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.session import new_folder

WORD_SPLIT = r"[ \t-\r]+"
SLICE_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_shipped: set[str] = set()
_open: list[list[str]] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Give executors this package once per application, as `--py-files` would, and bound the bytes of a batch that a
    Python worker receives at once, whatever the length of its texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    handle, path = tempfile.mkstemp(prefix="voltframe-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((root / "voltframe").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def staged(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """`df` written to the shared folder and read back: cuts the lineage and survives lost executors. Inside `scratch` the
    table goes at its end unless it is kept; every other one goes when the application ends, as results may still read it."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    if _open and not keep:
        _open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end; whatever outlives the block must be staged with `keep`."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            there = spark._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside leave no shuffle files behind: these go when the table is written, not when the driver happens to
    collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def crc32_of(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def text_bytes(batch: pa.RecordBatch, name: str) -> tuple[memoryview, np.ndarray]:
    """The column's UTF-8 bytes in one buffer and the n+1 offsets of its rows; NULL counts as empty."""
    column = pc.fill_null(batch.column(name).cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return memoryview(b""), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    if data is None:
        return memoryview(b""), np.zeros(n + 1, np.int64)
    return memoryview(data)[ends[0]:ends[-1]], ends - ends[0]


def slices(batches: Iterator[pa.RecordBatch], name: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about `most` bytes of text, or one longer row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def words_of(data: memoryview, ends: np.ndarray, lower: bool = True) -> tuple[list[bytes], np.ndarray]:
    """All words of the rows in order, and how many each row has."""
    raw = bytes(data)
    if lower:
        raw = raw.lower()
    words: list[bytes] = []
    counts = np.zeros(len(ends) - 1, np.int64)
    for i in range(len(counts)):
        own = raw[ends[i]:ends[i + 1]].split()
        counts[i] = len(own)
        words += own
    return words, counts


def numbered(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Distinct words in order of appearance, and the index of each word in them."""
    first: dict[bytes, int] = {}
    at = np.fromiter(map(first.setdefault, words, count()), np.int64, len(words))
    positions = np.fromiter(first.values(), np.int64, len(first))
    rank = np.zeros(len(words), np.int64)
    rank[positions] = np.arange(len(positions))
    return list(first), rank[at] if len(words) else at


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, … of each run, run after run."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    first = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return first + np.arange(total)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), vectorised over unsigned integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
