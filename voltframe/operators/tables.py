"""Parquet tables under one folder: append, upsert, snapshot merge, window replacement.

Tables that grow are partitioned by day, or by a hash bucket of their key. A change reads and rewrites only the
parts it touches: the new state is written to the shared folder first (so a lost executor never costs the table,
and nothing reads and writes one path at once), then put in place by dynamic partition overwrite, which commits
task output through Spark's own protocol. A table without parts is written beside itself once and put in place by
renaming; a table that a crash has left set aside is put back by the next read. Staged copies go after the commit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.scalars import date_key
from voltframe.operators import merge as change
from voltframe.schemas import TABLES, align, required
from voltframe.session import new_folder


class Counts(NamedTuple):
    inserted: int
    updated: int
    deleted: int


class Day(NamedTuple):
    """Partition of a table: a day (yyyymmdd) that is a column or derived from the instant `ts`, or one of `buckets`
    hash buckets of the key columns `of`."""

    column: str = "date_key"
    ts: str | None = None
    of: tuple[str, ...] = ()
    buckets: int = 64

    def fixed_by(self, keys: Sequence[str]) -> bool:
        """Whether rows of one key never lie in two parts."""
        return set(self.of) <= set(keys) if self.of else (self.ts or self.column) in keys


class Lake:
    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType] | None = None,
                 days: Mapping[str, Day] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas = schemas or TABLES
        self.days = days or {}
        self._scratch: list[str] | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _stored_schema(self, table: str) -> T.StructType:
        """The table's columns, its day partition last."""
        schema, day = self.schemas[table], self.days.get(table)
        if not day:
            return schema
        rest = [f for f in schema if f.name != day.column]
        return T.StructType([*rest, T.StructField(day.column, T.IntegerType(), True)])

    def _at(self, path: str):
        """The file system of a path, and the path as it takes it."""
        there = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return there.getFileSystem(self.spark._jsc.hadoopConfiguration()), there

    def _exists(self, path: str) -> bool:
        fs, there = self._at(path)
        return fs.exists(there)

    def _remove(self, path: str) -> None:
        fs, there = self._at(path)
        fs.delete(there, True)

    def _rename(self, path: str, to: str) -> None:
        fs, there = self._at(path)
        if not fs.rename(there, self._at(to)[1]):
            raise OSError(f"{path} could not be renamed to {to}")

    def _recover(self, table: str) -> bool:
        """Put back a table that a crash has left set aside."""
        path = self.path(table)
        lost = not self._exists(path) and self._exists(f"{path}.old")
        if lost:
            self._rename(f"{path}.old", path)
        return lost

    def _put(self, table: str, df: DataFrame, rows_per_file: int = 0) -> None:
        """Replace a whole table: one write beside it, then two renames. `df` may read the table."""
        path = self.path(table)
        by = [self.days[table].column] if table in self.days else []
        writer = (df.hint("rebalance", *by) if by else df).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
        (writer.partitionBy(*by) if by else writer).parquet(f"{path}.new")
        self._swap(table)

    def _swap(self, table: str) -> None:
        """Put what was written beside a table in its place."""
        path = self.path(table)
        self._recover(table)
        self._remove(f"{path}.old")
        if self._exists(path):
            self._rename(path, f"{path}.old")
        self._rename(f"{path}.new", path)
        self._remove(f"{path}.old")

    def _stored(self, table: str) -> DataFrame:
        schema = self._stored_schema(table)
        try:
            return self.spark.read.schema(schema).parquet(self.path(table))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            if self._recover(table):
                return self.spark.read.schema(schema).parquet(self.path(table))
            return self.spark.createDataFrame([], schema)

    def read(self, table: str, from_day: int | None = None, days: Sequence[int] | None = None) -> DataFrame:
        """The table, or no rows while nothing has been written; earlier or other days are not listed."""
        stored = self._stored(table)
        if days is not None:
            stored = stored.where(F.col(self.days[table].column).isin(list(days)))
        if from_day is not None:
            stored = stored.where(F.col(self.days[table].column) >= from_day)
        return stored.select(self.schemas[table].fieldNames())

    def _shaped(self, table: str, df: DataFrame) -> DataFrame:
        """Aligned rows with their day; a NULL in a required column stops the write."""
        schema, day = self.schemas[table], self.days.get(table)
        out = align(df, schema, table)
        for name in required(schema):
            stop = F.raise_error(F.lit(f"{table}: {name} must not be NULL")).cast(schema[name].dataType)
            out = out.withColumn(name, F.coalesce(F.col(name), stop))
        if day and day.ts:
            out = out.withColumn(day.column, date_key(day.ts))
        elif day and day.of:
            out = out.withColumn(day.column, F.pmod(F.xxhash64(*day.of), F.lit(day.buckets)).cast("int"))
        return out.select(self._stored_schema(table).fieldNames())

    def _write(self, table: str, df: DataFrame, mode: str, rows_per_file: int = 0) -> None:
        """Add rows, or replace the parts that have rows. Rows are gathered by part before they are written, or every task
        would add a file to every part; the rebalance hint splits a large part over several tasks."""
        by = [self.days[table].column] if table in self.days else []
        gathered = df.hint("rebalance", *by) if by else df
        writer = gathered.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file)
        (writer.partitionBy(*by) if by else writer).parquet(self.path(table))

    def staged(self, label: str, df: DataFrame) -> DataFrame:
        """A written copy in the shared folder: lineage ends here and the size is known."""
        folder = new_folder(self.spark, label)
        df.write.parquet(folder)
        if self._scratch is not None:
            self._scratch.append(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def staged_all(self, label: str, parts: Iterable[DataFrame]) -> DataFrame:
        """Written copies of several frames of one schema in one folder; only one of them is worked on at a time. There is at
        least one."""
        folder, schema = new_folder(self.spark, label), None
        if self._scratch is not None:
            self._scratch.append(folder)
        for df in parts:
            df.write.mode("append").parquet(folder)
            schema = df.schema
        return self.spark.read.schema(schema).parquet(folder)

    @contextmanager
    def scratch(self) -> Iterator[None]:
        """Staged copies made inside are removed at the end, unless an outer scratch does that."""
        if self._scratch is not None:
            yield
            return
        self._scratch = []
        try:
            yield
        finally:
            for folder in self._scratch:
                self._remove(folder)
            self._scratch = None

    def append(self, table: str, df: DataFrame) -> None:
        self._write(table, self._shaped(table, df), "append")

    def append_missing(self, table: str, df: DataFrame, keys: Sequence[str]) -> int:
        """Append the rows whose key, NULLs being equal, the table has not, so that a repeated call adds nothing. Returns their number."""
        new, old = self._shaped(table, df), self.read(table).select(*[F.col(k).alias(f"_old_{k}") for k in keys])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys])
        fresh = self.staged(table, new.join(old, same, "left_anti").dropDuplicates(list(keys)))
        n = fresh.count()
        if n:
            self._write(table, fresh, "append")
        return n

    def overwrite(self, table: str, df: DataFrame) -> None:
        """Truncate and reload; `df` may read the table."""
        self._put(table, self._shaped(table, df))

    def upsert(self, table: str, source: DataFrame, keys: Sequence[str], note: Callable[[DataFrame], None] | None = None, **options) -> Counts:
        """Conditional merge; when nothing changes nothing is written. `note` is called with the inserted, updated and deleted
        rows before they are put in place, so that a crash in between leaves a note too many, never one too few."""
        with self.scratch():
            src, target = self._shaped(table, source), self._stored(table)
            day = self.days.get(table)
            by_part = day is not None and day.fixed_by(keys) and not options.get("delete_missing")
            if by_part:
                # the parts of the batch as literals prune the target scan; the driver's file
                # listing holds at least as many
                src = self.staged(table, src)
                touched = [r[0] for r in src.select(day.column).distinct().collect()]
                target = target.where(F.col(day.column).isin(touched))
            staged = self.staged(table, change.merge(target, src, keys, **options))
            found = {r["_action"]: r["rows"] for r in change.action_counts(staged).collect()}
            counts = Counts(*[found.get(a, 0) for a in ("insert", "update", "delete")])
            if any(counts) and note is not None:
                note(staged.where(F.col("_action") != "keep"))
            if any(counts) and by_part:
                self._write(table, change.result(staged), "overwrite")
            elif any(counts):
                self._put(table, change.result(staged))
            return counts

    def replace_window(self, table: str, new: DataFrame, from_day: int) -> None:
        """Replace every day from `from_day` on; days of the window without new rows go first, folder by folder."""
        part = self.days[table].column
        with self.scratch():
            staged = self.staged(table, self._shaped(table, new).where(F.col(part) >= from_day))
            fresh = {r[0] for r in staged.select(part).distinct().collect()}
            for day in self.parts(table):
                if day >= from_day and day not in fresh:
                    self._remove(f"{self.path(table)}/{part}={day}")
            self._write(table, staged, "overwrite")

    def replace_parts(self, table: str, new: DataFrame, parts: Sequence[int]) -> None:
        """Replace exactly the given parts; those without new rows go, all others keep their files. `new` may read the table."""
        part = self.days[table].column
        with self.scratch():
            staged = self.staged(table, self._shaped(table, new).where(F.col(part).isin(list(parts))))
            fresh = {r[0] for r in staged.select(part).distinct().collect()}
            for gone in set(parts) - fresh:
                self._remove(f"{self.path(table)}/{part}={gone}")
            if fresh:
                self._write(table, staged, "overwrite")

    def replace_keys(self, table: str, new: DataFrame, keys: DataFrame, parts: Sequence[int]) -> None:
        """Within the given parts, replace the rows whose key columns occur in `keys` by `new`; other rows stay as they are."""
        kept = self.read(table, days=parts).join(keys, keys.columns, "left_anti")
        self.replace_parts(table, kept.unionByName(align(new, self.schemas[table], table)), parts)

    def stamps(self, table: str) -> dict[int, str]:
        """For each part a mark that changes whenever its files do: a digest of their names, sizes and times, by listing."""
        part, out = self.days[table].column, {}
        for p in self.parts(table):
            files = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in self._listed(f"{self.path(table)}/{part}={p}"))
            out[p] = hashlib.md5(repr(files).encode()).hexdigest()
        return out

    def _listed(self, path: str) -> list:
        fs, there = self._at(path)
        return list(fs.listStatus(there)) if fs.exists(there) else []

    def _files(self, path: str) -> int:
        return sum(f.isFile() and f.getPath().getName().endswith(".parquet") for f in self._listed(path))

    def parts(self, table: str) -> list[int]:
        """The parts that a table has on storage."""
        self._recover(table)
        prefix = f"{self.days[table].column}="
        names = [f.getPath().getName() for f in self._listed(self.path(table))]
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit())

    def file_counts(self, table: str) -> dict[int | None, int]:
        """Files per part, by listing; None stands for a table without parts."""
        if table not in self.days:
            return {None: self._files(self.path(table))}
        part = self.days[table].column
        return {p: self._files(f"{self.path(table)}/{part}={p}") for p in self.parts(table)}

    def compact(self, table: str, above: int = 20, rows_per_file: int = 5_000_000, cluster_by: Sequence[str] = ()) -> tuple[int, int]:
        """Rewrite the parts that consist of more than `above` files, and only those; (files before, files after).

        With `cluster_by` the rows of these parts are range-sorted by those columns, so that each new file holds a narrow range
        of them and its statistics let a filter on them skip it. Rows of one key may lie in several files, so a very frequent
        key is no hot task.
        """
        counts = self.file_counts(table)
        before, crowded = sum(counts.values()), [p for p, n in counts.items() if n > above]
        if not crowded:
            return before, before
        with self.scratch():
            if table not in self.days:
                rows, by = self._stored(table), []
            else:
                by = [self.days[table].column]
                rows = self._stored(table).where(F.col(by[0]).isin(crowded))
            if cluster_by:
                rows = self.staged(table, rows)
                files = max(len(crowded), -(-rows.count() // rows_per_file))
                spread = F.xxhash64(*rows.columns)
                rows = rows.repartitionByRange(files, *by, *cluster_by, spread).sortWithinPartitions(*by, *cluster_by)
                self._clustered(table, rows, rows_per_file)
            elif by:
                self._write(table, self.staged(table, rows), "overwrite", rows_per_file)
            else:
                self._put(table, rows.hint("rebalance"), rows_per_file)
        return before, sum(self.file_counts(table).values())

    def _clustered(self, table: str, rows: DataFrame, rows_per_file: int) -> None:
        """Write rows as they are dealt: the rebalance of other writes would mix their ranges."""
        writer = rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
        if table in self.days:
            writer.option("partitionOverwriteMode", "dynamic").partitionBy(self.days[table].column).parquet(self.path(table))
        else:
            writer.parquet(f"{self.path(table)}.new")
            self._swap(table)
