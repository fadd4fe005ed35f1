"""Structured Streaming jobs over event files. Each drains what is available and stops, or runs
on with another trigger."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from voltframe.operators.dedupe import latest
from voltframe.operators.tables import Lake
from voltframe.session import new_folder

# The dock feed; it has no event time, so windows on it use arrival time.
DOCK_SCHEMA = ("BikepointID string, Street string, Neighbourhood string, Latitude double, Longitude double, "
               "No_Bikes bigint, No_Empty_Docks bigint")


def json_stream(spark: SparkSession, path: str, schema: str = DOCK_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).json(path).withColumn("arrived_at", F.current_timestamp())


def parquet_stream(spark: SparkSession, path: str, ts: str = "ts") -> DataFrame:
    """File stream with `ts` as an instant. The source wants a folder or a pattern; this pattern matches `path` alone,
    a single file or a folder."""
    path = path.rstrip("/")
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]").withColumn(ts, F.col(ts).cast("timestamp"))


def tumbling(events: DataFrame, ts: str, delay: str, window: str, keys: Sequence[str], aggregates: Mapping[str, Column],
             slide: str | None = None) -> DataFrame:
    """Aggregates per event-time window and key; events later than `delay` are dropped."""
    grouped = events.withWatermark(ts, delay).groupBy(F.window(ts, window, slide), *keys)
    return _bounds(grouped.agg(*[a.alias(n) for n, a in aggregates.items()]), "window", [*keys, *aggregates])


def sessions(events: DataFrame, ts: str, delay: str, gap: str, keys: Sequence[str],
             aggregates: Mapping[str, Column]) -> DataFrame:
    """Aggregates per activity session: events of a key no further apart than `gap`.

    Sessions are merged inside each map task first, so a very active key is shuffled as a few
    partial sessions.
    """
    events.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    grouped = events.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), *keys)
    return _bounds(grouped.agg(*[a.alias(n) for n, a in aggregates.items()]), "session_window", [*keys, *aggregates])


def _bounds(df: DataFrame, window: str, columns: Sequence[str]) -> DataFrame:
    label = window.removesuffix("_window")
    return df.select(F.col(f"{window}.start").alias(f"{label}_start"), F.col(f"{window}.end").alias(f"{label}_end"), *columns)


def first_seen(events: DataFrame, ts: str, delay: str, keys: Sequence[str]) -> DataFrame:
    """One event per key; keys are remembered for `delay` of event time.

    Copies are first removed per input partition, so a key with very many copies is spread over
    tasks, and the task that owns it sees one copy per partition.
    """
    spread = events.withWatermark(ts, delay).withColumn("_part", F.spark_partition_id())
    once_per_part = spread.dropDuplicatesWithinWatermark([*keys, "_part"]).drop("_part")
    return once_per_part.dropDuplicatesWithinWatermark(list(keys))


def failures(events: DataFrame, column: str, failed: str) -> DataFrame:
    """The alert condition: events that report a failure."""
    return events.where(F.col(column) == failed)


def drain(writer: DataStreamWriter) -> None:
    """Run a stream over what is available, then stop."""
    writer.trigger(availableNow=True).start().awaitTermination()


def to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what is available to a parquet table, exactly once per checkpoint."""
    drain(stream.writeStream.format("parquet").outputMode("append").option("path", path)
                 .option("checkpointLocation", checkpoint))


def drained(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Run the stream over what is available and return the table it wrote."""
    folder = new_folder(spark, label)
    to_table(stream, f"{folder}/table", f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


Merged = Mapping[str, tuple[Column, Callable[[Column], Column]]]


class LateWindows:
    """Event-time windows that lose no late row.

    A row is late if its window had ended, by the watermark of the batches before its own, when it arrived. Late rows are kept
    whole in a table of their own; all others become partial aggregates per window and batch. Both tables and the watermark of each
    batch lie in one folder per batch, so a batch that is done again replaces its own rows and changes nothing else.
    `aggregates` names each aggregate and what adds up its partial results.
    """

    def __init__(self, spark: SparkSession, root: str, ts: str, delay: str, window: str, keys: Sequence[str], aggregates: Merged):
        self.spark, self.root, self.ts, self.delay = spark, root, ts, delay
        self.window, self.keys, self.aggregates = window, list(keys), aggregates

    def _stored(self, name: str) -> DataFrame | None:
        """All batches of a table; None while there are none."""
        try:
            return self.spark.read.option("basePath", f"{self.root}/{name}").parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def _put(self, name: str, batch: int, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch}")

    def mark(self, before: int | None = None) -> dt.datetime | None:
        """The watermark: the latest instant of all batches, or those before one, less the delay."""
        marks = self._stored("marks")
        if marks is None:
            return None
        seen = marks if before is None else marks.where(F.col("batch") < before)
        return seen.agg((F.max("last") - F.expr(f"INTERVAL {self.delay}")).alias("m")).first()["m"]

    def _windowed(self, df: DataFrame) -> DataFrame:
        placed = df.withColumn("_w", F.window(self.ts, self.window))
        return placed.withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")

    def _grouped(self, df: DataFrame) -> DataFrame:
        return df.groupBy("window_start", "window_end", *self.keys).agg(*[a.alias(n) for n, (a, _) in self.aggregates.items()])

    def add(self, batch: DataFrame, number: int) -> None:
        mark = self.mark(before=number)
        rows = self._windowed(batch)
        late = F.col("window_end") <= F.lit(mark) if mark is not None else F.lit(False)
        self._put("parts", number, self._grouped(rows.where(~late)))
        self._put("late", number, rows.where(late))
        self._put("marks", number, batch.agg(F.max(self.ts).alias("last")))

    def run(self, stream: DataFrame, checkpoint: str) -> None:
        drain(stream.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint))

    def late_rows(self) -> DataFrame | None:
        return self._stored("late")

    def closed(self, with_late: bool = True) -> DataFrame:
        """The windows that have ended, late rows merged into them unless left out."""
        parts = self._stored("parts").drop("batch")
        late = self.late_rows() if with_late else None
        if late is not None:
            parts = parts.unionByName(self._grouped(late))
        ended = parts.where(F.col("window_end") <= F.lit(self.mark()))
        return ended.groupBy("window_start", "window_end", *self.keys).agg(*[merge(F.col(n)).alias(n) for n, (_, merge) in self.aggregates.items()])


def keep_latest(stream: DataFrame, store: Lake, table: str, keys: Sequence[str], order: Sequence[str], checkpoint: str) -> None:
    """Keep the newest row of every key in a table.

    Each micro-batch is reduced to its newest row per key and merged; a row replaces the
    stored one only if it is newer, so replays and late rows leave the table unchanged.
    """
    def newer(old, new) -> Column:
        return F.struct(*[new(c) for c in order]) > F.struct(*[old(c) for c in order])

    def apply(batch: DataFrame, _: int) -> None:
        newest = latest(batch, keys, *order)
        store.upsert(table, newest, keys, guard=newer)

    drain(stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))
