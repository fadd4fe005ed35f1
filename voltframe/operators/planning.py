"""Ingest planning: download windows, chunks, resume and watermarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.operators.dedupe import latest


def _days(instant: Column, days: Column | int) -> Column:
    n = F.lit(days) if isinstance(days, int) else days
    return instant + F.make_dt_interval(n)


def windows(targets: DataFrame, mode: str, as_of: str | Column, *, keys: Sequence[str] = ("dataset", "area_key"),
            watermarks: DataFrame | None = None, backfill_start: str = "2024-01-01", test_days: int = 3,
            repull_days: int = 3, ahead_days: Column | int = 1) -> DataFrame:
    """One download window per target.

    test: the last `test_days`. backfill: from `backfill_start`. incremental: from the
    target's watermark less `repull_days`, so that late corrections are fetched again.
    """
    today = F.date_trunc("day", F.lit(as_of).cast("timestamp"))     # a column passes through lit
    origin = F.lit(backfill_start).cast("timestamp")
    if mode == "test":
        planned = targets.withColumn("window_start", _days(today, -test_days)).withColumn("window_end", today)
    elif mode == "backfill" or watermarks is None:
        planned = targets.withColumn("window_start", origin).withColumn("window_end", _days(today, ahead_days))
    elif mode == "incremental":
        known = watermarks.select(*keys, F.col("loaded_until_utc").alias("_until"))
        planned = (targets.join(known, list(keys), "left")
                   .withColumn("window_start", F.coalesce(_days(F.col("_until"), -repull_days), origin))
                   .withColumn("window_end", _days(today, ahead_days)).drop("_until"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return planned


def weather_windows(locations: DataFrame, mode: str, as_of: str, *, watermarks: DataFrame | None = None,
                    backfill_start: str = "2024-01-01", test_days: int = 3, archive_delay_days: int = 6, repull_days: int = 7,
                    past_days: int = 7, forecast_days: int = 2) -> DataFrame:
    """Download chunks per location: the archive up to its delay in calendar years, and one
    forecast window that bridges the delay. `locations` holds dataset-free area keys."""
    archive = locations.select(F.lit("weather_hourly_archive").alias("dataset"), "area_key")
    archive_as_of = _days(F.date_trunc("day", F.lit(as_of).cast("timestamp")), -archive_delay_days)
    planned = windows(archive, mode, archive_as_of, watermarks=watermarks, backfill_start=backfill_start, test_days=test_days,
                      repull_days=repull_days, ahead_days=0)
    today = F.date_trunc("day", F.lit(as_of).cast("timestamp"))
    forecast = locations.select(F.lit("weather_hourly_forecast").alias("dataset"), "area_key",
                                _days(today, -past_days).alias("chunk_start"), _days(today, forecast_days).alias("chunk_end"))
    return chunks(planned, "year").unionByName(forecast)


def price_ahead(dataset: str = "dataset") -> Column:
    """Day-ahead prices exist for tomorrow, everything else only for today."""
    return F.when(F.col(dataset) == "day_ahead_price", 2).otherwise(1)


def chunks(planned: DataFrame, unit: str = "month") -> DataFrame:
    """Split each window at calendar month or year starts; empty windows give nothing."""
    start, end = F.col("window_start"), F.col("window_end")
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    edges = F.sequence(F.date_trunc(unit, start), end, step)
    return (planned.where(start < end).withColumn("_edge", F.explode(edges))
            .withColumn("chunk_start", F.greatest(start, F.col("_edge")))
            .withColumn("chunk_end", F.least(end, F.col("_edge") + step))
            .where("chunk_start < chunk_end").drop("_edge", "window_start", "window_end"))


def resume(planned: DataFrame, log: DataFrame, keys: Sequence[str] = ("dataset", "area_key")) -> DataFrame:
    """Chunks whose exact window no earlier run has finished (ok or no_data)."""
    done = (log.where(F.col("status").isin("ok", "no_data"))
               .select(*keys, F.col("request_start_utc").alias("chunk_start"), F.col("request_end_utc").alias("chunk_end")))
    return planned.join(done, [*keys, "chunk_start", "chunk_end"], "left_anti")


def _advance(attempts: DataFrame, keys: Sequence[str], as_of: str | None) -> DataFrame:
    reached = F.max("request_end_utc")
    until = F.least(reached, F.lit(as_of).cast("timestamp")) if as_of else reached
    return (attempts.groupBy(*keys).agg(until.alias("loaded_until_utc"),
                                        F.count_if(F.col("status") == "error").alias("_errors"))
                    .where("_errors = 0").drop("_errors"))


def advance_backfill(log: DataFrame, as_of: str, keys: Sequence[str] = ("dataset", "area_key"),
                     ties: Sequence[str] = ()) -> DataFrame:
    """New watermarks: targets whose latest attempt at every monthly chunk did not fail."""
    at = F.col("request_start_utc")
    monthly = log.where((F.dayofmonth(at) == 1) & (F.hour(at) == 0) & (F.minute(at) == 0))
    attempts = latest(monthly, [*keys, "request_start_utc", "request_end_utc"], "ingested_at_utc", *ties)
    return _advance(attempts, keys, as_of)


def advance_incremental(run_log: DataFrame, as_of: str | None, keys: Sequence[str] = ("dataset", "area_key")) -> DataFrame:
    """New watermarks: targets without any failed request in this run."""
    return _advance(run_log, keys, as_of)


def audit_rows(done: DataFrame, run_id: str, source: str, ingested_at: str) -> DataFrame:
    """Audit-log rows of planned chunks: `done` holds the chunks with status, file_path, bytes, points and error_message."""
    return done.select(
        F.lit(run_id).alias("run_id"), F.lit(source).alias("source"), "dataset", "area_key", F.col("chunk_start").alias("request_start_utc"),
        F.col("chunk_end").alias("request_end_utc"), "status", "file_path", "bytes", "points", "error_message",
        F.lit(ingested_at).cast("timestamp").alias("ingested_at_utc"))


def later_mark(old, new) -> Column:
    """Merge guard: a watermark never moves back."""
    return new("loaded_until_utc") > old("loaded_until_utc")


def batch_windows(planned: DataFrame, member: str, keys: Sequence[str] = ("dataset", "chunk_start", "chunk_end")) -> DataFrame:
    """One row per window with the reference locations that need it.

    Members are distinct reference locations, so a group is as long as the location table.
    """
    return (planned.select(*keys, member).distinct().groupBy(*keys)
            .agg(F.array_sort(F.collect_list(member)).alias("members"), F.count(F.lit(1)).alias("calls_saved"))
            .withColumn("calls_saved", F.col("calls_saved") - 1))


def pending(log: DataFrame, state: DataFrame | None, source: str, datasets: Column, mode: str = "incremental",
            state_key: Column | None = None) -> DataFrame:
    """Successful downloads that were ingested after the dataset's processed-until state."""
    files = log.where((F.col("source") == source) & (F.col("status") == "ok") & datasets)
    if mode != "incremental" or state is None:
        return files
    seen = state.select(F.col("dataset").alias("_dataset"), F.col("processed_until_ingested_at").alias("_until"))
    key = state_key if state_key is not None else F.col("dataset")
    return (files.join(seen, key == F.col("_dataset"), "left")
            .where(F.col("_until").isNull() | (F.col("ingested_at_utc") > F.col("_until")))
            .drop("_dataset", "_until"))


def processed_until(files: DataFrame, state_key: Column | None = None) -> DataFrame:
    key = state_key if state_key is not None else F.col("dataset")
    return files.groupBy(key.alias("dataset")).agg(F.max("ingested_at_utc").alias("processed_until_ingested_at"))
