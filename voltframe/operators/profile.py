"""Counts and profiles used in run reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_matrix(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Rows per `row`, one count column per value; naming the values avoids a scan to find them."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def profile(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
                                 F.count(F.lit(1)).alias("rows"))


def row_counts(tables: Mapping[str, tuple[DataFrame, Column | None]]) -> DataFrame:
    """One row per table: its rows and, where a condition is given, the rows meeting it."""
    def one(name: str, df: DataFrame, condition: Column | None) -> DataFrame:
        flagged = F.count_if(condition) if condition is not None else F.lit(None).cast("bigint")
        return df.agg(F.count(F.lit(1)).alias("row_count"), flagged.alias("flagged_rows")).select(
            F.lit(name).alias("table_name"), "row_count", "flagged_rows")

    return reduce(DataFrame.unionByName, [one(n, df, c) for n, (df, c) in tables.items()])


def uneven_weights(df: DataFrame, key: str, weight: str, total: str = "1.0000") -> DataFrame:
    """Keys whose weights do not add up."""
    return df.groupBy(key).agg(F.sum(weight).alias("total_weight")).where(F.col("total_weight") != F.lit(total).cast("decimal(5,4)"))


def evaluation(runs: DataFrame, key: str = "set") -> DataFrame:
    """Verdict counts over runs with the range of run scores and the overall accuracy."""
    right, wrong = F.sum("correct"), F.sum("wrong")
    return runs.groupBy(key).agg(
        right.alias("correct"), wrong.alias("wrong"), F.min("pct").alias("min_pct"), F.max("pct").alias("max_pct"),
        F.round(F.try_divide(F.lit(100.0) * right, right + wrong), 1).alias("accuracy_pct"))


def match_counts(left: DataFrame, right: DataFrame, key: str, counted: str) -> DataFrame:
    """Every left row with the number of right rows that match; zero when none do.

    The right side is counted before the join, so a frequent key does not fan out.
    """
    counts = right.where(F.col(counted).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("matches"))
    return left.join(counts, key, "left").withColumn("matches", F.coalesce("matches", F.lit(0)))


def loaded_range(marks: DataFrame, by: str, until: str) -> DataFrame:
    """Per group the number of watermarks and the first and last instant they reach."""
    return marks.groupBy(by).agg(F.count(F.lit(1)).alias("keys"), F.min(until).alias("min_loaded_until"), F.max(until).alias("max_loaded_until"))
