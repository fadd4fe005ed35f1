"""Row choice within a key.

A `row_number() <= n` filter lets Spark trim every key to n rows before the shuffle, so a
key holding a large share of all rows costs each map task n rows, not the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows of every key. `order` must be a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def choose_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return first_n(df, keys, order, 1)


def latest(df: DataFrame, keys: Sequence[str], ingested: str, *ties: str) -> DataFrame:
    """The most recently ingested row of every key."""
    return choose_one(df, keys, [F.col(c).desc() for c in (ingested, *ties)])


def preferred_then_latest(df: DataFrame, keys: Sequence[str], preferred: Column,
                          ingested: str, *ties: str) -> DataFrame:
    """Rows meeting `preferred` first, then the most recently ingested."""
    rank = F.when(preferred, 0).otherwise(1)
    return choose_one(df, keys, [rank, *[F.col(c).desc() for c in (ingested, *ties)]])


def top_with_ties(df: DataFrame, order: Sequence[Column], n: int = 1, keys: Sequence[str] = ()) -> DataFrame:
    """Top n by rank; rows that tie with the last kept rank are kept too."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") <= n).drop("_rank")
