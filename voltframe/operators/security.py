"""Row and column restrictions as projections and semi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a default mask shows per type.
MASK_TEXT = "xxxx"


def restrict(df: DataFrame, policy: DataFrame, user: str, column: str) -> DataFrame:
    """Rows of the countries mapped to the user; a `*` mapping shows every row.

    Planned as an existence hash join plus one scalar subquery, never a row-by-row loop.
    """
    mine = policy.where(F.col("user_name") == user).select("country_code")
    return df.where(F.col(column).isin(mine) | mine.where(F.col("country_code") == "*").exists())


def fixed_role(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.col(column) == value)


def mask(df: DataFrame, *columns: str) -> DataFrame:
    """Replace values the way a default mask does: text, zero, or the first instant."""
    def masked(name: str) -> Column:
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            return F.lit(MASK_TEXT)
        if isinstance(kind, T.NumericType | T.BooleanType):
            return F.lit(0).cast(kind)
        return F.lit("1900-01-01").cast(kind)

    return df.withColumns({c: masked(c) for c in columns})


def deny(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)
