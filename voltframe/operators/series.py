"""Operators on interval series: roll-up, gap filling, weighting and validity lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.scalars import exact_sum, hour_start
from voltframe.operators.dedupe import choose_one


def rollup_hour(df: DataFrame, keys: Sequence[str], ts: str, energy: str, minutes: str = "resolution_minutes",
                energy_name: str = "energy_mwh") -> DataFrame:
    """Energy and covered minutes per key and hour, `ts` being the interval start."""
    return (df.groupBy(hour_start(ts).alias("ts_hour_utc"), *keys)
              .agg(exact_sum(energy).alias(energy_name), F.sum(minutes).cast("int").alias("coverage_minutes")))


def hourly_price(df: DataFrame, keys: Sequence[str], ts: str, price: str,
                 minutes: str = "resolution_minutes") -> DataFrame:
    """Mean, minimum, maximum and slot count per key, hour and resolution."""
    return (df.groupBy(hour_start(ts).alias("ts_hour_utc"), *keys, minutes)
              .agg((exact_sum(price) / F.count(price)).alias("avg_price"), F.min(price).alias("min_price"),
                   F.max(price).alias("max_price"), F.count(F.lit(1)).alias("slots")))


def prefer_resolution(df: DataFrame, keys: Sequence[str], wanted: int = 60,
                      minutes: str = "resolution_minutes") -> DataFrame:
    """One resolution per key: the wanted one if present, otherwise the finest."""
    return choose_one(df, keys, [F.when(F.col(minutes) == wanted, 0).otherwise(1), F.col(minutes)])


def best_covered(df: DataFrame, keys: Sequence[str], minutes: str = "resolution_minutes") -> DataFrame:
    """One resolution per key: the most covered minutes, then the finest."""
    return choose_one(df, keys, [F.col("coverage_minutes").desc(), F.col(minutes)])


def fill_slots(points: DataFrame, keys: Sequence[str], position: str, slots: str | int, value: str,
               carry: Column | bool = True, tie: str | None = None) -> DataFrame:
    """Dense slots 1..n from the listed points of each key.

    With `carry` a point stands until the next listed position; without it only listed
    positions remain. Positions outside 1..n are ignored, leading gaps give no row, and of
    a repeated position the row with the highest `tie` wins. Points are reduced to one per
    (key, position) first, so a key never brings more than n rows to the window.
    """
    n = F.lit(slots) if isinstance(slots, int) else F.col(slots)
    listed = points.where(F.col(value).isNotNull() & F.col(position).between(F.lit(1), n))
    if tie:
        listed = choose_one(listed, [*keys, position], [F.col(tie).desc()])
    following = F.lead(position).over(Window.partitionBy(*keys).orderBy(position))
    last = F.when(F.lit(carry) if isinstance(carry, bool) else carry,
                  F.coalesce(following - 1, n)).otherwise(F.col(position))
    runs = listed.withColumn("_last", last)
    return runs.withColumn(position, F.explode(F.sequence(F.col(position).cast("int"), F.col("_last").cast("int")))).drop("_last")


def weighted_mean(df: DataFrame, keys: Sequence[str], values: Sequence[str], weight: str,
                  shares: Mapping[str, Column] | None = None) -> DataFrame:
    """Weighted means over the rows that have a value, plus weight shares over all rows."""
    w = F.col(weight)
    means = [F.try_divide(F.sum(F.col(v) * w), F.sum(F.when(F.col(v).isNotNull(), w))).alias(v) for v in values]
    parts = [F.try_divide(F.sum(F.when(test, w).otherwise(F.lit(0.0))), F.sum(w)).alias(name)
             for name, test in (shares or {}).items()]
    return df.groupBy(*keys).agg(*means, *parts)


def validity_join(df: DataFrame, versions: DataFrame, key: str, ts: str, valid_from: str = "valid_from",
                  valid_to: str = "valid_to", how: str = "left") -> DataFrame:
    """Attach the version valid at `ts`: from <= ts < to, an open `to` meaning forever.

    An equality join with the range as residual test, so Spark broadcasts `versions` while
    it is below the size threshold and shuffles with skew splitting beyond it.
    """
    v = versions.select(*[F.col(c).alias(f"_v_{c}") for c in versions.columns])
    at = F.col(ts)
    on = ((F.col(key) == F.col(f"_v_{key}")) & (at >= F.col(f"_v_{valid_from}"))
          & (F.col(f"_v_{valid_to}").isNull() | (at < F.col(f"_v_{valid_to}"))))
    carried = [c for c in versions.columns if c != key]
    return df.join(v, on, how).select(*df.columns, *[F.col(f"_v_{c}").alias(c) for c in carried])


def version_in_force(df: DataFrame, versions: DataFrame, key: str, ts: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
                     span_seconds: int = 86400, shares: int = 1) -> DataFrame:
    """Attach the version in force at `ts` where a key has very many versions.

    `validity_join` holds each row against every version of its key. Here rows and versions are put in one stream per key,
    sorted by instant, and each row takes the version seen last: the one that started last, if it has not ended. Versions of
    a key that start together count as one, the one that ends last. The stream of a key is cut into spans of time, and within
    a span its rows may be dealt to `shares`, so that no key is one task; every span begins with the version that was in force
    when it began, which a small pass over one row per key and span carries forward. Nothing is joined, so no row is ever
    multiplied. Rows without key or instant get no version.
    """
    carried = [c for c in versions.columns if c != key]
    version = F.struct(*[F.col(c) for c in carried])
    at, fields = F.col(ts).cast("timestamp"), F.struct(*[F.col(c) for c in df.columns])
    row_type, version_type = df.select(fields.alias("r")).schema["r"].dataType, versions.select(version.alias("v")).schema["v"].dataType

    def span(instant: Column) -> Column:
        return F.floor(F.unix_seconds(instant) / span_seconds)

    known = F.col(key).isNotNull() & at.isNotNull()
    share = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(shares)).cast("int") if shares > 1 else F.lit(0)
    rows = df.where(known).select(F.col(key).alias("_key"), span(at).alias("_span"), share.alias("_share"), at.alias("_at"), F.lit(2).alias("_kind"),
                                  fields.alias("_row"), F.lit(None).cast(version_type).alias("_version"))
    starts = F.col(valid_from).cast("timestamp")
    marks = versions.where(F.col(key).isNotNull() & starts.isNotNull()).select(
        F.col(key).alias("_key"), span(starts).alias("_span"), starts.alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast(row_type).alias("_row"), version.alias("_version"))
    ends = F.struct(F.col("_at"), F.col(f"_version.{valid_to}").isNull(), F.col(f"_version.{valid_to}"))
    last = marks.groupBy("_key", "_span").agg(F.max_by("_version", ends).alias("_version"))
    spans = last.unionByName(rows.select("_key", "_span").distinct().withColumn("_version", F.lit(None).cast(version_type)))
    per_span = spans.groupBy("_key", "_span").agg(F.first("_version", ignorenulls=True).alias("_version"))
    before = Window.partitionBy("_key").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    begins = per_span.select("_key", "_span", F.last("_version", ignorenulls=True).over(before).alias("_version")).where("_version IS NOT NULL").select(
        "_key", "_span", F.lit(None).cast("timestamp").alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast(row_type).alias("_row"), "_version")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shares - 1))) if shares > 1 else F.lit(0)
    both = rows.unionByName(marks.unionByName(begins).withColumn("_share", everywhere))
    order = Window.partitionBy("_key", "_span", "_share").orderBy(
        F.col("_at").asc_nulls_first(), "_kind", F.col(f"_version.{valid_to}").asc_nulls_last())
    seen = both.withColumn("_found", F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))).where("_kind = 2")
    ended = F.col("_at") >= F.col(f"_found.{valid_to}").cast("timestamp")
    valid = F.when(~F.coalesce(ended, F.lit(False)), F.col("_found"))
    out = seen.select("_row.*", *[valid.getField(c).alias(c) for c in carried])
    without = df.where(~F.coalesce(known, F.lit(False))).select(*df.columns, *[F.lit(None).cast(version_type[c].dataType).alias(c) for c in carried])
    return out.unionByName(without)


def restrict_to_touched(df: DataFrame, batch: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows of `df` on the (key, day) pairs that `batch` contains."""
    touched = batch.select(*keys, F.to_date(ts).alias("_day")).distinct()
    return df.withColumn("_day", F.to_date(ts)).join(touched, [*keys, "_day"], "left_semi").drop("_day")
