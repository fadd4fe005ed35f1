"""Data-quality checks. Each returns rows shaped like the check-result table.

Range rules and freshness of a table share one aggregate; uniqueness, references and completeness each group the
table their own way. The offending rows themselves stay available as DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions.scalars import all_present

CHECK_COLUMNS = ["check_name", "table_name", "scope", "metric", "threshold", "status", "details"]
WORST_DAYS = 5


def check_row(name: str, table: str, scope: Column | str, metric: Column, threshold: Column | str,
           failed: str, ok: Column, details: Column | None = None) -> Column:
    def text(v):
        return F.lit(v) if isinstance(v, str) else v

    return F.struct(F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
                    text(scope).alias("scope"), metric.cast("double").alias("metric"),
                    text(threshold).alias("threshold"),
                    F.when(ok, "PASS").otherwise(failed).alias("status"),
                    (details if details is not None else F.lit("")).alias("details"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def unique_key(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    found = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("n"))
    return found.select(F.inline(F.array(check_row(
        "unique_key", table, ",".join(keys), F.col("n"), "= 0", "FAIL", F.col("n") == 0))))


def unknown_values(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Distinct non-NULL values that the reference does not list."""
    known = reference.select(F.col(reference_column).alias(column))
    return df.where(F.col(column).isNotNull()).select(column).distinct().join(known, column, "left_anti")


def unknown_codes(df: DataFrame, table: str, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Every unknown value as a row of its own: table_name, column_name, code."""
    found = unknown_values(df, column, reference, reference_column)
    return found.select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.col(column).cast("string").alias("code"))


def in_reference(df: DataFrame, table: str, column: str, reference: DataFrame, reference_column: str,
                 name: str = "area_in_reference") -> DataFrame:
    """How many distinct values are unknown; `unknown_codes` names them."""
    found = unknown_values(df, column, reference, reference_column).agg(F.count(column).alias("n"))
    return found.select(F.inline(F.array(check_row(name, table, column, F.col("n"), "= 0", "FAIL", F.col("n") == 0))))


Rule = tuple[str, float, float]


def scan_checks(df: DataFrame, table: str, rules: Sequence[Rule] = (), fresh_hours: int | None = None,
                as_of: str | None = None, ts: str = "ts_utc") -> DataFrame:
    """All checks that one pass over the table answers: value ranges and freshness.

    Ranges have inclusive bounds and NULLs pass. Freshness is the age of the latest instant.
    """
    wanted = [F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"r{i}") for i, (c, lo, hi) in enumerate(rules)]
    checks = [check_row("value_range", table, c, F.col(f"r{i}"), f"[{lo}, {hi}]", "WARN", F.col(f"r{i}") == 0)
              for i, (c, lo, hi) in enumerate(rules)]
    if fresh_hours is not None:
        wanted.append(F.max(ts).cast("timestamp").alias("last"))
        age = F.coalesce(F.timestamp_diff("SECOND", "last", F.lit(as_of).cast("timestamp")) / F.lit(3600.0), F.lit(1e9))
        latest = F.coalesce(F.date_format("last", "yyyy-MM-dd HH:mm:ss"), F.lit("None"))
        checks.append(check_row("freshness_hours", table, f"max({ts})", F.round(age, 1), f"<= {fresh_hours} h", "WARN",
                             age <= fresh_hours, F.concat(F.lit(f"latest {ts} "), latest)))
    return df.agg(*wanted).select(F.inline(F.array(*checks)))


def value_ranges(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    return scan_checks(df, table, rules)


def recent(df: DataFrame, ts: str, as_of: str, check_days: int, full_check: bool = False) -> DataFrame:
    if full_check or ts not in df.columns:
        return df
    edge = F.date_sub(F.lit(as_of).cast("date"), check_days).cast(df.schema[ts].dataType)
    return df.where(F.col(ts) >= edge)


def minutes_per_day(df: DataFrame, scope: Sequence[str], as_of: str, ts: str = "ts_utc",
                    minutes: str = "resolution_minutes") -> DataFrame:
    """Published minutes and resolutions per scope and finished day, distinct intervals only."""
    last = F.date_sub(F.lit(as_of).cast("date"), 1).cast(df.schema[ts].dataType)
    intervals = df.where(F.col(ts) < last).select(*scope, F.to_date(ts).alias("day"), minutes, ts).distinct()
    return intervals.groupBy(*scope, "day").agg(
        F.sum(minutes).alias("minutes"),
        F.size(F.collect_set(minutes)).alias("resolutions"))


def worst_days(per_day: DataFrame, scope: Sequence[str], expected: int = 1440, n: int = WORST_DAYS) -> DataFrame:
    return per_day.where(F.col("minutes") < expected).orderBy("minutes", *scope, "day").limit(n)


def completeness(df: DataFrame, table: str, scope: Sequence[str], as_of: str, ts: str = "ts_utc",
                 minutes: str = "resolution_minutes", expected: int = 1440) -> DataFrame:
    per_day = minutes_per_day(df, scope, as_of, ts, minutes)
    m = F.col("minutes")
    counted = per_day.agg(F.count(F.lit(1)).alias("days"), F.count_if(m < expected).alias("gaps"),
                          F.count_if(m > expected).alias("overlaps")).withColumn("worst", F.lit(None).cast("string"))
    label = F.format_string("%s %s %dmin", F.concat_ws("/", *scope), F.col("day").cast("string"), m)
    worst = (worst_days(per_day, scope, expected)
             .select(F.struct(m, *scope, "day", label.alias("label")).alias("w"))
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list("w")), lambda w: w.getField("label")), "; ").alias("worst")))
    both = counted.unionByName(worst, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("days", "gaps", "overlaps", "worst")])
    text = {c: F.col(c).cast("string") for c in ("days", "gaps", "overlaps")}
    gap_text = F.concat(text["gaps"], F.lit(" of "), text["days"], F.lit(" scope-days incomplete; worst: "), F.col("worst"))
    overlap_text = F.concat(text["overlaps"], F.lit(" scope-days published at more than one resolution"))
    label = ",".join(scope)
    return both.select(F.inline(F.array(
        check_row("completeness_gap_days", table, label, F.col("gaps"), f"minutes < {expected}", "WARN",
               F.col("gaps") == 0, gap_text),
        check_row("completeness_overlap_days", table, label, F.col("overlaps"), f"minutes > {expected}", "INFO",
               F.col("overlaps") == 0, overlap_text))))


def freshness(df: DataFrame, table: str, as_of: str, limit_hours: int, ts: str = "ts_utc") -> DataFrame:
    return scan_checks(df, table, (), limit_hours, as_of, ts)


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def stamp(checks: DataFrame, run_id: str, checked_at: str) -> DataFrame:
    return checks.select(F.lit(run_id).alias("run_id"), F.lit(checked_at).cast("timestamp").alias("checked_at"),
                         *CHECK_COLUMNS)


def split_required(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every required field, the other rows)."""
    complete = all_present(*required)
    return df.where(complete), df.where(~complete)


def quarantine(rejected: DataFrame, table: str, key_columns: Sequence[str], rule: str, details: Column | str,
               source_file: str | None = None, detected_at: str | None = None) -> DataFrame:
    """Rejected rows in the quarantine layout with a readable key."""
    when = F.lit(detected_at).cast("timestamp") if detected_at else F.current_timestamp()
    return rejected.select(
        F.lit(table).alias("table_name"), F.concat_ws("|", *key_columns).alias("record_key"),
        F.lit(rule).alias("rule_name"), (F.lit(details) if isinstance(details, str) else details).alias("details"),
        (F.col(source_file) if source_file else F.lit(None).cast("string")).alias("source_file"),
        when.alias("detected_at"))


def reconcile(left: DataFrame, left_value: str, right: DataFrame, right_value: str, tolerance: float = 1) -> DataFrame:
    """One row: both totals at three decimals, their distance, and OK or FAILED."""
    kind = "decimal(18,3)"
    a = left.agg(F.sum(left_value).alias("v")).select(F.col("v").cast(kind).alias("gold"), F.lit(None).cast(kind).alias("silver"))
    b = right.agg(F.sum(right_value).alias("v")).select(F.lit(None).cast(kind).alias("gold"), F.col("v").cast(kind).alias("silver"))
    totals = a.unionByName(b).agg(F.max("gold").alias("gold"), F.max("silver").alias("silver"))
    zero = F.lit(0).cast(kind)
    distance = F.abs(F.coalesce("gold", zero) - F.coalesce("silver", zero)).cast(kind)
    return totals.withColumn("difference", distance).withColumn(
        "status", F.when(F.col("difference") <= F.lit(tolerance), "OK").otherwise("FAILED"))


def enforce(df: DataFrame, holds: Column, message: Column) -> DataFrame:
    """The same rows; the job that reads them fails on the first row for which `holds` is not true."""
    passes = F.when(F.coalesce(holds, F.lit(False)), True).otherwise(F.raise_error(message).cast("boolean"))
    return df.where(passes)


def require_subset(df: DataFrame, column: str, allowed: Sequence[str], what: str) -> None:
    """Raise when a value, NULL included, lies outside `allowed`; reads one row of evidence."""
    bad = df.where(~F.coalesce(F.col(column).isin(*allowed), F.lit(False))).select(column).limit(1).collect()
    if bad:
        raise ValueError(f"{what}: expected one of {list(allowed)}, got {bad[0][0]!r}")


def require_present(df: DataFrame, column: str, label: str, what: str) -> None:
    """Raise when `column` is NULL somewhere, naming the row by `label`."""
    bad = df.where(F.col(column).isNull()).select(label).limit(1).collect()
    if bad:
        raise ValueError(f"{what}: {bad[0][0]!r}")
