"""Quality checks over a whole table from maintained counts: only days whose files changed since the last check are read.

Duplicates, values out of range, codes in use and the latest instant are kept per day and add up to those of the whole table,
because a key holds its day, a count is a sum, a set of codes a union and an instant a maximum. A day is read again when a
digest of its file listing differs from the one noted with its counts; days that vanished lose theirs. Counts are written before
the note, so a crash in between only has days counted again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltframe.functions.scalars import date_key
from voltframe.operators.quality import Rule, check_row, report
from voltframe.operators.tables import Day, Lake
from voltframe.schemas import describe

COUNTS = describe("""
    day_key int !
    check_name string !
    scope string !
    n bigint
    last timestamp
""")
CODES = describe("""
    day_key int !
    column_name string !
    code string !
""")
STATE = "ctl_check_state"
STATE_SCHEMA = describe("""
    table_name string !
    day_key int !
    stamp string !
""")


class Reference(NamedTuple):
    """The values that a column may hold; `listed` has them in its column `column_of`."""

    column: str
    listed: DataFrame
    column_of: str
    name: str = "area_in_reference"


class Rules(NamedTuple):
    keys: Sequence[str]
    references: Sequence[Reference] = ()
    ranges: Sequence[Rule] = ()
    fresh_hours: int | None = None
    ts: str = "ts_utc"


def state_tables(tables: Sequence[str]) -> tuple[dict[str, T.StructType], dict[str, Day]]:
    """Schemas and partitions of the tables that hold the counts of the given ones."""
    schemas = {STATE: STATE_SCHEMA} | {f"{t}_counts": COUNTS for t in tables} | {f"{t}_codes": CODES for t in tables}
    return schemas, {n: Day("day_key") for n in schemas if n != STATE}


def refresh(lake: Lake, table: str, rules: Rules) -> list[int]:
    """Count again the days of a table that changed since the last call; returns them."""
    day = lake.days[table]
    if not day.fixed_by(rules.keys):
        raise ValueError(f"{table}: rows of one key may lie in several parts")
    now = lake.stamps(table)
    noted = {r["day_key"]: r["stamp"] for r in lake.read(STATE).where(F.col("table_name") == table).collect()}
    changed = sorted(d for d in now.keys() | noted.keys() if now.get(d) != noted.get(d))
    if not changed:
        return []
    with lake.scratch():
        rows = lake.read(table, days=[d for d in changed if d in now]).withColumn("day_key", date_key(day.ts) if day.ts else F.col(day.column))
        lake.replace_parts(f"{table}_counts", _counts(rows, rules), changed)
        lake.replace_parts(f"{table}_codes", _codes(rows, rules), changed)
        marks = lake.spark.createDataFrame([(table, d, now[d]) for d in changed if d in now], STATE_SCHEMA)
        others = lake.read(STATE).where((F.col("table_name") != table) | ~F.col("day_key").isin(changed))
        lake.overwrite(STATE, others.unionByName(marks))
    return changed


def _counts(rows: DataFrame, rules: Rules) -> DataFrame:
    """(day_key, check_name, scope, n, last): one scan for ranges and instants, one grouping by key for duplicates."""
    none = F.lit(None)
    parts = [F.struct(F.lit("value_range").alias("check_name"), F.lit(c).alias("scope"), F.col(f"r{i}").alias("n"), none.cast("timestamp").alias("last"))
             for i, (c, _, _) in enumerate(rules.ranges)]
    parts.append(F.struct(F.lit("freshness_hours").alias("check_name"), F.lit(rules.ts).alias("scope"), none.cast("bigint").alias("n"), F.col("_last").alias("last")))
    ranges = [F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"r{i}") for i, (c, lo, hi) in enumerate(rules.ranges)]
    scanned = rows.groupBy("day_key").agg(*ranges, F.max(rules.ts).cast("timestamp").alias("_last")).select("day_key", F.inline(F.array(*parts)))
    copies = rows.groupBy("day_key", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(rules.keys)]).agg(F.count(F.lit(1)).alias("copies"))
    repeated = copies.where("copies > 1").groupBy("day_key").agg(F.count(F.lit(1)).alias("n"))
    return scanned.unionByName(repeated.select("day_key", F.lit("unique_key").alias("check_name"), F.lit(",".join(rules.keys)).alias("scope"), "n",
                                               F.lit(None).cast("timestamp").alias("last")))


def _codes(rows: DataFrame, rules: Rules) -> DataFrame:
    """(day_key, column_name, code): the distinct values of each checked column."""
    names = list(dict.fromkeys(r.column for r in rules.references))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("code")) for c in names]) if names else F.array().cast(
        "array<struct<column_name:string,code:string>>")
    return rows.select("day_key", F.inline(pairs)).where("code IS NOT NULL").distinct()


def checked(lake: Lake, table: str, rules: Rules, as_of: str) -> DataFrame:
    """The checks of `quality.unique_key`, `in_reference` and `scan_checks` for the whole table, from the counts."""
    counts = lake.read(f"{table}_counts")

    def total(name: str, scope: str):
        mine = (F.col("check_name") == name) & (F.col("scope") == scope)
        return F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0))

    keys = ",".join(rules.keys)
    sums = counts.agg(total("unique_key", keys).alias("dup"), *[total("value_range", c).alias(f"r{i}") for i, (c, _, _) in enumerate(rules.ranges)],
                      F.max("last").alias("last"))
    rows = [check_row("unique_key", table, keys, F.col("dup"), "= 0", "FAIL", F.col("dup") == 0)]
    rows += [check_row("value_range", table, c, F.col(f"r{i}"), f"[{lo}, {hi}]", "WARN", F.col(f"r{i}") == 0) for i, (c, lo, hi) in enumerate(rules.ranges)]
    if rules.fresh_hours is not None:
        age = F.coalesce(F.timestamp_diff("SECOND", "last", F.lit(as_of).cast("timestamp")) / F.lit(3600.0), F.lit(1e9))
        latest = F.coalesce(F.date_format("last", "yyyy-MM-dd HH:mm:ss"), F.lit("None"))
        rows.append(check_row("freshness_hours", table, f"max({rules.ts})", F.round(age, 1), f"<= {rules.fresh_hours} h", "WARN", age <= rules.fresh_hours,
                              F.concat(F.lit(f"latest {rules.ts} "), latest)))
    parts = [sums.select(F.inline(F.array(*rows)))]
    for ref in rules.references:
        known = ref.listed.select(F.col(ref.column_of).cast("string").alias("code"))
        used = lake.read(f"{table}_codes").where(F.col("column_name") == ref.column).select("code").distinct()
        unknown = used.join(known, "code", "left_anti").agg(F.count("code").alias("n"))
        parts.append(unknown.select(F.inline(F.array(check_row(ref.name, table, ref.column, F.col("n"), "= 0", "FAIL", F.col("n") == 0)))))
    return report(*parts)


def check_all(lake: Lake, rules: Mapping[str, Rules], as_of: str) -> DataFrame:
    """Refresh the counts of every table, then report on all of them."""
    for table, own in rules.items():
        refresh(lake, table, own)
    return report(*[checked(lake, table, own, as_of) for table, own in rules.items()])
