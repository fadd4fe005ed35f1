"""Table changes as DataFrames: conditional upsert, snapshot merge, history, replacement, diff.

Every function returns the full next state with an `_action` column and runs no action.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.scalars import changed

Side = Callable[[str], Column]


def _side(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Prefix the columns and add a salt that spreads rows whose key is NULL.

    Such rows never match, but would otherwise all be hashed to a single partition.
    """
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    salt = F.when(null_key, F.xxhash64(*df.columns)).otherwise(F.lit(0).cast("bigint"))
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns],
                     salt.alias(prefix + "_salt"), F.lit(True).alias(prefix + "_hit"))


def _match(keys: Sequence[str]) -> Column:
    tests = [F.col("t_" + k) == F.col("s_" + k) for k in [*keys, "_salt"]]
    return reduce(lambda a, b: a & b, tests)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
          guard: Callable[[Side, Side], Column] | None = None, lineage: Sequence[str] = (),
          insert_only: Sequence[str] = (), test_change: bool = True, update: bool = True,
          insert: bool = True, delete_missing: bool = False) -> DataFrame:
    """Match `source` to `target` on `keys` and return every resulting row with its action.

    A match is an update when a compared column differs null-safely and `guard` holds.
    Lineage columns are written by an update but do not cause one; `insert_only` columns are
    set for new rows and left alone afterwards. Actions are insert, update, keep and delete.
    The source must hold at most one row per key; more than one raises at run time.
    """
    columns = target.columns
    written = [c for c in columns if c not in keys and c not in insert_only]
    compared = [c for c in written if c not in lineage]

    t = _side(target, keys, "t_")
    s = _side(source.select(*columns), keys, "s_")
    per_key = Window.partitionBy(*["s_" + k for k in keys], "s__salt")
    copies = F.count(F.lit(1)).over(per_key)
    repeated = (copies > 1) & (F.col("s__salt") == 0)
    s = s.withColumn("s__hit", F.when(repeated, F.raise_error(F.lit("merge source repeats a key"))
                                      .cast("boolean")).otherwise(F.col("s__hit")))
    joined = t.join(s, _match(keys), "full_outer")

    def old(c: str) -> Column:
        return F.col("t_" + c)

    def new(c: str) -> Column:
        return F.col("s_" + c)

    in_target, in_source = F.col("t__hit").isNotNull(), F.col("s__hit").isNotNull()
    both = in_target & in_source
    differs = changed([old(c) for c in compared], [new(c) for c in compared]) if test_change else F.lit(True)
    allowed = F.coalesce(guard(old, new), F.lit(False)) if guard else F.lit(True)
    is_update = both & differs & allowed & F.lit(update)
    action = (F.when(is_update, "update").when(both, "keep")
               .when(in_target, "delete" if delete_missing else "keep")
               .when(F.lit(insert), "insert"))
    staged = joined.withColumn("_action", action).where(F.col("_action").isNotNull())

    def final(c: str) -> Column:
        if c in keys:
            return F.coalesce(old(c), new(c)).alias(c)
        take_new = F.col("_action").isin("insert", "update") if c in written else F.col("_action") == "insert"
        return F.when(take_new, new(c)).otherwise(old(c)).alias(c)

    return staged.select(*[final(c) for c in columns], "_action")


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the source rows whose key is not in the target."""
    fresh = source.select(*target.columns).join(target.select(*keys), list(keys), "left_anti")
    return target.withColumn("_action", F.lit("keep")).unionByName(
        fresh.select(*target.columns).withColumn("_action", F.lit("insert")))


def result(merged: DataFrame) -> DataFrame:
    """The table after the change."""
    return merged.where(F.col("_action") != "delete").drop("_action")


def action_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("_action").agg(F.count(F.lit(1)).alias("rows"))


def replace_window(target: DataFrame, new: DataFrame, ts: str, from_instant: str) -> DataFrame:
    """Drop target rows at or after `from_instant` and add the new rows."""
    keep = target.where(F.col(ts) < F.lit(from_instant).cast(target.schema[ts].dataType))
    return keep.unionByName(new.select(*target.columns))


def scd2(dimension: DataFrame, source: DataFrame, key: str, tracked: Mapping[str, object], now: str,
         first_load: bool | None = None, beginning: str = "2000-01-01 00:00:00") -> DataFrame:
    """Next state of a history-keeping dimension with valid_from, valid_to and is_current.

    `tracked` maps each compared column to the value NULL stands for in the comparison.
    Changed current rows are closed at `now` and reopened; codes missing from the source
    stay current; on the first load versions start at `beginning`.
    """
    if first_load is None:
        first_load = dimension.isEmpty()
    opened = F.lit(beginning if first_load else now).cast("timestamp")
    closed = F.lit(now).cast("timestamp")
    s = source.select(F.col(key).alias("s_key"), *[F.col(c).alias("s_" + c) for c in tracked],
                      F.lit(True).alias("s_current"))
    d = dimension.withColumn("_in", F.lit(True))
    joined = d.join(s, (F.col(key) == F.col("s_key")) & (F.col("is_current") == F.col("s_current")), "full_outer")

    tests = [F.coalesce(F.col(c), F.lit(blank)) != F.coalesce(F.col("s_" + c), F.lit(blank))
             for c, blank in tracked.items()]
    is_new = F.col("_in").isNull()
    is_changed = ~is_new & F.col("s_key").isNotNull() & reduce(lambda a, b: a | b, tests)

    types = {f.name: f.dataType for f in dimension.schema}

    def version(action: str, fields: dict[str, Column]) -> Column:
        return F.struct(*[fields.get(c, F.col(c)).cast(types[c]).alias(c) for c in dimension.columns],
                        F.lit(action).alias("_action"))

    as_is = version("keep", {})
    ended = version("close", {"valid_to": closed, "is_current": F.lit(False)})
    current = version("insert", {key: F.col("s_key"), **{c: F.col("s_" + c) for c in tracked},
                                 "valid_from": opened, "valid_to": F.lit(None), "is_current": F.lit(True)})
    rows = (F.when(is_new, F.array(current)).when(is_changed, F.array(ended, current)).otherwise(F.array(as_is)))
    return joined.select(F.inline(rows))


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change feed between two states: insert, delete, and both images of each update."""
    columns = old.columns
    values = [c for c in columns if c not in keys]
    joined = _side(old, keys, "t_").join(_side(new.select(*columns), keys, "s_"), _match(keys), "full_outer")
    is_new, is_gone = F.col("t__hit").isNull(), F.col("s__hit").isNull()
    differs = changed([F.col("t_" + c) for c in values], [F.col("s_" + c) for c in values])

    def image(prefix: str, kind: str) -> Column:
        return F.struct(*[F.col(prefix + c).alias(c) for c in columns], F.lit(kind).alias("_change"))

    rows = (F.when(is_new, F.array(image("s_", "insert"))).when(is_gone, F.array(image("t_", "delete")))
             .when(differs, F.array(image("t_", "update_before"), image("s_", "update_after"))))
    return joined.select(F.inline(rows))
