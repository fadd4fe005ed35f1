"""Column expressions shared by the operators. All of them stay inside codegen."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str

# The only duration form the grid documents use, and the forms of ISO timestamps.
ISO_DURATION = r"^PT(?=\d)(?:(\d+)H)?(?:(\d+)M)?$"
ISO_MINUTE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}Z\z"      # how grid documents write instants
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(ts: ColumnLike) -> Column:
    """yyyymmdd as an int, by arithmetic instead of text formatting."""
    c = _col(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def hour_key(ts: ColumnLike) -> Column:
    return F.hour(_col(ts)).cast("smallint")


def hour_start(ts: ColumnLike) -> Column:
    return F.date_trunc("hour", _col(ts)).cast("timestamp")


def energy_mwh(power_mw: ColumnLike, minutes: ColumnLike) -> Column:
    return _col(power_mw) * _col(minutes) / F.lit(60.0)


def average_mw(mwh: ColumnLike, minutes: ColumnLike) -> Column:
    """Average power over the minutes that are covered."""
    return _col(mwh) * 60 / _col(minutes)


def ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """NULL when the denominator is zero or NULL."""
    return F.try_divide(_col(numerator), _col(denominator))


def exact_sum(value: ColumnLike, scale: int = 6) -> Column:
    """Sum of a double as a fixed-point decimal.

    Every value is rounded to `scale` places, half away from zero, and split into whole units and the rest; both are summed as
    longs, so the aggregation buffer stays primitive and the result does not depend on the order in which partitions are
    merged. NaN and infinite values have no place in a sum and are left out, as NULL is; a sum of such values only is NULL.
    """
    v = _col(value).cast("double")
    rounded = F.round(F.when(F.abs(v) < F.lit(float("inf")), v), scale)
    whole = F.floor(rounded)
    rest = F.round((rounded - whole) * F.lit(float(10 ** scale))).cast("bigint")
    total = F.sum(whole).cast(f"decimal(28,{scale})") + F.sum(rest).cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale))
    return total.cast(f"decimal(28,{scale})")


def to_decimal(value: ColumnLike, precision: int, scale: int) -> Column:
    """Double to decimal, half away from zero, after removing binary noise beyond nine places."""
    return F.round(_col(value), 9).cast(f"decimal({precision},{scale})")


def changed(old: list[Column], new: list[Column]) -> Column:
    """True when any pair differs, NULLs counting as equal to each other."""
    tests = [~o.eqNullSafe(n) for o, n in zip(old, new)]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def any_present(*cols: ColumnLike) -> Column:
    return reduce(lambda a, b: a | b, [_col(c).isNotNull() for c in cols])


def all_present(*cols: ColumnLike) -> Column:
    return reduce(lambda a, b: a & b, [_col(c).isNotNull() for c in cols])


def file_name(path: ColumnLike) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def strip_bom(text: ColumnLike) -> Column:
    return F.regexp_replace(_col(text), r"^\uFEFF+", "")


def blank_to_null(text: ColumnLike) -> Column:
    trimmed = F.btrim(_col(text), F.lit(" \t\r\n"))
    return F.when(trimmed != "", trimmed)


def iso_minutes(text: ColumnLike) -> Column:
    """Minutes of a PT[nH][nM] duration; NULL when the text is anything else."""
    t = F.btrim(_col(text), F.lit(" \t\r\n"))

    def part(i: int) -> Column:
        digits = F.regexp_extract(t, ISO_DURATION, i)
        return F.coalesce(F.when(digits != "", digits).try_cast("int"), F.lit(0))

    return F.when(t.rlike(ISO_DURATION), part(1) * 60 + part(2))


def iso_timestamp(text: ColumnLike) -> Column:
    """ISO dates and times: `T` or a space between them, seconds and fractions optional, a zone with or without a colon."""
    t = F.btrim(_col(text), F.lit(" \t\r\n"))
    full = F.regexp_replace(t, r"^(.{10}[T ]\d{2}:\d{2})(?=$|Z|[+-])", "$1:00")
    full = F.regexp_replace(full, r"(?<=:\d{2}|[.]\d{1,9})([+-]\d{2}):?(\d{2})?$", "$1:$2")
    full = F.regexp_replace(full, r"([+-]\d{2}):$", "$1:00")
    minute = F.concat(F.substring(t, 1, 16), F.lit(":00Z"))
    return F.when(t.rlike(ISO_MINUTE), minute.try_cast("timestamp")).when(t.rlike(ISO_TIMESTAMP), full.try_cast("timestamp"))


def slot_count(start: ColumnLike, end: ColumnLike, step_minutes: ColumnLike) -> Column:
    """Whole steps between two instants, truncated."""
    seconds = F.timestamp_diff("SECOND", _col(start), _col(end))
    return (seconds / (_col(step_minutes) * 60)).cast("int")


def slot_start(start: ColumnLike, position: ColumnLike, step_minutes: ColumnLike) -> Column:
    return F.timestamp_add("MINUTE", ((_col(position) - 1) * _col(step_minutes)).cast("int"), _col(start))


def split_pair(key: ColumnLike, separator: str = ">") -> tuple[Column, Column]:
    parts = F.split(_col(key), separator)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def since(df: DataFrame, ts: str, instant: str) -> Column:
    """`ts >= instant` with the literal typed like the column, so the scan can push it down."""
    return F.col(ts) >= F.lit(instant).cast(df.schema[ts].dataType)


def before(df: DataFrame, ts: str, instant: str) -> Column:
    return F.col(ts) < F.lit(instant).cast(df.schema[ts].dataType)


def fill_template(template: str) -> Column:
    """Text with `{column:spec}` slots filled from the row; specs are those of number formats:
    `.1f`, `02.0f`, `.1%`, `+.1%`. A slot without a spec takes the column as text."""
    pattern, values = "", []
    for literal, name, spec, _ in Formatter().parse(template):
        pattern += literal.replace("%", "%%")
        if name is None:
            continue
        value = F.col(name)
        if spec.endswith("%"):
            pattern += f"%{spec[:-1]}f%%"
            value = value.cast("double") * 100
        elif spec:
            pattern += f"%{spec}"
            value = value.cast("double")
        else:
            pattern += "%s"
            value = value.cast("string")
        values.append(value)
    return F.format_string(pattern, *values)
