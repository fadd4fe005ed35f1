"""Grid documents (load, generation, price, flow) parsed inside Catalyst.

One row holds one document, so a document is judged and unfolded without a shuffle. A
document with any fault gives no rows at all and one quarantine row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions.scalars import blank_to_null, iso_minutes, iso_timestamp, slot_count, slot_start
from voltframe.operators.quality import quarantine

PRICE_DATASET = "day_ahead_price"           # fixed values
GENERATION_DATASET = "actual_generation"
OUT_DOMAIN = "outBiddingZone_Domain.mRID"

SCHEMA = (
    f"TimeSeries array<struct<`{OUT_DOMAIN}`: string, MktPSRType: struct<psrType: string>, curveType: string, "
    "Period: array<struct<timeInterval: struct<`start`: string, `end`: string>, resolution: string, "
    "Point: array<struct<position: string, quantity: string, `price.amount`: string>>>>>>, _malformed string"
)
# Tags are matched without their namespace prefixes, and no attribute is read.
XML_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed", "ignoreNamespace": "true", "excludeAttribute": "true"}
# Fixed values. Of several faults of a document the one listed first is named.
FAULTS = ("malformed XML", "missing or unreadable start or end", "unsupported resolution", "value is not a number",
          "missing or unreadable position")
MALFORMED, INTERVAL, RESOLUTION, NUMBER, POSITION = range(len(FAULTS))


def _computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    Several expressions and lambdas below refer to them; a plain projection would be inlined
    into each reference, computing them again for every point.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _each(items: Column, *steps: Callable[..., Column]) -> Column:
    """`transform` step by step, so that what a step makes of an item is evaluated once however often the next refers to it."""
    return reduce(F.transform, steps, items)


def read_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `series` (the parsed tree, its numbers and instants typed) and `fault` (NULL when the document is sound).

    Each number and instant is read once: faults are told from what was read, and `intervals` unfolds the same.
    """
    tree = F.from_xml(F.col(text), SCHEMA, XML_OPTIONS)

    def typed(doc: Column) -> Column:
        return F.struct((doc.isNull() | doc.getField("_malformed").isNotNull()).alias("malformed"),
                        F.transform(doc.getField("TimeSeries"), lambda series: _typed_series(series, F.col("dataset"))).alias("series"))

    def judged(read: Column) -> Column:
        return F.struct(read.getField("series").alias("series"), _fault(read).alias("fault"))

    return docs.select("*", F.inline(_each(F.array(tree), typed, judged)))


def _typed_series(series: Column, dataset: Column) -> Column:
    def point(p: Column, i: Column) -> Column:
        text = F.when(dataset == PRICE_DATASET, p.getField("price.amount")).otherwise(p.getField("quantity"))
        # casts pass over blanks around a number; a text that is no number is told from a missing one by NaN
        number = F.coalesce(text.try_cast("double"), F.when(blank_to_null(text).isNotNull(), F.lit(float("nan"))))
        return F.struct(p.getField("position").try_cast("int").alias("position"), i.alias("i"), number.alias("value"))

    def period(p: Column) -> Column:
        span = p.getField("timeInterval")
        return F.struct(iso_timestamp(span.getField("start")).alias("start"), iso_timestamp(span.getField("end")).alias("end"),
                        iso_minutes(p.getField("resolution")).alias("resolution_minutes"), F.transform(p.getField("Point"), point).alias("points"))

    return F.struct(series.getField(OUT_DOMAIN).isNotNull().alias("out_domain"), series.getField("MktPSRType").getField("psrType").alias("psr_type"),
                    series.getField("curveType").alias("curve"), F.transform(series.getField("Period"), period).alias("periods"))


def _fault(read: Column) -> Column:
    def of_point(p: Column) -> Column:
        value = p.getField("value")
        return (F.when(value.isNotNull() & ~(F.abs(value) < F.lit(float("inf"))), NUMBER)
                 .when(value.isNotNull() & p.getField("position").isNull(), POSITION))

    def of_period(p: Column) -> Column:
        return (F.when(p.getField("start").isNull() | p.getField("end").isNull(), INTERVAL)
                 .when(F.coalesce(p.getField("resolution_minutes"), F.lit(0)) == 0, RESOLUTION)
                 .otherwise(F.array_min(F.transform(p.getField("points"), of_point))))

    def of_series(series: Column) -> Column:
        return F.array_min(F.transform(series.getField("periods"), of_period))

    first = F.when(read.getField("malformed"), MALFORMED).otherwise(F.array_min(F.transform(read.getField("series"), of_series)))
    return F.get(F.array(*[F.lit(f) for f in FAULTS]), first)


def intervals(read: DataFrame, *keep: str, faults: bool = False) -> DataFrame:
    """One row per interval of the sound documents, `keep` naming document columns to carry.

    Curve A03 repeats a value until the next listed position; any other curve has listed
    positions only. The last of a repeated position wins. Work is bounded by one document.
    With `faults` each faulty document passes through as a single row whose `fault` is set, so
    that one pass over the documents yields both results.
    """
    sound = F.when(F.col("fault").isNull(), F.col("series"))
    series = read.select("dataset", *keep, "fault", F.explode_outer(sound).alias("series"))
    periods = series.select(
        "dataset", *keep, "fault",
        blank_to_null("series.psr_type").alias("psr_type_code"),
        F.when(F.col("dataset") == GENERATION_DATASET, F.when(F.col("series.out_domain"), "consumption").otherwise("generation")).alias("direction"),
        F.coalesce(blank_to_null("series.curve"), F.lit("A01")).alias("curve"),
        F.explode_outer("series.periods").alias("period"))
    timed = _computed(periods.select("*", "period.start", "period.resolution_minutes"),
                      slots=slot_count("period.start", "period.end", "period.resolution_minutes"))
    valued = F.filter("period.points", lambda p: p.getField("value").isNotNull() & (p.getField("position") <= F.col("slots"))
                      & ((F.col("curve") != "A03") | (p.getField("position") >= 1)))

    def with_next(points: Column) -> Column:
        # a point is followed by its successor in position order; an equal successor replaces it
        return F.zip_with(points, F.slice(points, F.lit(2), F.greatest(F.size(points), F.lit(1))),
                          lambda p, q: F.struct(p.getField("position").alias("position"), p.getField("value").alias("value"),
                                                q.getField("position").alias("next")))

    pairs = F.flatten(_each(F.array(F.sort_array(valued)), with_next))
    runs = (timed.select("dataset", *keep, "fault", "psr_type_code", "direction", "curve", "start", "resolution_minutes", "slots", F.inline_outer(pairs))
            .where(F.col("next").isNull() | (F.col("next") != F.col("position"))))
    last = F.when(F.col("curve") == "A03", F.coalesce(F.col("next") - 1, "slots")).otherwise(F.col("position"))
    listed = runs.withColumn("slot", F.explode_outer(F.sequence("position", last)))
    wanted = F.col("value").isNotNull() | F.col("fault").isNotNull() if faults else F.col("value").isNotNull()
    return listed.where(wanted).select(
        "dataset", *keep, "psr_type_code", "direction", slot_start("start", "slot", "resolution_minutes").alias("ts_utc"),
        "resolution_minutes", "value", *(["fault"] if faults else []))


def rejected(read: DataFrame, table: str, source_file: str, detected_at: str | None = None) -> DataFrame:
    bad = read.where(F.col("fault").isNotNull())
    return quarantine(bad, table, [source_file], "xml_parse_error", F.col("fault"), source_file, detected_at)
