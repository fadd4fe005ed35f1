import pytest
from pyspark.sql import functions as F

from helpers import clock, found
from voltframe import schemas
from voltframe.functions import scalars as f
from voltframe.operators import security
from voltframe.sources import files


def test_iso_minutes(frame):
    df = frame("t string", [("PT15M",), ("PT1H",), (" PT1H30M ",), ("PT",), ("P1D",), ("PT30S",), ("PT60M",), (None,), ("",)])
    got = dict(found(df.select("t", f.iso_minutes("t").alias("m"))))
    assert got == {"PT15M": 15, "PT1H": 60, " PT1H30M ": 90, "PT": None, "P1D": None, "PT30S": None, "PT60M": 60, None: None, "": None}


def test_iso_timestamp_and_slots(frame):
    df = frame("s string, e string", [("2025-01-01T00:00Z", "2025-01-01T02:20Z"), ("2025-01-01T01:00+01:00", "2025-01-01T02:20:00Z"), ("x", "2025")])
    out = df.select(f.iso_timestamp("s").alias("s"), f.iso_timestamp("e").alias("e")).withColumn("n", f.slot_count("s", "e", F.lit(30)))
    assert clock(out) == [("2025-01-01 00:00", "2025-01-01 02:20", 4), ("2025-01-01 00:00", "2025-01-01 02:20", 4), (None, None, None)]


def test_exact_sum_does_not_depend_on_order(spark):
    df = spark.range(0, 3000, 1, 7).select((F.col("id") * 0.1).alias("v"))
    a, b = df.agg(f.exact_sum("v")).first()[0], df.orderBy(F.desc("v")).coalesce(1).agg(f.exact_sum("v")).first()[0]
    assert a == b and str(a) == "449850.000000"


def test_keys_pairs_and_text(frame):
    df = frame("ts timestamp_ntz, pair string", [(__import__("datetime").datetime(2025, 6, 5, 7, 59), "NL>DE")])
    a, b = f.split_pair("pair")
    row = df.select(f.date_key("ts"), f.hour_key("ts"), a, b, f.file_name(F.lit("a/b/c.xml")), f.strip_bom(F.lit("﻿[]")), f.ratio(F.lit(1.0), F.lit(0.0))).first()
    assert list(row) == [20250605, 7, "NL", "DE", "c.xml", "[]", None]


def test_templates(frame):
    df = frame("h int, x double, s string", [(7, -0.0123, "NL")])
    assert df.select(f.fill_template("100% {s}: {h:02.0f}:00, {x:+.1%} or {x:.3f}")).first()[0] == "100% NL: 07:00, -1.2% or -0.012"


def test_since_is_pushed_to_the_scan(spark, tmp_path):
    spark.sql("SELECT timestamp_ntz'2024-01-01' AS a, timestamp'2024-01-01' AS b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for c in ("a", "b"):
        plan = df.where(f.since(df, c, "2024-01-01"))._jdf.queryExecution().executedPlan().toString()
        assert f"GreaterThanOrEqual({c}" in plan


def test_align(frame):
    df = frame("b string, extra int", [("5", 1)])
    out = schemas.align(df, schemas.describe("b int"))
    assert out.columns == ["b"] and out.first()[0] == 5
    with pytest.raises(ValueError, match="missing columns \\['c'\\]"):
        schemas.align(df, schemas.describe("b int\nc string"), "t")


def test_masking(frame):
    df = frame("n int, t string, keep string", [(7, "secret", "x")])
    assert found(security.mask(df, "n", "t")) == [(0, "xxxx", "x")]
    assert security.deny(df, ["t"]).columns == ["n", "keep"]


def test_raw_path(frame):
    df = frame("s timestamp_ntz, e timestamp_ntz", [(__import__("datetime").datetime(2024, 1, 15), __import__("datetime").datetime(2024, 2, 1))])
    p = files.raw_path(F.lit("crossborder_flow"), F.lit("NL>DE"), F.col("s"), F.col("e"), F.lit("r1"), "xml")
    assert df.select(p).first()[0] == ("crossborder_flow/NL_to_DE/2024/01/"
                                      "crossborder_flow__NL_to_DE__20240115T0000_20240201T0000__r1.xml")


def test_exact_sum_bears_large_totals_and_odd_values(spark):
    big = spark.createDataFrame([(4e12,)] * 4 + [(1e13,), (None,)], "v double")
    assert float(big.agg(f.exact_sum("v")).first()[0]) == 2.6e13
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.25,)], "v double")
    assert float(odd.agg(f.exact_sum("v")).first()[0]) == 1.25
    assert odd.where("v > 2").agg(f.exact_sum("v")).first()[0] is None


def test_iso_timestamp_forms(spark):
    forms = {"2024-01-01T00:00Z": "00:00", "2024-01-01T00:00:00.000Z": "00:00", "2024-01-01 00:00Z": "00:00", "2024-01-01": "00:00",
             "2024-01-01T10:00+0200": "08:00", "2024-01-01T10:00+02": "08:00", "2024-01-01T10:00:05.5-01:30": "11:30", "2024": None, "x": None, "2024-13-01": None}
    df = spark.createDataFrame(list(forms.items()), "t string, want string")
    got = df.select("t", F.date_format(f.iso_timestamp("t"), "HH:mm").alias("v")).collect()
    assert {r["t"]: r["v"] for r in got} == forms


def test_exact_sum_equals_decimal_sums(spark):
    from decimal import ROUND_HALF_UP, Decimal

    values = [-0.1234565, 0.1, 0.2, -3.5, 1e12 + 0.25, -1e12 - 0.75, 2.0000005, 0.0, 123456789.123456, -0.0000004, 9.9999995]
    want = sum(Decimal(repr(v)).quantize(Decimal("0.000001"), ROUND_HALF_UP) for v in values)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.agg(f.exact_sum("v").alias("s"))
    assert got.first()["s"] == want and got.schema["s"].dataType.simpleString() == "decimal(28,6)"
