from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from helpers import at, clock, found
from voltframe.operators import dedupe, series
from voltframe.plans import gold, silver
from voltframe.sources import reference

NOW = "2025-01-02 00:00:00"


def quarter_hours(hour, res, values):
    return [("A", at(f"2025-01-01 {hour:02d}:{i * res:02d}"), res, float(v)) for i, v in enumerate(values)]


@pytest.fixture
def area(frame):
    return frame("area_code string, country_code string", [("A", "C"), ("B", "C2")])


def test_latest_and_preferred(frame):
    df = frame("k int, src string, at int, f string, v int", [(1, "forecast", 9, "z", 1), (1, "archive", 1, "a", 2), (1, "archive", 1, "b", 3), (None, "x", 1, "a", 4), (None, "x", 2, "a", 5)])
    assert found(dedupe.latest(df, ["k"], "at", "f"), "k", "v") == [(1, 1), (None, 5)]
    assert found(dedupe.preferred_then_latest(df, ["k"], F.col("src") == "archive", "at", "f"), "k", "v") == [(1, 3), (None, 5)]


def test_row_choice_trims_before_the_shuffle(frame):
    df = frame("k int, v int", [(1, 1), (1, 2)]).repartition(3)
    plan = dedupe.latest(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("carry,expected", [(True, [(1, 5), (2, 5), (3, 7), (4, 7)]), (False, [(1, 5), (3, 7)])])
def test_fill(frame, carry, expected):
    df = frame("k int, p int, v double, i int", [(1, 1, 5.0, 0), (1, 3, 7.0, 1), (1, 5, 9.0, 2), (1, 2, None, 3)])
    assert found(series.fill_slots(df, ["k"], "p", 4, "v", carry), "p", "v") == expected


def test_fill_leading_gap_and_repeats(frame):
    df = frame("k int, p int, v double, i int", [(1, 2, 3.0, 0), (1, 2, 4.0, 1)])
    assert found(series.fill_slots(df, ["k"], "p", 4, "v", True, "i"), "p", "v") == [(2, 4.0), (3, 4.0), (4, 4.0)]


def test_weighted_mean_renormalises_but_share_does_not(frame):
    df = frame("c string, v double, w double, s string", [("x", 10.0, .3333, "archive"), ("x", None, .3333, "f"), ("x", 20.0, .3334, "f")])
    mean, share = series.weighted_mean(df, ["c"], ["v"], "w", {"share": F.col("s") == "archive"}).select("v", "share").first()
    assert mean == pytest.approx(15.00075, abs=1e-4) and share == pytest.approx(.3333)


def prices(frame, area, *parts):
    df = frame("area_code string, ts_utc timestamp, resolution_minutes int, price_eur_mwh double", [r for p in parts for r in p])
    return found(gold.price_hourly(df, area, NOW), "price_eur_mwh", "min_price_eur_mwh", "max_price_eur_mwh", "source_resolution_minutes", "source_slots")


def test_price_prefers_sixty_minutes(frame, area):
    quarters = quarter_hours(0, 15, [40, 44, 48, 52])
    assert prices(frame, area, quarters, quarter_hours(0, 60, [50])) == [(D("50.00"), D("50.00"), D("50.00"), 60, 1)]
    assert prices(frame, area, quarters) == [(D("46.00"), D("40.00"), D("52.00"), 15, 4)]
    assert prices(frame, area, quarters[:3])[0][0] == D("44.00")


FLOW = "from_area_code string, to_area_code string, ts_utc timestamp, resolution_minutes int, energy_mwh double"


def test_flow_uses_one_resolution(frame, area):
    def flow(n):
        rows = [("A", "B", at("2025-01-01 00:00"), 60, 100.0), *[("A", "B", at(f"2025-01-01 00:{i * 15:02d}"), 15, 24.0) for i in range(n)]]
        return found(gold.flow_hourly(frame(FLOW, rows), area, NOW), "flow_mwh", "source_resolution_minutes", "from_country_code", "to_country_code")

    assert flow(4) == [(D("96.000"), 15, "C", "C2")]
    assert flow(3) == [(D("100.000"), 60, "C", "C2")]


LOAD = "area_code string, ts_utc timestamp, resolution_minutes int, energy_mwh double"


def test_load_sums_all_resolutions_and_drops_unknown_areas(frame, area):
    rows = [*quarter_hours(0, 60, [100]), *quarter_hours(0, 15, [24] * 4), ("ZZ", at("2025-01-01"), 60, 5.0)]
    load = frame(LOAD, rows)
    assert found(gold.load_hourly(load, area, NOW), "load_mwh", "coverage_minutes", "avg_load_mw") == [(D("196.000"), 120, D("98.000"))]
    assert found(gold.unmatched(load, area)) == [("ZZ", 1)]


GEN = "area_code string, ts_utc timestamp, resolution_minutes int, energy_mwh double, psr_type_code string, direction string"
FACTOR = "psr_type_code string, lifecycle_gco2e_per_kwh decimal(6,1), valid_from timestamp, valid_to timestamp"


def test_factor_valid_at_the_start_of_the_hour(frame, area):
    switch = at("2025-01-01 10:30")
    gen = frame(GEN, [("A", at(f"2025-01-01 {h}:00"), 60, 2.0, "B04", "generation") for h in (10, 11)] + [("A", at("2025-01-01 11:00"), 60, 9.0, "B10", "consumption")])
    factor = frame(FACTOR, [("B04", D(490), at("2000-01-01"), switch), ("B04", D(500), switch, None)])
    assert found(gold.generation_hourly(gen, area, factor, NOW), "hour_key", "generation_mwh", "co2e_kg") == [
        (10, D("2.000"), D("980.000")), (11, D("2.000"), D("1000.000"))]


def carbon(spark, frame, area, energies):
    kinds = gold.dim_production_type(reference.production_type(spark))
    factor = kinds.select("psr_type_code", "lifecycle_gco2e_per_kwh", F.lit("2000-01-01").cast("timestamp").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    gen = frame(GEN, [("A", at("2025-01-01 10:00"), 60, float(v), k, "generation") for k, v in energies.items()])
    return gold.carbon_hourly(gold.generation_hourly(gen, area, factor, NOW), kinds, NOW)


def test_carbon_hour(spark, frame, area):
    row = carbon(spark, frame, area, {"B16": 10, "B04": 20, "B20": 10, "XXX": 99}).first()
    assert [row[c] for c in ("total_generation_mwh", "renewable_share_pct", "low_carbon_share_pct", "factor_coverage_pct", "co2e_kg", "carbon_intensity_g_per_kwh")] == [
        D("40.000"), D("25.00"), D("25.00"), D("75.00"), D("10280.000"), D("342.67")]


def test_nothing_covered_gives_no_intensity(spark, frame, area):
    row = carbon(spark, frame, area, {"B20": 5}).first()
    assert row["carbon_intensity_g_per_kwh"] is None and row["co2e_kg"] is None and row["factor_coverage_pct"] == D("0.00")


def test_zero_generation_is_no_division_error(spark, frame, area):
    row = carbon(spark, frame, area, {"B16": 0}).first()
    assert row["renewable_share_pct"] is None and row["carbon_intensity_g_per_kwh"] is None


def test_weather_fact_flags(frame):
    schema = "country_code string, ts_utc timestamp, temperature_2m double, wind_speed_100m double, shortwave_radiation double, cloud_cover double, precipitation double, archive_share double"
    df = frame(schema, [("A", at("2025-01-01"), 1.005, None, 0.0, 0.0, 0.0, 0.3333), ("B", at("2025-01-01"), 1.0, 1.0, 0.0, 0.0, 0.0, 1.0), ("C", at("2025-01-01"), 1.0, 1.0, 0.0, 0.0, 0.0, None)])
    assert found(gold.weather_hourly(df, NOW), "country_code", "temperature_c", "archive_share", "is_observed") == [
        ("A", D("1.01"), D("0.333"), False), ("B", D("1.00"), D("1.000"), True), ("C", D("1.00"), None, False)]


@pytest.mark.parametrize("gold_mwh,silver_mwh,status", [("100.000", 101.0, "OK"), ("100.000", 101.001, "FAILED"), (None, None, "OK")])
def test_reconciliation_tolerance(frame, gold_mwh, silver_mwh, status):
    fact = frame("ts_hour_utc timestamp, load_mwh decimal(14,3)", [(at("2025-01-01"), None if gold_mwh is None else D(gold_mwh))])
    raw = frame("ts_utc timestamp, energy_mwh double", [(at("2025-01-01"), silver_mwh)])
    row = gold.reconcile_load(fact, raw, "2025-01-01").first()
    assert row["status"] == status and row["difference"] == (D("0.000") if gold_mwh is None else D(str(silver_mwh)) - D(gold_mwh))


def test_calendar(spark):
    days = gold.dim_date(gold.date_bounds(spark, "2024-02-28", "2024-12-01"))
    assert days.count() == 278
    row = days.where("date_key = 20240302").first()
    assert (row["season"], row["day_of_week"], row["is_weekend"], row["month_name"], row["day_name"]) == ("Spring", 6, True, "March", "Saturday")
    assert days.where("date_key = 20241201").first()["season"] == "Winter"
    assert found(gold.dim_hour(spark).where("hour_key IN (0, 6, 17, 23)")) == [
        (0, "00:00", "Night"), (17, "17:00", "Afternoon"), (23, "23:00", "Evening"), (6, "06:00", "Morning")]


def test_shapes(spark, frame):
    schema = "area_key string, psr_type_code string, direction string, resolution_minutes int, value double"
    df = frame(schema, [("NL>DE", "B16", "generation", 30, 10.0), ("NL>DE", "B16", "consumption", 30, 10.0), ("NL>DE", "B20", "generation", 30, 10.0)])
    made = silver.shape("actual_generation", df, reference.production_type(spark))
    assert found(made, "psr_type_code", "direction", "energy_mwh", "co2e_kg") == [
        ("B16", "consumption", 5.0, None), ("B16", "generation", 5.0, 240.0), ("B20", "generation", 5.0, None)]
    assert silver.shape("crossborder_flow", df).select("from_area_code", "to_area_code").first() == ("NL", "DE")
    assert silver.shape("day_ahead_price", df).first()["price_eur_mwh"] == 10.0
    with pytest.raises(ValueError):
        silver.shape("nothing", df)


def test_touched_days(frame):
    schema = "c string, ts timestamp, v int"
    table = frame(schema, [("x", at("2025-01-01 03:00"), 1), ("x", at("2025-01-02 03:00"), 2), ("y", at("2025-01-01 03:00"), 3)])
    batch = frame(schema, [("x", at("2025-01-01 23:00"), 9)])
    assert clock(series.restrict_to_touched(table, batch, ["c"], "ts")) == [("x", "2025-01-01 03:00", 1)]
