from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from helpers import found
from voltframe.plans import gold, questions
from voltframe.plans.measures import MEASURES, Star, evaluate
from voltframe.sources.inline import rows

CARBON = ("date_key int, hour_key smallint, ts_hour_utc timestamp, country_code string, total_generation_mwh decimal(14,3), renewable_mwh decimal(14,3), "
          "low_carbon_mwh decimal(14,3), factor_covered_mwh decimal(14,3), co2e_kg decimal(18,3)")
FLOW = "date_key int, hour_key smallint, from_country_code string, to_country_code string, flow_mwh decimal(14,3)"
PRICE = "date_key int, hour_key smallint, area_code string, country_code string, price_eur_mwh decimal(10,2)"
THRESHOLD = "country_code string, renewable_share_target_pct decimal(6,2), carbon_intensity_alert_gco2e_per_kwh decimal(8,2)"


def hour(day, h, country, total, renewable, covered, co2e):
    return (day, h, None, country, D(total), D(renewable), D(renewable), D(covered), None if co2e is None else D(co2e))


@pytest.fixture
def star(spark):
    carbon = [hour(20250101, 0, "NL", 10, 1, 10, 1000), hour(20250101, 1, "NL", 90, 9, 90, 7200), hour(20250201, 2, "NL", 10, 5, 10, 800),
              hour(20250201, 3, "NL", 10, 0, 0, None), hour(20250101, 0, "DE", 100, 80, 100, 40000)]
    flow = [(20250101, 0, "NL", "DE", D(5)), (20250101, 0, "DE", "NL", D(8)), (20250101, 0, "DE", "BE", D(2))]
    price = [(20250101, h, "NL", "NL", D(p)) for h, p in enumerate([10, 20, 30])] + [(20250101, 0, z, "DE", D(-1)) for z in ("DE1", "DE2")]
    return Star({"carbon": rows(spark, CARBON, carbon), "flow": rows(spark, FLOW, flow), "price": rows(spark, PRICE, price),
                 "threshold": rows(spark, THRESHOLD, [("NL", D(70), D(350)), ("NL", D(60), D(300)), ("DE", D(80), None)])},
                {"country": rows(spark, "country_code string, country_name string", [("NL", "Netherlands"), ("DE", "Germany"), ("BE", "Belgium"), ("FR", "France")]),
                 "date": gold.dim_date(gold.date_bounds(spark, "2025-01-01", "2025-12-31")), "hour": gold.dim_hour(spark)})


def only(df):
    values = df.first()
    return values[0] if len(values) == 1 else tuple(values)


def test_combined_intensity_is_a_ratio_of_sums(spark):
    s = Star({"carbon": rows(spark, CARBON, [hour(1, 0, "A", 10, 0, 10, 1000), hour(1, 1, "A", 90, 0, 90, 45000)])})
    assert only(evaluate(s, ["carbon_intensity"])) == 460.0


def test_net_imports(star):
    by = evaluate(star, ["exports_mwh", "imports_mwh", "net_imports_mwh"], ["country_code"])
    assert found(by) == [("BE", None, 2.0, 2.0), ("DE", 10.0, 5.0, -5.0), ("NL", 5.0, 8.0, 3.0)]
    assert by.agg(F.sum("net_imports_mwh")).first()[0] == 0
    assert only(evaluate(star, ["exports_mwh", "imports_mwh", "net_imports_mwh"])) == (15.0, 15.0, 0.0)
    assert only(evaluate(star, ["net_imports_mwh"], (), [questions.is_country("FR")])) is None


def test_greenest_hour_and_topn_ties(star):
    nl = [questions.is_country("NL")]
    assert only(evaluate(star, ["greenest_hour"], (), nl)) == 1
    assert found(questions.greenest_hours(star, "NL")) == [(1, 80.0), (2, 80.0)]
    assert found(evaluate(star, ["greenest_hour", "carbon_intensity"], ["country_name"])) == [("Germany", 0, 400.0), ("Netherlands", 1, 9000 / 110)]


def test_negative_hours_count_zones_and_blank_when_none(star):
    assert found(evaluate(star, ["negative_price_hours", "avg_price"], ["country_code"])) == [("DE", 2, -1.0), ("NL", None, 20.0)]


def test_targets_ignore_filters_they_cannot_see(star):
    got = only(evaluate(star, ["renewable_share", "renewable_target", "renewable_gap", "renewable_gap_pp", "carbon_alert_level"], (),
                        [questions.is_country("NL"), questions.in_year(2025)]))
    assert got == pytest.approx((15 / 120, 0.7, 15 / 120 - 0.7, 100 * (15 / 120 - 0.7), 350.0))


def test_gap_without_generation_is_minus_the_target(star):
    empty = Star({**star.facts, "carbon": star.facts["carbon"].where("false")}, star.dims)
    assert only(evaluate(empty, ["renewable_gap"], (), [questions.is_country("NL")])) == -0.7


def test_coverage_floor_and_reliability(star):
    ci, cov, low, ok = only(evaluate(star, ["carbon_intensity", "factor_coverage", "carbon_intensity_floor", "intensity_is_reliable"], (), [questions.is_country("NL")]))
    assert low == pytest.approx(ci * cov) and ok is True and cov == pytest.approx(110 / 120)


def test_dates_seasons_and_months(star):
    assert found(evaluate(star, ["carbon_intensity"], ["month", "month_name"], [questions.is_country("NL")])) == [(1, "January", 82.0), (2, "February", 80.0)]
    assert only(questions.dirtiest_month(star, "NL", 2025)) == (1, "January", 82.0)
    assert only(questions.intensity_on(star, "NL", "2025-02-01")) == 80.0
    assert only(evaluate(star, ["total_generation_mwh"], (), [questions.in_season("Summer")])) is None


def test_change_and_answers(star):
    january, february = ("month", F.col("month") == 1), ("month", F.col("month") == 2)
    change = questions.intensity_change(star, "NL", january, february)
    assert only(change)[0] == "Decreased"
    assert only(questions.answer(change, "intensity_change")) == "Decreased from 82.0 to 80.0 gCO2e/kWh (-2.4%)"
    assert only(questions.answer(questions.greenest_hours(star, "DE"), "greenest_hour")) == "Typically 00:00 UTC, about 400 gCO2e/kWh"
    assert only(questions.trade_balance(star, "NL")) == ("Net importer", 3 / 1e6)
    assert only(questions.answer(questions.trade_balance(star, "NL"), "trade_balance")) == "Net importer (0.0 TWh net over the period)"
    assert only(questions.answer(questions.overall(star), "overall")) == "233.3 gCO2e/kWh, coverage 95.5%"
    assert only(questions.answer(questions.most_renewable_country(star), "most_renewable_country")) == "Germany (80.0%)"


def test_unknown_members_stay_in_totals(star, spark):
    extra = rows(spark, CARBON, [hour(20250101, 0, "XX", 7, 0, 7, 1)])
    wider = Star({**star.facts, "carbon": star.facts["carbon"].unionByName(extra)}, star.dims)
    assert dict(found(evaluate(wider, ["total_generation_mwh"], ["country_name"]))) == {"Germany": 100.0, "Netherlands": 120.0, None: 7.0}


def test_unreachable_grouping_is_an_error(star):
    with pytest.raises(ValueError):
        evaluate(star, ["carbon_intensity"], ["fuel_category"])


def test_drill_levels_are_ratios_of_their_own_sums(star):
    drill = questions.intensity_drill(star, [questions.is_country("NL")])
    assert [(level, v) for level, *_, v in found(drill.where("level <> 'day'"))] == [("month", 82.0), ("month", 80.0), ("year", 9000 / 110)]


def test_all_measures_are_registered():
    assert len(MEASURES) + 1 == 22 + 2      # greenest hour is separate; two documented companions
