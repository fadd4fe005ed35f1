"""The analytical questions and report visuals, each a short composition of measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.functions.scalars import fill_template, ratio
from voltframe.operators.dedupe import top_with_ties
from voltframe.plans.measures import Star, evaluate, with_dimensions

Filter = tuple[str, Column]


def is_country(code: str) -> Filter:
    return "country_code", F.col("country_code") == code


def in_year(year: int) -> Filter:
    return "year", F.col("year") == year


def on_date(day: str) -> Filter:
    return "date", F.col("date") == F.lit(day).cast("date")


def in_season(name: str) -> Filter:
    return "season", F.col("season") == name


def extreme(star: Star, measure: str, by: Sequence[str], where: Sequence[Filter] = (), highest: bool = False) -> DataFrame:
    """Groups with the lowest or highest value of a measure, ties kept and blanks left out."""
    groups = evaluate(star, [measure], by, where).where(F.col(measure).isNotNull())
    order = F.col(measure).desc() if highest else F.col(measure).asc()
    return top_with_ties(groups, [order])


def greenest_hours(star: Star, country: str) -> DataFrame:
    return extreme(star, "carbon_intensity", ["hour_key"], [is_country(country)])


def intensity_on(star: Star, country: str, day: str) -> DataFrame:
    return evaluate(star, ["carbon_intensity"], (), [is_country(country), on_date(day)])


def overall(star: Star) -> DataFrame:
    return evaluate(star, ["carbon_intensity", "factor_coverage"])


def cleanest_country(star: Star) -> DataFrame:
    return extreme(star, "carbon_intensity", ["country_name"])


def most_renewable_country(star: Star) -> DataFrame:
    return extreme(star, "renewable_share", ["country_name"], highest=True)


def target_gap(star: Star, country: str) -> DataFrame:
    return evaluate(star, ["renewable_share", "renewable_gap_pp"], (), [is_country(country)])


def target_gap_text(star: Star, country: str) -> DataFrame:
    """The gap as the answer words it: points below the target."""
    found = evaluate(star, ["renewable_share", "renewable_target", "renewable_gap_pp"], (), [is_country(country)])
    return answer(found.withColumn("gap", -F.col("renewable_gap_pp")), "target_gap")


def best_hour(star: Star, country: str) -> DataFrame:
    return evaluate(star, ["greenest_hour"], (), [is_country(country)])


def dirtiest_month(star: Star, country: str, year: int) -> DataFrame:
    return extreme(star, "carbon_intensity", ["month", "month_name"], [is_country(country), in_year(year)], highest=True)


def renewable_in(star: Star, country: str, year: int) -> DataFrame:
    return evaluate(star, ["renewable_share"], (), [is_country(country), in_year(year)])


def intensity_change(star: Star, country: str, before: Filter, after: Filter) -> DataFrame:
    """Intensity in two periods, the direction and the relative change, from one scan."""
    facts = with_dimensions(star, star.facts["carbon"], list(dict.fromkeys([before[0], after[0]])))
    one = facts.where(F.col("country_code") == country)

    def intensity(period: Column) -> Column:
        total = [F.sum(F.when(period, F.col(c))).cast("double") for c in ("co2e_kg", "factor_covered_mwh")]
        return ratio(*total)

    pair = one.agg(intensity(before[1]).alias("before"), intensity(after[1]).alias("after"))
    falling = F.coalesce(F.col("after"), F.lit(0.0)) < F.coalesce(F.col("before"), F.lit(0.0))
    return pair.select(F.when(falling, "Decreased").otherwise("Increased").alias("direction"), "before", "after",
                       ratio(F.col("after") - F.col("before"), "before").alias("change"))


def average_price(star: Star, country: str, year: int) -> DataFrame:
    return evaluate(star, ["avg_price"], (), [is_country(country), in_year(year)])


def negative_hours(star: Star, country: str, year: int) -> DataFrame:
    return evaluate(star, ["negative_price_hours"], (), [is_country(country), in_year(year)])


def trade_balance(star: Star, country: str) -> DataFrame:
    net = evaluate(star, ["net_imports_mwh"], (), [is_country(country)])
    v = F.coalesce("net_imports_mwh", F.lit(0.0))
    return net.select(F.when(v > 0, "Net importer").otherwise("Net exporter").alias("label"),
                      (F.abs(v) / 1000000).alias("twh"))


def category_share(star: Star, country: str, category: str) -> DataFrame:
    """Share of one fuel category in a country's generation. Types outside the dimension count
    in the total only."""
    made = star.facts["generation"].where(F.col("country_code") == country)
    kinds = star.dims["production_type"].select("psr_type_code", "fuel_category")
    mwh = F.col("generation_mwh")
    sums = made.groupBy("psr_type_code").agg(F.sum(mwh).alias("mwh")).join(kinds, "psr_type_code", "left")
    return sums.agg(ratio(F.sum(F.when(F.col("fuel_category") == category, F.col("mwh"))).cast("double"),
                          F.sum("mwh").cast("double")).alias("share"))


def cheapest_hours(star: Star, country: str) -> DataFrame:
    return extreme(star, "avg_price", ["hour_key"], [is_country(country)])


def seasonal_wind(star: Star, country: str, season: str) -> DataFrame:
    return evaluate(star, ["avg_wind_100m"], (), [is_country(country), in_season(season)])


# ---- report visuals --------------------------------------------------------------------


def cards(star: Star, where: Sequence[Filter] = ()) -> DataFrame:
    return evaluate(star, ["carbon_intensity", "renewable_share", "low_carbon_share", "factor_coverage",
                           "avg_price", "total_co2e_tonnes", "greenest_hour"], (), where)


def mix_share(star: Star, where: Sequence[Filter] = ()) -> DataFrame:
    """Generation by country and fuel category with its share of the country."""
    mix = evaluate(star, ["generation_mwh"], ["country_name", "fuel_category"], where)
    total = F.sum("generation_mwh").over(Window.partitionBy("country_name"))
    return mix.withColumn("share", ratio("generation_mwh", total))


def against_target(star: Star, where: Sequence[Filter] = ()) -> DataFrame:
    return evaluate(star, ["renewable_share", "renewable_target", "renewable_gap"], ["country_name"], where)


def intensity_drill(star: Star, where: Sequence[Filter] = ()) -> DataFrame:
    """Intensity per country by year, month and day; each level is a ratio of its own sums.

    Days are summed first and the upper levels roll up from them, so the fact is read and
    shuffled once.
    """
    columns = list(dict.fromkeys(["country_name", "year", "month", "date", *[c for c, _ in where]]))
    fact = with_dimensions(star, star.facts["carbon"], columns)
    for _, test in where:
        fact = fact.where(test)
    days = fact.groupBy("country_name", "year", "month", "date").agg(
        F.sum("co2e_kg").alias("co2e"), F.sum("factor_covered_mwh").alias("covered"))
    # one row per level: upper levels blank out the finer columns
    none_int, none_date = F.lit(None).cast("int"), F.lit(None).cast("date")
    levels = F.array(
        F.struct(F.lit("year").alias("level"), none_int.alias("m"), none_date.alias("d")),
        F.struct(F.lit("month").alias("level"), F.col("month").alias("m"), none_date.alias("d")),
        F.struct(F.lit("day").alias("level"), F.col("month").alias("m"), F.col("date").alias("d")))
    return (days.select("country_name", "year", "co2e", "covered", F.inline(levels))
            .groupBy("level", "country_name", "year", F.col("m").alias("month"), F.col("d").alias("date"))
            .agg(ratio(F.sum("co2e").cast("double"), F.sum("covered").cast("double")).alias("carbon_intensity")))


def intensity_by_hour(star: Star, where: Sequence[Filter] = ()) -> DataFrame:
    return evaluate(star, ["carbon_intensity"], ["hour_key"], where)


def slicer(star: Star, dim: str, column: str, fact: str) -> DataFrame:
    """Members of a dimension that have rows in a fact."""
    key = {"country": "country_code", "date": "date_key"}[dim]
    used = star.facts[fact].select(key).distinct()
    return star.dims[dim].join(used, key, "left_semi").select(column).distinct()


# ---- answer texts ----------------------------------------------------------------------

# How each answer is worded.
ANSWERS = {
    "greenest_hour": "Typically {hour_key:02.0f}:00 UTC, about {carbon_intensity:.0f} gCO2e/kWh",
    "intensity_on_date": "{carbon_intensity:.1f} gCO2e/kWh (daily value)",
    "overall": "{carbon_intensity:.1f} gCO2e/kWh, coverage {factor_coverage:.1%}",
    "cleanest_country": "{country_name} ({carbon_intensity:.1f} gCO2e/kWh)",
    "target_gap": "Renewable share {renewable_share:.1%} vs {renewable_target:.0%} 2030 target, about {gap:.0f} percentage points below",
    "best_hour": "Around {greenest_hour:02.0f}:00 UTC",
    "dirtiest_month": "{month_name} ({carbon_intensity:.1f} gCO2e/kWh)",
    "renewable_share": "{renewable_share:.1%}",
    "intensity_change": "{direction} from {before:.1f} to {after:.1f} gCO2e/kWh ({change:+.1%})",
    "average_price": "EUR {avg_price:.1f}/MWh",
    "negative_hours": "{negative_price_hours:.0f} hours",
    "trade_balance": "{label} ({twh:.1f} TWh net over the period)",
    "category_share": "{share:.1%}",
    "most_renewable_country": "{country_name} ({renewable_share:.1%})",
    "cheapest_hour": "Around {hour_key:02.0f}:00 UTC (average across bidding zones, EUR {avg_price:.1f}/MWh)",
    "seasonal_wind": "{avg_wind_100m:.1f} km/h at 100 m",
}


def answer(result: DataFrame, question: str) -> DataFrame:
    return result.select(fill_template(ANSWERS[question]).alias("answer"))
