"""Gold layer: hourly facts, dimensions, reconciliation. Silver in, star schema out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.functions.scalars import average_mw, date_key, hour_key, ratio, since, to_decimal
from voltframe.operators import quality, series
from voltframe.schemas import GOLD, align


WEATHER_DECIMALS = ["temperature_c", "wind_speed_100m_kmh", "solar_radiation_wm2", "cloud_cover_pct",
                    "precipitation_mm", "archive_share"]


def _dated(df: DataFrame, loaded_at: str) -> DataFrame:
    return df.withColumns({"date_key": date_key("ts_hour_utc"), "hour_key": hour_key("ts_hour_utc"),
                           "loaded_at_utc": F.lit(loaded_at).cast("timestamp")})


def _window(df: DataFrame, ts: str, from_date: str | None) -> DataFrame:
    return df.where(since(df, ts, from_date)) if from_date else df


def _owner(area: DataFrame, role: str = "") -> DataFrame:
    return area.select(F.col("area_code").alias(f"{role}area_code"), F.col("country_code").alias(f"{role}country_code"))


def load_hourly(silver_load: DataFrame, area: DataFrame, loaded_at: str, from_date: str | None = None) -> DataFrame:
    """Load per area and hour over all resolutions; areas unknown to `area` drop out."""
    hours = series.rollup_hour(_window(silver_load, "ts_utc", from_date), ["area_code"], "ts_utc", "energy_mwh",
                               energy_name="load_mwh")
    fact = hours.join(_owner(area), "area_code").withColumn("avg_load_mw", average_mw("load_mwh", "coverage_minutes"))
    return align(_dated(fact, loaded_at), GOLD["fact_load_hourly"])


def generation_hourly(silver_generation: DataFrame, area: DataFrame, emission_factor: DataFrame, loaded_at: str,
                      from_date: str | None = None) -> DataFrame:
    """Generation per area, type and hour, with the emission factor valid at the hour's start."""
    made = _window(silver_generation, "ts_utc", from_date).where(F.col("direction") == "generation")
    hours = series.rollup_hour(made, ["area_code", "psr_type_code"], "ts_utc", "energy_mwh", energy_name="gen_mwh")
    factors = emission_factor.select("psr_type_code", "valid_from", "valid_to", "lifecycle_gco2e_per_kwh")
    priced = series.validity_join(hours.join(_owner(area), "area_code"), factors, "psr_type_code", "ts_hour_utc")
    fact = priced.withColumns({"generation_mwh": F.col("gen_mwh"),
                               "co2e_kg": F.col("gen_mwh") * F.col("lifecycle_gco2e_per_kwh")})
    return align(_dated(fact, loaded_at), GOLD["fact_generation_hourly"])


def carbon_hourly(generation: DataFrame, production_type: DataFrame, loaded_at: str, from_date: str | None = None) -> DataFrame:
    """Country hours: sums first, ratios of the sums after. Energy without a factor leaves both
    sides of the intensity; types unknown to `production_type` drop out."""
    mwh = F.col("generation_mwh")
    zero = F.lit(0).cast("decimal(14,3)")

    def share(test: Column) -> Column:
        return F.sum(F.when(test, mwh).otherwise(zero))

    flags = production_type.select("psr_type_code", "is_renewable", "is_low_carbon")
    sums = (_window(generation, "ts_hour_utc", from_date).join(flags, "psr_type_code")
            .groupBy("date_key", "hour_key", "ts_hour_utc", "country_code")
            .agg(F.sum(mwh).alias("total_generation_mwh"), share(F.col("is_renewable")).alias("renewable_mwh"),
                 share(F.col("is_low_carbon")).alias("low_carbon_mwh"),
                 share(F.col("co2e_kg").isNotNull()).alias("factor_covered_mwh"), F.sum("co2e_kg").alias("co2e_kg")))
    total = F.col("total_generation_mwh")

    def pct(part: str) -> Column:
        return ratio(F.col(part) * 100, total)

    fact = sums.withColumns({
        "renewable_share_pct": pct("renewable_mwh"), "low_carbon_share_pct": pct("low_carbon_mwh"),
        "factor_coverage_pct": pct("factor_covered_mwh"),
        "carbon_intensity_g_per_kwh": ratio("co2e_kg", "factor_covered_mwh"),
        "loaded_at_utc": F.lit(loaded_at).cast("timestamp")})
    return align(fact, GOLD["fact_carbon_hourly"])


def price_hourly(silver_price: DataFrame, area: DataFrame, loaded_at: str, from_date: str | None = None) -> DataFrame:
    """Price per zone and hour from one resolution: 60 minutes when published, else the finest."""
    per_resolution = series.hourly_price(_window(silver_price, "ts_utc", from_date), ["area_code"], "ts_utc", "price_eur_mwh")
    chosen = series.prefer_resolution(per_resolution, ["area_code", "ts_hour_utc"])
    fact = chosen.join(_owner(area), "area_code").withColumnsRenamed({
        "avg_price": "price_eur_mwh", "min_price": "min_price_eur_mwh", "max_price": "max_price_eur_mwh",
        "resolution_minutes": "source_resolution_minutes", "slots": "source_slots"})
    return align(_dated(fact, loaded_at), GOLD["fact_price_hourly"])


def flow_hourly(silver_flow: DataFrame, area: DataFrame, loaded_at: str, from_date: str | None = None) -> DataFrame:
    """Directed border flow per hour from one resolution: best covered, then finest."""
    border = ["from_area_code", "to_area_code"]
    per_resolution = series.rollup_hour(_window(silver_flow, "ts_utc", from_date), [*border, "resolution_minutes"],
                                        "ts_utc", "energy_mwh", energy_name="flow_mwh")
    chosen = series.best_covered(per_resolution, [*border, "ts_hour_utc"])
    fact = (chosen.join(_owner(area, "from_"), "from_area_code").join(_owner(area, "to_"), "to_area_code")
            .withColumnRenamed("resolution_minutes", "source_resolution_minutes"))
    return align(_dated(fact, loaded_at), GOLD["fact_flow_hourly"])


def weather_hourly(silver_country: DataFrame, loaded_at: str, from_date: str | None = None) -> DataFrame:
    fact = _window(silver_country, "ts_utc", from_date).withColumnsRenamed({
        "ts_utc": "ts_hour_utc", "temperature_2m": "temperature_c", "wind_speed_100m": "wind_speed_100m_kmh",
        "shortwave_radiation": "solar_radiation_wm2", "cloud_cover": "cloud_cover_pct", "precipitation": "precipitation_mm",
    })
    kinds = {f.name: f.dataType for f in GOLD["fact_weather_hourly"] if f.name in WEATHER_DECIMALS}
    fact = fact.withColumn("is_observed", F.coalesce(F.col("archive_share") >= 0.999, F.lit(False)))
    fact = fact.withColumns({c: to_decimal(c, k.precision, k.scale) for c, k in kinds.items()})
    return align(_dated(fact, loaded_at), GOLD["fact_weather_hourly"])


def unmatched(df: DataFrame, area: DataFrame, column: str = "area_code") -> DataFrame:
    """Rows per code that an inner dimension lookup would drop."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("dropped_rows"))
              .join(area.select(F.col("area_code").alias(column)), column, "left_anti"))


# ---- dimensions ------------------------------------------------------------------------

SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Autumn": (9, 10, 11)}
DAY_PARTS = ["Night", "Morning", "Afternoon", "Evening"]


def dim_date(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Every day between the two dates of the one row in `bounds`."""
    d = F.col("date")
    weekday = F.weekday(d) + 1
    season = F.lit(None).cast("string")
    for name, months in SEASONS.items():
        season = F.when(F.month(d).isin(*months), name).otherwise(season)
    days = bounds.select(F.explode(F.sequence(F.col(first), F.col(last), F.expr("INTERVAL 1 DAY"))).alias("date"))
    return align(days.withColumns({
        "date_key": date_key(d), "year": F.year(d), "quarter": F.quarter(d), "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"), "day_of_month": F.dayofmonth(d), "day_of_week": weekday,
        "day_name": F.date_format(d, "EEEE"), "is_weekend": weekday >= 6, "season": season}), GOLD["dim_date"])


def date_bounds(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.sql(f"SELECT DATE'{first}' AS first_day, DATE'{last}' AS last_day")


def fact_bounds(*facts: DataFrame) -> DataFrame:
    """First and last day of all facts, as one row without days if there are none."""
    keys = reduce(DataFrame.unionByName, [f.agg(F.min("date_key").alias("a"), F.max("date_key").alias("b")) for f in facts])
    day = [F.to_date(f(c).cast("string"), "yyyyMMdd").alias(n) for f, c, n in ((F.min, "a", "first_day"), (F.max, "b", "last_day"))]
    return keys.agg(*day)


def dim_hour(spark: SparkSession) -> DataFrame:
    h = F.col("id").cast("int")
    part = F.element_at(F.array(*[F.lit(p) for p in DAY_PARTS]), (F.floor(h / 6) + 1).cast("int"))
    hours = spark.sql("SELECT explode(sequence(0, 23)) AS id")
    return align(hours.select(h.alias("hour_key"), F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":00")).alias("hour_label"),
                              part.alias("day_part")), GOLD["dim_hour"])


def dim_country(country: DataFrame) -> DataFrame:
    return align(country, GOLD["dim_country"])


def dim_area(area: DataFrame, country: DataFrame) -> DataFrame:
    return align(area.join(country.select("country_code", "country_name"), "country_code"), GOLD["dim_area"])


def dim_production_type(production_type: DataFrame) -> DataFrame:
    return align(production_type.withColumnRenamed("grid_name", "production_type_name").withColumn(
        "has_emission_factor", F.col("lifecycle_gco2e_per_kwh").isNotNull()), GOLD["dim_production_type"])


def dim_holiday(silver_holiday: DataFrame) -> DataFrame:
    return align(silver_holiday.withColumnRenamed("name", "holiday_name").withColumn("date_key", date_key("holiday_date")),
                 GOLD["dim_holiday"])


def dim_kpi_threshold(silver_kpi_threshold: DataFrame) -> DataFrame:
    return align(silver_kpi_threshold, GOLD["dim_kpi_threshold"])


# NULL stand-ins of the history comparison (fixed values)
FACTOR_TRACKED = {"lifecycle_gco2e_per_kwh": -1, "emission_factor_source": ""}


def run_log(check: DataFrame, started: str, finished: str, from_date: str) -> DataFrame:
    """Run-log row of a reconciliation."""
    ok = F.col("status") == "OK"
    return check.select(
        F.lit(started).cast("timestamp").alias("run_started_utc"), F.lit(finished).cast("timestamp").alias("run_finished_utc"),
        F.lit(from_date).cast("date").alias("checked_from_date"), "status", F.col("difference").alias("load_diff_mwh"),
        F.when(ok, "Gold reconciled with Silver").otherwise("Load MWh differs between Gold and Silver").alias("message"))


def reconcile_load(fact_load: DataFrame, silver_load: DataFrame, from_date: str) -> DataFrame:
    """Gold against silver load energy since `from_date`, within 1 MWh."""
    gold = fact_load.where(since(fact_load, "ts_hour_utc", from_date))
    silver = silver_load.where(since(silver_load, "ts_utc", from_date)).select(
        F.round("energy_mwh", 6).cast("decimal(18,6)").alias("energy_mwh"))
    return quality.reconcile(gold, "load_mwh", silver, "energy_mwh", 1)
