"""Table schemas of the control, silver and gold layers, and projection onto them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINEAGE = ("_source_file", "_bronze_ingested_at", "_silver_updated_at")

_TYPES = {
    "string": T.StringType(), "timestamp": T.TimestampType(), "date": T.DateType(), "int": T.IntegerType(),
    "smallint": T.ShortType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
}


def describe(text: str) -> T.StructType:
    """One column per line: name, type, `!` when required, then an optional comment."""
    fields = []
    for line in text.strip().splitlines():
        definition, _, comment = line.partition("#")
        if not definition.strip():
            continue
        name, kind, *flags = definition.split()
        if kind.startswith("decimal"):
            precision, scale = kind[8:-1].split(",")
            data_type = T.DecimalType(int(precision), int(scale))
        else:
            data_type = _TYPES[kind]
        meta = {"comment": comment.strip()} if comment else {}
        fields.append(T.StructField(name, data_type, "!" not in flags, meta))
    return T.StructType(fields)


_LINEAGE_COLUMNS = """
_source_file string
_bronze_ingested_at timestamp
_silver_updated_at timestamp
"""

# Column names, types and keys of all tables.
CONTROL = {
    "ctl_ingest_log": describe("""
        run_id string           # one id per run
        source string
        dataset string
        area_key string         # area code, FROM>TO pair, or location
        request_start_utc timestamp
        request_end_utc timestamp
        status string           # ok, no_data or error
        file_path string
        bytes bigint
        points int
        error_message string
        ingested_at_utc timestamp
    """),
    "ctl_watermark": describe("""
        source string
        dataset string
        area_key string
        loaded_until_utc timestamp   # end of the loaded span, exclusive
        updated_at_utc timestamp
    """),
    "ctl_silver_state": describe("""
        dataset string
        processed_until_ingested_at timestamp
        updated_at_utc timestamp
    """),
    "ctl_touched_hours": describe("""
        table_name string !     # the silver table that changed
        scope string !          # area, country or type of direction
        to_scope string         # receiving area of a flow
        ts_hour_utc timestamp !
        noted_at timestamp
    """),
    "dq_quarantine": describe("""
        table_name string
        record_key string
        rule_name string
        details string
        source_file string
        detected_at timestamp
    """),
    "dq_check_result": describe("""
        run_id string
        checked_at timestamp
        check_name string
        table_name string
        scope string
        metric double
        threshold string
        status string
        details string
    """),
    "gold_run_log": describe("""
        run_started_utc timestamp !
        run_finished_utc timestamp !
        checked_from_date date !
        status string !
        load_diff_mwh decimal(18,3)
        message string
    """),
}

SILVER = {
    "silver_load": describe("""
        area_code string !
        ts_utc timestamp !      # start of the interval
        resolution_minutes int !
        load_mw double
        energy_mwh double       # energy of the interval
    """ + _LINEAGE_COLUMNS),
    "silver_generation": describe("""
        area_code string !
        ts_utc timestamp !
        resolution_minutes int !
        psr_type_code string !
        direction string !      # which way a unit runs
        power_mw double
        energy_mwh double
        co2e_kg double          # NULL when there is no factor
    """ + _LINEAGE_COLUMNS),
    "silver_price": describe("""
        area_code string !
        ts_utc timestamp !
        resolution_minutes int !
        price_eur_mwh double
    """ + _LINEAGE_COLUMNS),
    "silver_flow": describe("""
        from_area_code string !
        to_area_code string !
        ts_utc timestamp !
        resolution_minutes int !
        flow_mw double
        energy_mwh double
    """ + _LINEAGE_COLUMNS),
    "silver_weather_hourly": describe("""
        location_code string !
        country_code string !
        ts_utc timestamp !
        temperature_2m double
        wind_speed_10m double
        wind_speed_100m double
        shortwave_radiation double
        cloud_cover double
        precipitation double
        data_source string !    # archive or forecast
    """ + _LINEAGE_COLUMNS),
    "silver_weather_country_hourly": describe("""
        country_code string !
        ts_utc timestamp !
        temperature_2m double
        wind_speed_100m double
        shortwave_radiation double
        cloud_cover double
        precipitation double
        archive_share double    # share of the weight that is observed
        _silver_updated_at timestamp
    """),
    "silver_holiday": describe("""
        country_code string !
        holiday_date date !
        local_name string
        name string
        is_nationwide boolean
        _source_file string
        _silver_updated_at timestamp
    """),
    "silver_kpi_threshold": describe("""
        country_code string
        carbon_intensity_alert_gco2e_per_kwh double
        price_spike_alert_eur_per_mwh double
        renewable_share_target_pct double
        valid_from date
        owner string
        note string
    """),
}

KEYS = {
    "silver_load": ["area_code", "ts_utc", "resolution_minutes"],
    "silver_generation": ["area_code", "ts_utc", "resolution_minutes", "psr_type_code", "direction"],
    "silver_price": ["area_code", "ts_utc", "resolution_minutes"],
    "silver_flow": ["from_area_code", "to_area_code", "ts_utc", "resolution_minutes"],
    "silver_weather_hourly": ["location_code", "ts_utc"],
    "silver_weather_country_hourly": ["country_code", "ts_utc"],
    "silver_holiday": ["country_code", "holiday_date", "name"],
    "ctl_watermark": ["source", "dataset", "area_key"],
    "ctl_silver_state": ["dataset"],
}

_HOUR_KEYS = """
date_key int !
hour_key smallint !
ts_hour_utc timestamp !
"""

GOLD = {
    "fact_load_hourly": describe(_HOUR_KEYS + """
        area_code string !
        country_code string !
        load_mwh decimal(14,3) !
        avg_load_mw decimal(14,3) !
        coverage_minutes int !
        loaded_at_utc timestamp !
    """),
    "fact_generation_hourly": describe(_HOUR_KEYS + """
        area_code string !
        country_code string !
        psr_type_code string !
        generation_mwh decimal(14,3) !
        co2e_kg decimal(18,3)
        coverage_minutes int !
        loaded_at_utc timestamp !
    """),
    "fact_carbon_hourly": describe(_HOUR_KEYS + """
        country_code string !
        total_generation_mwh decimal(14,3) !
        renewable_mwh decimal(14,3) !
        low_carbon_mwh decimal(14,3) !
        factor_covered_mwh decimal(14,3) !
        co2e_kg decimal(18,3)
        renewable_share_pct decimal(6,2)
        low_carbon_share_pct decimal(6,2)
        carbon_intensity_g_per_kwh decimal(8,2)
        factor_coverage_pct decimal(6,2)
        loaded_at_utc timestamp !
    """),
    "fact_price_hourly": describe(_HOUR_KEYS + """
        area_code string !
        country_code string !
        price_eur_mwh decimal(10,2) !
        min_price_eur_mwh decimal(10,2) !
        max_price_eur_mwh decimal(10,2) !
        source_resolution_minutes smallint !
        source_slots smallint !
        loaded_at_utc timestamp !
    """),
    "fact_flow_hourly": describe(_HOUR_KEYS + """
        from_area_code string !
        to_area_code string !
        from_country_code string !
        to_country_code string !
        flow_mwh decimal(14,3) !
        source_resolution_minutes smallint !
        coverage_minutes int !
        loaded_at_utc timestamp !
    """),
    "fact_weather_hourly": describe(_HOUR_KEYS + """
        country_code string !
        temperature_c decimal(6,2)
        wind_speed_100m_kmh decimal(6,2)
        solar_radiation_wm2 decimal(8,2)
        cloud_cover_pct decimal(6,2)
        precipitation_mm decimal(6,2)
        archive_share decimal(4,3)
        is_observed boolean !
        loaded_at_utc timestamp !
    """),
    "dim_date": describe("""
        date_key int
        date date
        year int
        quarter int
        month int
        month_name string
        day_of_month int
        day_of_week int         # Monday = 1
        day_name string
        is_weekend boolean
        season string           # meteorological: December to February is Winter
    """),
    "dim_hour": describe("""
        hour_key int
        hour_label string
        day_part string !       # Night 0-5, Morning 6-11, Afternoon 12-17, Evening 18-23
    """),
    "dim_country": describe("""
        country_code string
        country_name string
        time_zone string
        is_active boolean
    """),
    "dim_area": describe("""
        area_code string
        eic_code string
        area_name string
        country_code string
        country_name string
        is_country_area boolean
        is_bidding_zone boolean
    """),
    "dim_production_type": describe("""
        psr_type_code string
        production_type_name string
        fuel_category string
        is_renewable boolean
        is_low_carbon boolean
        lifecycle_gco2e_per_kwh decimal(6,1)
        has_emission_factor boolean
        emission_factor_source string
    """),
    "dim_emission_factor": describe("""
        psr_type_code string !
        lifecycle_gco2e_per_kwh decimal(6,1)
        emission_factor_source string
        valid_from timestamp !
        valid_to timestamp
        is_current boolean !
    """),
    "dim_holiday": describe("""
        country_code string
        date_key int
        holiday_date date !
        holiday_name string
        local_name string
        is_nationwide boolean
    """),
    "dim_kpi_threshold": describe("""
        country_code string !
        carbon_intensity_alert_gco2e_per_kwh decimal(8,2)
        price_spike_alert_eur_per_mwh decimal(10,2)
        renewable_share_target_pct decimal(6,2)
        valid_from date !
        owner string
        note string
    """),
}

REFERENCE = {
    "country": describe("""
        country_code string !
        country_name string !
        time_zone string !
        is_active boolean !     # switch, owned by the business
    """),
    "area": describe("""
        area_code string !
        eic_code string !
        area_name string !
        country_code string !   # owning country, DE_LU belongs to DE
        is_country_area boolean !   # load, generation, flows
        is_bidding_zone boolean !   # prices
    """),
    "dataset_area": describe("""
        dataset string !
        area_code string !
        is_enabled boolean !
    """),
    "interconnector": describe("""
        from_area_code string !
        to_area_code string !
        is_enabled boolean !
    """),
    "production_type": describe("""
        psr_type_code string !
        grid_name string !
        fuel_category string !
        is_renewable boolean !
        is_low_carbon boolean !     # renewable or nuclear
        lifecycle_gco2e_per_kwh decimal(6,1)    # NULL: no factor, not zero
        emission_factor_source string !
    """),
    "weather_location": describe("""
        location_code string !
        country_code string !
        location_name string !
        latitude decimal(8,5) !
        longitude decimal(8,5) !
        weight decimal(5,4) !   # weights of a country sum to 1
    """),
    "user_country": describe("""
        user_name string !
        country_code string !   # * means every country
    """),
}

TABLES = {**CONTROL, **SILVER, **GOLD, **REFERENCE}


def align(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """Select and cast by name; extra columns are dropped, missing ones are an error."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"{name}: source is missing columns {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema])


def required(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if not f.nullable]
