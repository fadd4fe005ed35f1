"""Reference data: countries, areas, borders, production types and weather points."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.operators import scope
from voltframe.sources.inline import rows

# ---- Fixed values ---------------------------------------------------------------------

COUNTRIES = [   # code, name, time zone, active
    ("IT", "Italy", "Europe/Rome", True),
    ("FR", "France", "Europe/Paris", True),
    ("DE", "Germany", "Europe/Berlin", True),
    ("ES", "Spain", "Europe/Madrid", False),
    ("PT", "Portugal", "Europe/Lisbon", False),
    ("CH", "Switzerland", "Europe/Zurich", False),
    ("AT", "Austria", "Europe/Vienna", False),
    ("BE", "Belgium", "Europe/Brussels", False),
    ("NL", "Netherlands", "Europe/Amsterdam", True),
    ("PL", "Poland", "Europe/Warsaw", False),
    ("CZ", "Czech Republic", "Europe/Prague", False),
    ("SI", "Slovenia", "Europe/Ljubljana", False),
]

AREAS = [   # code, EIC code, name, country, country area, bidding zone
    ("IT", "10YIT-GRTN-----B", "Italy (control area)", "IT", True, False),
    ("IT_NORD", "10Y1001A1001A73I", "IT-North bidding zone", "IT", False, True),
    ("IT_CNOR", "10Y1001A1001A70O", "IT-Centre-North bidding zone", "IT", False, True),
    ("IT_CSUD", "10Y1001A1001A71M", "IT-Centre-South bidding zone", "IT", False, True),
    ("IT_SUD", "10Y1001A1001A788", "IT-South bidding zone", "IT", False, True),
    ("IT_SICI", "10Y1001A1001A75E", "IT-Sicily bidding zone", "IT", False, True),
    ("IT_SARD", "10Y1001A1001A74G", "IT-Sardinia bidding zone", "IT", False, True),
    ("IT_CALA", "10Y1001C--00096J", "IT-Calabria bidding zone", "IT", False, True),
    ("DE", "10Y1001A1001A83F", "Germany", "DE", True, False),
    ("DE_LU", "10Y1001A1001A82H", "DE-LU bidding zone", "DE", False, True),
    ("FR", "10YFR-RTE------C", "France", "FR", True, True),
    ("ES", "10YES-REE------0", "Spain", "ES", True, True),
    ("PT", "10YPT-REN------W", "Portugal", "PT", True, True),
    ("CH", "10YCH-SWISSGRIDZ", "Switzerland", "CH", True, True),
    ("AT", "10YAT-APG------L", "Austria", "AT", True, True),
    ("BE", "10YBE----------2", "Belgium", "BE", True, True),
    ("NL", "10YNL----------L", "Netherlands", "NL", True, True),
    ("PL", "10YPL-AREA-----S", "Poland", "PL", True, True),
    ("CZ", "10YCZ-CEPS-----N", "Czech Republic", "CZ", True, True),
    ("SI", "10YSI-ELES-----O", "Slovenia", "SI", True, True),
]

BORDERS = [
    ("IT", "FR"), ("IT", "CH"), ("IT", "AT"), ("IT", "SI"), ("FR", "BE"), ("FR", "DE"), ("FR", "ES"),
    ("FR", "CH"), ("ES", "PT"), ("DE", "NL"), ("DE", "BE"), ("DE", "CH"), ("DE", "AT"), ("DE", "CZ"),
    ("DE", "PL"), ("AT", "CH"), ("AT", "CZ"), ("AT", "SI"), ("BE", "NL"), ("PL", "CZ"),
]

PRODUCTION_TYPES = [   # code, name, category, renewable, low-carbon, gCO2e/kWh (NULL = no factor), source
    ("B01", "Biomass", "Renewable", True, True, 230.0, "IPCC AR5 median: biomass (dedicated)"),
    ("B02", "Fossil Brown coal/Lignite", "Fossil", False, False, 820.0,
     "Proxy: IPCC AR5 coal (PC); lignite likely higher"),
    ("B03", "Fossil Coal-derived gas", "Fossil", False, False, 820.0, "Proxy: IPCC AR5 coal (PC)"),
    ("B04", "Fossil Gas", "Fossil", False, False, 490.0, "IPCC AR5 median: gas combined cycle"),
    ("B05", "Fossil Hard coal", "Fossil", False, False, 820.0, "IPCC AR5 median: coal (PC)"),
    ("B06", "Fossil Oil", "Fossil", False, False, None, "No IPCC AR5 value"),
    ("B07", "Fossil Oil shale", "Fossil", False, False, None, "No IPCC AR5 value"),
    ("B08", "Fossil Peat", "Fossil", False, False, None, "No IPCC AR5 value"),
    ("B09", "Geothermal", "Renewable", True, True, 38.0, "IPCC AR5 median: geothermal"),
    ("B10", "Hydro Pumped Storage", "Storage", False, False, None, "Excluded: storage shifts energy"),
    ("B11", "Hydro Run-of-river and poundage", "Renewable", True, True, 24.0, "IPCC AR5 median: hydropower"),
    ("B12", "Hydro Water Reservoir", "Renewable", True, True, 24.0, "IPCC AR5 median: hydropower"),
    ("B13", "Marine", "Renewable", True, True, 17.0, "IPCC AR5 median: ocean (tidal/wave)"),
    ("B14", "Nuclear", "Nuclear", False, True, 12.0, "IPCC AR5 median: nuclear"),
    ("B15", "Other renewable", "Renewable", True, True, None, "No single IPCC AR5 value"),
    ("B16", "Solar", "Renewable", True, True, 48.0, "IPCC AR5 median: solar PV (utility)"),
    ("B17", "Waste", "Other", False, False, None, "No IPCC AR5 value"),
    ("B18", "Wind Offshore", "Renewable", True, True, 12.0, "IPCC AR5 median: wind offshore"),
    ("B19", "Wind Onshore", "Renewable", True, True, 11.0, "IPCC AR5 median: wind onshore"),
    ("B20", "Other", "Other", False, False, None, "No IPCC AR5 value"),
    ("B25", "Energy storage", "Storage", False, False, None, "Excluded: storage shifts energy"),
]

WEATHER_LOCATIONS = [   # code, country, name, latitude, longitude, weight
    ("IT-MIL", "IT", "Milan", "45.46420", "9.19000", "0.3333"),
    ("IT-ROM", "IT", "Rome", "41.90280", "12.49640", "0.3333"),
    ("IT-PAL", "IT", "Palermo", "38.11570", "13.36150", "0.3334"),
    ("FR-PAR", "FR", "Paris", "48.85660", "2.35220", "0.3333"),
    ("FR-LYS", "FR", "Lyon", "45.76400", "4.83570", "0.3333"),
    ("FR-TLS", "FR", "Toulouse", "43.60470", "1.44420", "0.3334"),
    ("DE-BER", "DE", "Berlin", "52.52000", "13.40500", "0.3333"),
    ("DE-HAM", "DE", "Hamburg", "53.55110", "9.99370", "0.3333"),
    ("DE-MUC", "DE", "Munich", "48.13510", "11.58200", "0.3334"),
    ("ES-MAD", "ES", "Madrid", "40.41680", "-3.70380", "0.3333"),
    ("ES-SVQ", "ES", "Seville", "37.38910", "-5.98450", "0.3333"),
    ("ES-ZAZ", "ES", "Zaragoza", "41.64880", "-0.88910", "0.3334"),
    ("PT-LIS", "PT", "Lisbon", "38.72230", "-9.13930", "0.5000"),
    ("PT-OPO", "PT", "Porto", "41.15790", "-8.62910", "0.5000"),
    ("CH-ZRH", "CH", "Zurich", "47.37690", "8.54170", "1.0000"),
    ("AT-VIE", "AT", "Vienna", "48.20820", "16.37380", "1.0000"),
    ("BE-BRU", "BE", "Brussels", "50.85030", "4.35170", "1.0000"),
    ("NL-AMS", "NL", "Amsterdam", "52.36760", "4.90410", "0.5000"),
    ("NL-GRQ", "NL", "Groningen", "53.21940", "6.56650", "0.5000"),
    ("PL-WAW", "PL", "Warsaw", "52.22970", "21.01220", "0.5000"),
    ("PL-GDN", "PL", "Gdansk", "54.35200", "18.64660", "0.5000"),
    ("CZ-PRG", "CZ", "Prague", "50.07550", "14.43780", "1.0000"),
    ("SI-LJU", "SI", "Ljubljana", "46.05690", "14.50580", "1.0000"),
]

# ---------------------------------------------------------------------------------------


def country(spark: SparkSession) -> DataFrame:
    return rows(spark, "country_code string, country_name string, time_zone string, is_active boolean", COUNTRIES)


def area(spark: SparkSession) -> DataFrame:
    return rows(spark, "area_code string, eic_code string, area_name string, country_code string, "
                       "is_country_area boolean, is_bidding_zone boolean", AREAS)


def dataset_area(spark: SparkSession) -> DataFrame:
    return scope.dataset_areas(area(spark)).withColumn("is_enabled", F.lit(True))


def interconnector(spark: SparkSession) -> DataFrame:
    borders = rows(spark, "from_area_code string, to_area_code string", BORDERS)
    return scope.both_directions(borders).withColumn("is_enabled", F.lit(True))


def production_type(spark: SparkSession) -> DataFrame:
    typed = [(*r[:5], None if r[5] is None else Decimal(str(r[5])), r[6]) for r in PRODUCTION_TYPES]
    return rows(spark, "psr_type_code string, grid_name string, fuel_category string, is_renewable boolean, "
                       "is_low_carbon boolean, lifecycle_gco2e_per_kwh decimal(6,1), emission_factor_source string", typed)


def weather_location(spark: SparkSession) -> DataFrame:
    typed = [(*r[:3], *[Decimal(x) for x in r[3:]]) for r in WEATHER_LOCATIONS]
    return rows(spark, "location_code string, country_code string, location_name string, latitude decimal(8,5), "
                       "longitude decimal(8,5), weight decimal(5,4)", typed)


# Seed-merge rules: which columns a re-run compares and updates; switches are set on insert only.
SEED_KEYS = {
    "country": (["country_code"], ["is_active"]),
    "area": (["area_code"], []),
    "dataset_area": (["dataset", "area_code"], ["is_enabled"]),
    "interconnector": (["from_area_code", "to_area_code"], ["is_enabled"]),
    "production_type": (["psr_type_code"], []),
    "weather_location": (["location_code"], ["country_code"]),
}
