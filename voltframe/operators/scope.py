"""Which areas and borders are in scope, derived from the reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTRY_AREA_DATASETS = ["actual_load", "actual_generation", "installed_capacity"]   # fixed values


def dataset_areas(area: DataFrame) -> DataFrame:
    """Country areas serve three datasets, bidding zones serve prices."""
    per_country = area.where("is_country_area").select(
        F.explode(F.array(*[F.lit(d) for d in COUNTRY_AREA_DATASETS])).alias("dataset"), "area_code")
    prices = area.where("is_bidding_zone").select(F.lit("day_ahead_price").alias("dataset"), "area_code")
    return per_country.unionByName(prices)


def both_directions(borders: DataFrame, a: str = "from_area_code", b: str = "to_area_code") -> DataFrame:
    """Every undirected border as two directed rows, in one pass."""
    pair = F.array(F.struct(F.col(a).alias(a), F.col(b).alias(b)), F.struct(F.col(b).alias(a), F.col(a).alias(b)))
    return borders.select(F.inline(pair))


def active_areas(dataset_area: DataFrame, area: DataFrame, country: DataFrame) -> DataFrame:
    """Enabled dataset areas of active countries."""
    return (dataset_area.where("is_enabled").select("dataset", "area_code")
            .join(area.select("area_code", "eic_code", "country_code"), "area_code")
            .join(country.where("is_active").select("country_code"), "country_code")
            .select("dataset", "area_code", "eic_code"))


def active_borders(interconnector: DataFrame, area: DataFrame, country: DataFrame) -> DataFrame:
    """Enabled borders with an active country on at least one side."""
    owner = area.select("area_code", "country_code").join(country.select("country_code", "is_active"), "country_code")

    def side(role: str) -> DataFrame:
        return owner.select(F.col("area_code").alias(f"{role}_area_code"), F.col("is_active").alias(f"_{role}_active"))

    return (interconnector.where("is_enabled")
            .join(side("from"), "from_area_code").join(side("to"), "to_area_code")
            .where("_from_active OR _to_active").select("from_area_code", "to_area_code"))


def active_locations(location: DataFrame, country: DataFrame) -> DataFrame:
    """Weather locations of active countries."""
    return (location.join(country.where("is_active").select("country_code"), "country_code")
            .select("location_code", "country_code", "latitude", "longitude"))


def active_rows(df: DataFrame, flag: str = "is_active") -> DataFrame:
    return df.where(F.col(flag))
