"""Silver layer: parsed intervals shaped to their tables, weather, and the incremental runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions.scalars import date_key, energy_mwh, hour_start, split_pair
from voltframe.operators import dedupe, planning, series
from voltframe.operators.tables import Lake
from voltframe.schemas import KEYS, LINEAGE, SILVER, align
from voltframe.sources import files as raw_files
from voltframe.sources import grid_xml, json_records, weather_json

GRID_SOURCE, WEATHER_SOURCE = "grid", "weather"
GRID_TABLES = {     # fixed values: dataset -> table
    "actual_load": "silver_load",
    "actual_generation": "silver_generation",
    "day_ahead_price": "silver_price",
    "crossborder_flow": "silver_flow",
}
QUARANTINE_KEYS = ["table_name", "record_key", "rule_name", "source_file"]
COUNTRY_VARIABLES = ["temperature_2m", "wind_speed_100m", "shortwave_radiation", "cloud_cover", "precipitation"]


def latest_intervals(parsed: DataFrame) -> DataFrame:
    """Of several downloads of an interval the last one ingested counts."""
    keys = ["area_key", "ts_utc", "resolution_minutes", "psr_type_code", "direction"]
    return dedupe.latest(parsed, keys, "_bronze_ingested_at", "_source_file")


def shape(dataset: str, df: DataFrame, production_type: DataFrame | None = None) -> DataFrame:
    energy = energy_mwh("value", "resolution_minutes")
    if dataset == "actual_load":
        return df.withColumns({"area_code": F.col("area_key"), "load_mw": F.col("value"), "energy_mwh": energy})
    if dataset == "actual_generation":
        factor = production_type.select("psr_type_code", F.col("lifecycle_gco2e_per_kwh").cast("double").alias("_factor"))
        # MWh times g/kWh is kg; only generation emits
        return (df.join(factor, "psr_type_code", "left")
                .withColumns({"area_code": F.col("area_key"), "power_mw": F.col("value"), "energy_mwh": energy})
                .withColumn("co2e_kg", F.when(F.col("direction") == "generation", F.col("energy_mwh") * F.col("_factor"))))
    if dataset == "day_ahead_price":
        return df.withColumns({"area_code": F.col("area_key"), "price_eur_mwh": F.col("value")})
    if dataset == "crossborder_flow":
        from_area, to_area = split_pair("area_key")
        return df.withColumns({"from_area_code": from_area, "to_area_code": to_area,
                               "flow_mw": F.col("value"), "energy_mwh": energy})
    raise ValueError(f"unknown dataset {dataset!r}")


def country_weather(hourly: DataFrame, locations: DataFrame) -> DataFrame:
    """Country hours: weighted means over its locations and the observed share of the weight."""
    weights = locations.select("location_code", F.col("weight").cast("double").alias("weight"))
    return series.weighted_mean(hourly.join(weights, "location_code"), ["country_code", "ts_utc"], COUNTRY_VARIABLES,
                                "weight", {"archive_share": F.col("data_source") == "archive"})


def best_weather(parsed: DataFrame) -> DataFrame:
    """Observed values before forecasts, then the last ingest."""
    return dedupe.preferred_then_latest(parsed, ["location_code", "ts_utc"], F.col("data_source") == "archive",
                                        "_bronze_ingested_at", "_source_file")


def keep_observed(old, new) -> Column:
    """Merge guard: a forecast never replaces an observed value."""
    return ~((old("data_source") == "archive") & (new("data_source") == "forecast"))


def not_older(old, new) -> Column:
    """Merge guard: what came in earlier, or at one time from a file of a lower name, never replaces what came in later."""
    def order(side) -> Column:
        return F.struct(side("_bronze_ingested_at"), side("_source_file"))

    return old("_bronze_ingested_at").isNull() | (order(new) >= order(old))


def _stamped(df: DataFrame, at: str) -> DataFrame:
    return df.withColumn("_silver_updated_at", F.lit(at).cast("timestamp"))


def _fixed_list(lake: Lake, pending: DataFrame) -> DataFrame:
    """The files of this run, cut into scan groups and written down, so that parsing and the new state see the same list.
    It lies in the order of the groups, so that one group is read without the others."""
    files = raw_files.grouped(pending.select("dataset", "area_key", "file_path", "bytes", "ingested_at_utc"))
    return lake.staged("pending", files.drop("bytes").repartitionByRange("scan_group").sortWithinPartitions("scan_group"))


def by_group(todo: DataFrame, read: Callable[[DataFrame], DataFrame]) -> Iterator[DataFrame]:
    """What `read` makes of each scan group of a written list, one at a time."""
    for name in raw_files.scan_groups(todo):
        yield read(todo.where(F.col("scan_group") == name).drop("scan_group"))


def quarantine(lake: Lake, bad: DataFrame) -> int:
    """Note rejected rows once, however often their file is read; the number of new ones."""
    return lake.append_missing("dq_quarantine", bad, QUARANTINE_KEYS)


def _advance_state(lake: Lake, pending: DataFrame, as_of: str, state_key: Column | None = None) -> None:
    state = planning.processed_until(pending, state_key).withColumn("updated_at_utc", F.lit(as_of).cast("timestamp"))
    lake.upsert("ctl_silver_state", state, KEYS["ctl_silver_state"], test_change=False)


def load_grid(lake: Lake, raw_root: str, dataset: str, as_of: str, production_type: DataFrame | None = None,
              mode: str = "incremental", modified_after: str | None = None) -> Mapping[str, int]:
    """Parse the new documents of one dataset into its silver table.

    Documents with a fault are quarantined whole and count as processed. The documents are
    parsed once; their rows and faults are written down together and then told apart.
    """
    table = GRID_TABLES[dataset]
    todo = _fixed_list(lake, planning.pending(lake.read("ctl_ingest_log"), lake.read("ctl_silver_state"), GRID_SOURCE,
                                              F.col("dataset") == dataset, mode))
    if todo.isEmpty():
        return {"inserted": 0, "updated": 0, "rejected": 0}
    carried = ("area_key", "file_path", "ingested_at_utc")

    def parse(group: DataFrame) -> DataFrame:
        docs = raw_files.documents(lake.spark, raw_root, group, modified_after=modified_after)
        return grid_xml.intervals(grid_xml.read_documents(docs), *carried, faults=True)

    with lake.scratch():
        parsed = lake.staged_all("parsed", by_group(todo, parse))
        done = merge_intervals(lake, parsed, dataset, as_of, production_type)
    _advance_state(lake, todo, as_of)
    return done


def touched(lake: Lake, table: str, scope: str, as_of: str, to_scope: str | None = None) -> Callable[[DataFrame], None]:
    """Notes the hours that a merge changes, for gold to compute them again."""
    def note(rows: DataFrame) -> None:
        hours = rows.select(F.lit(table).alias("table_name"), F.col(scope).alias("scope"), (F.col(to_scope) if to_scope else F.lit(None)).alias("to_scope"),
                            hour_start("ts_utc").alias("ts_hour_utc"), F.lit(as_of).cast("timestamp").alias("noted_at")).distinct()
        lake.append("ctl_touched_hours", hours)

    return note


def merge_intervals(lake: Lake, parsed: DataFrame, dataset: str, as_of: str, production_type: DataFrame | None = None) -> Mapping[str, int]:
    """Merge a written table of parsed rows and faults into the dataset's silver table and the quarantine. Doing it again
    changes nothing."""
    table = GRID_TABLES[dataset]
    rejected = quarantine(lake, grid_xml.rejected(parsed, table, "file_path", as_of))
    found = parsed.where(F.col("fault").isNull()).drop("fault").withColumnsRenamed(
        {"file_path": "_source_file", "ingested_at_utc": "_bronze_ingested_at"})
    rows = _stamped(shape(dataset, latest_intervals(found), production_type), as_of)
    noted = touched(lake, table, *(("from_area_code", as_of, "to_area_code") if dataset == "crossborder_flow" else ("area_code", as_of)))
    counts = lake.upsert(table, align(rows, SILVER[table], table), KEYS[table], lineage=LINEAGE, guard=not_older, note=noted)
    return {"inserted": counts.inserted, "updated": counts.updated, "rejected": rejected}


def load_weather(lake: Lake, raw_root: str, locations: DataFrame, as_of: str, mode: str = "incremental") -> Mapping[str, int]:
    """New weather files into location hours, then the country hours of the touched days."""
    state_key = F.lit("weather")
    todo = _fixed_list(lake, planning.pending(lake.read("ctl_ingest_log"), lake.read("ctl_silver_state"), WEATHER_SOURCE,
                                              F.col("dataset").startswith("weather_hourly_"), mode, state_key))
    if todo.isEmpty():
        return {"inserted": 0, "updated": 0}
    parsed = lake.staged_all("weather", by_group(todo, lambda group: weather_json.parse(weather_json.scan(lake.spark, raw_root, group), group, locations)))
    batch = lake.staged("weather", _stamped(best_weather(parsed), as_of))
    counts = lake.upsert("silver_weather_hourly", batch, KEYS["silver_weather_hourly"], lineage=LINEAGE, guard=keep_observed)
    days = [r[0] for r in batch.select(date_key("ts_utc")).distinct().collect()]    # as many as the batch has days
    hours = series.restrict_to_touched(lake.read("silver_weather_hourly", days=days), batch, ["country_code"], "ts_utc")
    lake.upsert("silver_weather_country_hourly", _stamped(country_weather(hours, locations), as_of),
                KEYS["silver_weather_country_hourly"], lineage=LINEAGE, note=touched(lake, "silver_weather_country_hourly", "country_code", as_of))
    _advance_state(lake, todo, as_of, state_key)
    return {"inserted": counts.inserted, "updated": counts.updated}


def load_holidays(lake: Lake, raw_root: str, as_of: str) -> Mapping[str, int]:
    """The holiday snapshot: vanished holidays are removed. Files or lines that are no JSON are quarantined."""
    read = lake.staged("holidays", json_records.read_holiday_files(lake.spark, raw_root))
    return merge_holidays(lake, read, as_of, delete_missing=True)


def merge_holidays(lake: Lake, read: DataFrame, as_of: str, delete_missing: bool = False) -> Mapping[str, int]:
    """Merge a written table of parsed holiday records into silver and the quarantine. Doing it again changes nothing."""
    sound = read.where(F.col("_malformed").isNull()).drop("_malformed")
    good, bad = json_records.clean_holidays(json_records.holidays(sound), as_of)
    rejected = quarantine(lake, bad.unionByName(json_records.malformed(read, "silver_holiday", "source_file", as_of)))
    counts = lake.upsert("silver_holiday", _stamped(good, as_of), KEYS["silver_holiday"], lineage=LINEAGE, delete_missing=delete_missing)
    return {**counts._asdict(), "rejected": rejected}
