"""The daily job: silver loads, checks, dimensions, facts, reconciliation, in that order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.scalars import date_key, hour_start
from voltframe.operators import check_state, merge, planning, quality
from voltframe.operators.tables import Counts, Day, Lake
from voltframe.plans import gold, silver
from voltframe.plans.measures import Star
from voltframe.schemas import KEYS, TABLES
from voltframe.sources import reference, thresholds

RANGES = {      # fixed values: plausible bounds per measure
    "silver_load": [("load_mw", 0, 150000)],
    "silver_generation": [("power_mw", 0, 100000)],
    "silver_price": [("price_eur_mwh", -500, 4000)],
    "silver_flow": [("flow_mw", 0, 20000)],
    "silver_weather_hourly": [("temperature_2m", -40, 50), ("wind_speed_100m", 0, 250)],
}
FRESH_HOURS = {"silver_load": 48, "silver_generation": 48, "silver_price": 24, "silver_flow": 48,
               "silver_weather_hourly": 24}
AREA_COLUMNS = {"silver_load": ["area_code"], "silver_generation": ["area_code"], "silver_price": ["area_code"],
                "silver_flow": ["from_area_code", "to_area_code"]}
RECENT_DAYS, RECENT_WEATHER_DAYS = 7, 10
DAYS = {
    **{f"fact_{f}_hourly": Day() for f in ("load", "generation", "carbon", "price", "flow", "weather")},
    **{f"silver_{t}": Day("day_key", "ts_utc")
       for t in ("load", "generation", "price", "flow", "weather_hourly", "weather_country_hourly")},
}


CHECKED = [t for t in DAYS if t.startswith("silver_")]


def lake(spark, root: str) -> Lake:
    schemas, days = check_state.state_tables(CHECKED)
    return Lake(spark, root, {**TABLES, **schemas}, {**DAYS, **days})


def seed_reference(store: Lake) -> Mapping[str, Counts]:
    """Merge the reference data. A re-run updates changed descriptions only; switches such as
    `is_active` keep what was set since."""
    done = {}
    for name, (keys, insert_only) in reference.SEED_KEYS.items():
        rows = getattr(reference, name)(store.spark)
        done[name] = store.upsert(name, rows, keys, insert_only=insert_only)
    return done


def full_scan_due(as_of: str) -> bool:
    """Full completeness scans run on Sundays."""
    return dt.date.fromisoformat(as_of[:10]).isoweekday() == 7


def monthly_branch_due(as_of: str) -> bool:
    return dt.date.fromisoformat(as_of[:10]).day == 1


def check_silver(tables: Mapping[str, DataFrame], area: DataFrame, production_type: DataFrame, as_of: str,
                 check_days: int = RECENT_DAYS, full_check: bool = False, recent: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Every quality check on the silver tables that are given. `recent` holds tables that were read from the look-back
    of completeness on, so that it opens no older days."""
    checks = []
    for name, df in tables.items():
        checks.append(quality.unique_key(df, name, KEYS[name]))
        for column in AREA_COLUMNS.get(name, []):
            checks.append(quality.in_reference(df, name, column, area, "area_code"))
        if name == "silver_generation":
            checks.append(quality.in_reference(df, name, "psr_type_code", production_type, "psr_type_code", "psr_in_reference"))
        if name in RANGES or name in FRESH_HOURS:
            checks.append(quality.scan_checks(df, name, RANGES.get(name, ()), FRESH_HOURS.get(name), as_of))
        if name in AREA_COLUMNS:
            scoped = quality.recent((recent or {}).get(name, df), "ts_utc", as_of, check_days, full_check)
            checks.append(quality.completeness(scoped, name, AREA_COLUMNS[name], as_of))
    return quality.report(*checks)


def silver_rules(area: DataFrame, production_type: DataFrame) -> dict[str, check_state.Rules]:
    """What is counted per day of each partitioned silver table."""
    def references(table: str) -> list[check_state.Reference]:
        found = [check_state.Reference(c, area, "area_code") for c in AREA_COLUMNS.get(table, [])]
        types = check_state.Reference("psr_type_code", production_type, "psr_type_code", "psr_in_reference")
        return [*found, types] if table == "silver_generation" else found

    return {t: check_state.Rules(KEYS[t], references(t), RANGES.get(t, ()), FRESH_HOURS.get(t)) for t in CHECKED}


def check_stored(store: Lake, area: DataFrame, production_type: DataFrame, as_of: str, check_days: int = RECENT_DAYS, full_check: bool = False) -> DataFrame:
    """The checks of `check_silver` on the stored tables. Only days that changed since the last check are read, and the
    look-back of completeness; the reported numbers are those of the whole tables."""
    found = [check_state.check_all(store, silver_rules(area, production_type), as_of)]
    found += [quality.unique_key(store.read(t), t, KEYS[t]) for t in KEYS if t.startswith("silver_") and t not in CHECKED]
    for table, scope in AREA_COLUMNS.items():
        rows = store.read(table) if full_check else store.read(table, _day(as_of, check_days)[1])
        found.append(quality.completeness(quality.recent(rows, "ts_utc", as_of, check_days, full_check), table, scope, as_of))
    return quality.report(*found)


def refresh_dimensions(store: Lake, country: DataFrame, area: DataFrame, production_type: DataFrame, now: str) -> None:
    store.overwrite("dim_country", gold.dim_country(country))
    store.overwrite("dim_area", gold.dim_area(area, country))
    store.overwrite("dim_production_type", gold.dim_production_type(production_type))
    store.overwrite("dim_holiday", gold.dim_holiday(store.read("silver_holiday")))
    store.overwrite("dim_kpi_threshold", gold.dim_kpi_threshold(store.read("silver_kpi_threshold")))
    history = merge.scd2(store.read("dim_emission_factor"), production_type, "psr_type_code", gold.FACTOR_TRACKED, now)
    store.overwrite("dim_emission_factor", history.drop("_action"))


def _day(as_of: str, back: int = 0) -> tuple[str, int]:
    """A date `back` days before, as text and as a day key."""
    day = dt.date.fromisoformat(as_of[:10]) - dt.timedelta(days=back)
    return str(day), int(day.strftime("%Y%m%d"))


def load_gold(store: Lake, country: DataFrame, area: DataFrame, production_type: DataFrame, as_of: str,
              from_date: str | None = None) -> DataFrame:
    """Dimensions, then every fact from its reload date on, then the load reconciliation.

    The facts are in place before the check; a failed check is logged and then raised.
    """
    start, day = _day(from_date) if from_date else _day(as_of, RECENT_DAYS)
    weather_start, weather_day = _day(from_date) if from_date else _day(as_of, RECENT_WEATHER_DAYS)
    refresh_dimensions(store, country, area, production_type, as_of)
    areas = store.read("dim_area")

    def put(table: str, rows: DataFrame, first_day: int = day) -> None:
        store.replace_window(table, rows, first_day)

    put("fact_load_hourly", gold.load_hourly(store.read("silver_load", day), areas, as_of, start))
    put("fact_generation_hourly", gold.generation_hourly(
        store.read("silver_generation", day), areas, store.read("dim_emission_factor"), as_of, start))
    put("fact_carbon_hourly", gold.carbon_hourly(
        store.read("fact_generation_hourly", day), store.read("dim_production_type"), as_of, start))
    put("fact_price_hourly", gold.price_hourly(store.read("silver_price", day), areas, as_of, start))
    put("fact_flow_hourly", gold.flow_hourly(store.read("silver_flow", day), areas, as_of, start))
    put("fact_weather_hourly", gold.weather_hourly(
        store.read("silver_weather_country_hourly", weather_day), as_of, weather_start), weather_day)

    check = gold.reconcile_load(store.read("fact_load_hourly", day), store.read("silver_load", day), start)
    check = store.staged("reconciliation", check)
    store.append("gold_run_log", gold.run_log(check, as_of, as_of, start))
    outcome = check.first()
    if outcome["status"] != "OK":
        raise RuntimeError(f"load differs between gold and silver by {outcome['difference']} MWh")
    return check


def load_gold_changes(store: Lake, country: DataFrame, area: DataFrame, production_type: DataFrame, as_of: str, before: str | None = None) -> list[int]:
    """Compute again the hours that merges into silver have touched, and no others; the days that were opened.

    However old a correction is, it reaches gold, and files of other days stay. `before` leaves hours from that date on to
    a window reload. Hours are taken off the list once all facts hold them; a run that failed before does them again. What
    follows from changed dimensions alone (an area's country, a type's flags) takes a reload from a date.
    """
    refresh_dimensions(store, country, area, production_type, as_of)
    areas, owner = store.read("dim_area"), store.read("dim_area").select("area_code", "country_code")
    with store.scratch():
        listed = store.read("ctl_touched_hours")
        listed = listed.where(F.col("ts_hour_utc") < F.lit(before).cast("timestamp")) if before else listed
        todo = store.staged("touched", listed)
        opened: set[int] = set()

        def hours(table: str, scope: str, to_scope: str | None = None) -> tuple[DataFrame, list[int]]:
            mine = todo.where(F.col("table_name") == table)
            names = [F.col("scope").alias(scope), *([F.col("to_scope").alias(to_scope)] if to_scope else []), "ts_hour_utc"]
            days = sorted(r[0] for r in mine.select(date_key("ts_hour_utc")).distinct().collect())
            opened.update(days)
            return mine.select(*names).distinct(), days

        def source(table: str, keys: DataFrame, days: list[int]) -> DataFrame:
            """The rows of a silver table or fact in the given hours; only their days are listed."""
            rows, own = store.read(table, days=days), "ts_hour_utc" if table.startswith("fact_") else "ts_utc"
            return rows.withColumn("_hour", hour_start(own)).join(keys.withColumnRenamed("ts_hour_utc", "_hour"), [*[c for c in keys.columns if c != "ts_hour_utc"], "_hour"],
                                                                  "left_semi").drop("_hour")

        def again(fact: str, table: str, keys: DataFrame, days: list[int], make: Callable[[DataFrame], DataFrame]) -> None:
            if days:
                store.replace_keys(fact, make(source(table, keys, days)), keys, days)

        again("fact_load_hourly", "silver_load", *hours("silver_load", "area_code"), lambda rows: gold.load_hourly(rows, areas, as_of))
        keys, days = hours("silver_generation", "area_code")
        again("fact_generation_hourly", "silver_generation", keys, days,
              lambda rows: gold.generation_hourly(rows, areas, store.read("dim_emission_factor"), as_of))
        in_country = keys.join(owner, "area_code").select("country_code", "ts_hour_utc").distinct()
        again("fact_carbon_hourly", "fact_generation_hourly", in_country, days, lambda rows: gold.carbon_hourly(rows, store.read("dim_production_type"), as_of))
        again("fact_price_hourly", "silver_price", *hours("silver_price", "area_code"), lambda rows: gold.price_hourly(rows, areas, as_of))
        again("fact_flow_hourly", "silver_flow", *hours("silver_flow", "from_area_code", "to_area_code"), lambda rows: gold.flow_hourly(rows, areas, as_of))
        again("fact_weather_hourly", "silver_weather_country_hourly", *hours("silver_weather_country_hourly", "country_code"),
              lambda rows: gold.weather_hourly(rows, as_of))
        _forget(store, todo)
        return sorted(opened)


def _forget(store: Lake, done: DataFrame) -> None:
    """Take hours off the list that gold now holds; hours noted meanwhile stay."""
    store.overwrite("ctl_touched_hours", store.read("ctl_touched_hours").exceptAll(done))


def record_watermarks(store: Lake, run_log: DataFrame, as_of: str) -> Counts:
    """Move the stored watermarks of both sources on to what a run has loaded; none moves back."""
    keys = KEYS["ctl_watermark"]
    marks = planning.advance_incremental(run_log, as_of, keys).withColumn("updated_at_utc", F.lit(as_of).cast("timestamp"))
    return store.upsert("ctl_watermark", marks, keys, guard=planning.later_mark)


def record_run(store: Lake, done: DataFrame, run_id: str, source: str, as_of: str) -> Counts:
    """Append what became of the planned chunks to the audit log, and move the watermarks on."""
    rows = planning.audit_rows(done, run_id, source, as_of)
    store.append("ctl_ingest_log", rows)
    return record_watermarks(store, rows, as_of)


def load_thresholds(store: Lake, path: str) -> None:
    store.overwrite("silver_kpi_threshold", thresholds.read(store.spark, path))


def refresh_calendar(store: Lake) -> None:
    """The day and hour dimensions; days run over all stored facts, whose bounds are read from their folders."""
    days = [d for t in DAYS if t.startswith("fact_") for d in store.parts(t)]
    if days:
        first, last = (str(dt.datetime.strptime(str(f(days)), "%Y%m%d").date()) for f in (min, max))
        store.overwrite("dim_date", gold.dim_date(gold.date_bounds(store.spark, first, last)))
    store.overwrite("dim_hour", gold.dim_hour(store.spark))


def star(store: Lake) -> Star:
    """All stored facts and dimensions, ready for measures and questions."""
    facts = {f: store.read(f"fact_{f}_hourly") for f in ("load", "generation", "carbon", "price", "flow", "weather")}
    dims = {d: store.read(f"dim_{d}") for d in ("date", "hour", "country", "production_type")}
    return Star({**facts, "threshold": store.read("dim_kpi_threshold")}, {**dims, "area": store.read("dim_area").drop("country_code", "country_name")})


def run(store: Lake, raw_root: str, country: DataFrame, area: DataFrame, production_type: DataFrame,
        locations: DataFrame, as_of: str, datasets: Sequence[str] = tuple(silver.GRID_TABLES), mode: str = "incremental",
        from_date: str | None = None, check_days: int = RECENT_DAYS, full_check: bool | None = None,
        thresholds_path: str | None = None, run_optimize: bool = False) -> dict:
    """Silver energy, weather, holidays, thresholds on the first of a month or if there are none yet, checks, gold, compaction.
    Gold is reloaded from its window on; hours before the window that a merge has touched are computed again one by one."""
    with store.scratch():
        summary: dict = {d: silver.load_grid(store, raw_root, d, as_of, production_type, mode) for d in datasets}
        summary["weather"] = silver.load_weather(store, raw_root, locations, as_of, mode)
        summary["holidays"] = silver.load_holidays(store, f"{raw_root}/holidays", as_of)
        if thresholds_path and (monthly_branch_due(as_of) or store.read("silver_kpi_threshold").isEmpty()):
            load_thresholds(store, thresholds_path)
        full = full_scan_due(as_of) if full_check is None else full_check
        checks = check_stored(store, area, production_type, as_of, check_days, full)
        store.append("dq_check_result", quality.stamp(checks, as_of, as_of))
        start = from_date or _day(as_of, RECENT_DAYS)[0]
        summary["older_days"] = load_gold_changes(store, country, area, production_type, as_of, before=start)
        noted = store.staged("touched", store.read("ctl_touched_hours"))
        summary["gold"] = load_gold(store, country, area, production_type, as_of, from_date).first().asDict()
        _forget(store, noted)
        refresh_calendar(store)
        if run_optimize:
            summary["compacted"] = {t: store.compact(t) for t in DAYS}
    return summary
