import pytest
from pyspark.sql import functions as F

from helpers import at, clock, found
from voltframe.operators import planning, profile, quality, scope, security
from voltframe.sources import reference
from voltframe.sources.inline import rows

STATUS = ["check_name", "metric", "status"]


def test_unique_and_reference(frame):
    df = frame("a string, b int", [("x", 1), ("x", 1), ("y", 1), (None, 2), (None, 2), ("q", 3)])
    assert found(quality.unique_key(df, "t", ["a", "b"]), *STATUS) == [("unique_key", 2.0, "FAIL")]
    ref = frame("code string", [("x",)])
    assert found(quality.in_reference(df, "t", "a", ref, "code"), "metric", "status", "details") == [(2.0, "FAIL", "")]
    assert found(quality.in_reference(df.where("a = 'x'"), "t", "a", ref, "code"), "metric", "status", "details") == [(0.0, "PASS", "")]


def test_every_unknown_code_is_a_row(spark):
    df = spark.range(250).select(F.format_string("c%03d", "id").alias("c"))
    assert quality.in_reference(df, "t", "c", df.where("false"), "c").first()["metric"] == 250
    codes = quality.unknown_codes(df.unionByName(df), "t", "c", df.where("c < 'c005'"), "c")
    assert found(codes) == [("t", "c", f"c{i:03d}") for i in range(5, 250)]


def test_range_bounds_are_inclusive_and_null_passes(frame):
    df = frame("p double", [(-500.0,), (4000.0,), (-500.01,), (None,)])
    assert found(quality.value_ranges(df, "t", [("p", -500, 4000)]), "metric", "status", "threshold") == [(1.0, "WARN", "[-500, 4000]")]


def days(spark, minutes_by_day):
    values = []
    for day, parts in minutes_by_day.items():
        for res, n in parts:
            values += [("A", at(f"{day} {i * res // 60:02d}:{i * res % 60:02d}"), res) for i in range(n)]
    return rows(spark, "area_code string, ts_utc timestamp, resolution_minutes int", values)


def test_completeness(spark):
    df = days(spark, {"2025-01-01": [(60, 24)], "2025-01-02": [(60, 23)], "2025-01-03": [(60, 24), (15, 96)], "2025-01-09": [(60, 1)]})
    df = df.unionByName(df.where("ts_utc < '2025-01-02'"))      # repeated intervals count once
    per_day = quality.minutes_per_day(df, ["area_code"], "2025-01-10 08:00:00")
    assert [(str(d), m, n) for d, m, n in found(per_day, "day", "minutes", "resolutions")] == [
        ("2025-01-01", 1440, 1), ("2025-01-02", 1380, 1), ("2025-01-03", 2880, 2)]
    out = quality.completeness(df, "silver_load", ["area_code"], "2025-01-10 08:00:00")
    assert found(out, *STATUS, "details") == [
        ("completeness_gap_days", 1.0, "WARN", "1 of 3 scope-days incomplete; worst: A 2025-01-02 1380min"),
        ("completeness_overlap_days", 1.0, "INFO", "1 scope-days published at more than one resolution")]
    assert quality.recent(df, "ts_utc", "2025-01-10", 7).select(F.min("ts_utc").cast("string")).first()[0].startswith("2025-01-03")
    assert quality.recent(df, "ts_utc", "2025-01-10", 7, full_check=True) is df


def test_completeness_of_nothing(spark):
    empty = days(spark, {})
    out = quality.completeness(empty, "t", ["area_code"], "2025-01-10")
    assert [r[2] for r in found(out, *STATUS)] == ["PASS", "PASS"]


def test_freshness(frame):
    df = frame("ts_utc timestamp", [(at("2024-12-31 23:00"),)])
    assert found(quality.freshness(df, "t", "2025-01-03 00:00:00", 48), "metric", "status") == [(49.0, "WARN")]
    assert found(quality.freshness(df, "t", "2025-01-03 00:00:00", 49), "status") == [("PASS",)]
    assert found(quality.freshness(df.where("false"), "t", "2025-01-03 00:00:00", 48), "metric", "status") == [(1e9, "WARN")]


def test_guards(frame):
    df = frame("z string, loc string, c string", [("GMT", "L1", "X"), ("UTC", "L2", None)])
    quality.require_subset(df, "z", ["GMT", "UTC"], "zone")
    with pytest.raises(ValueError, match="Europe/Rome"):
        quality.require_subset(frame("z string", [("GMT",), ("Europe/Rome",)]), "z", ["GMT", "UTC"], "zone")
    with pytest.raises(ValueError, match="None"):
        quality.require_subset(frame("z string", [(None,)]), "z", ["GMT"], "zone")
    with pytest.raises(ValueError, match="L2"):
        quality.require_present(df, "c", "loc", "location")


def test_month_chunks(frame):
    df = frame("dataset string, area_key string, window_start timestamp, window_end timestamp", [
        ("load", "A", at("2024-01-15"), at("2024-03-02")), ("load", "B", at("2024-02-01"), at("2024-02-01")), ("load", "C", at("2024-03-05"), at("2024-02-01"))])
    assert clock(planning.chunks(df), "area_key", "chunk_start", "chunk_end") == [
        ("A", "2024-01-15 00:00", "2024-02-01 00:00"), ("A", "2024-02-01 00:00", "2024-03-01 00:00"), ("A", "2024-03-01 00:00", "2024-03-02 00:00")]


def test_year_chunks(frame):
    df = frame("window_start timestamp, window_end timestamp", [(at("2024-01-01"), at("2026-02-10"))])
    got = clock(planning.chunks(df, "year"), "chunk_start", "chunk_end")
    assert len(got) == 3 and got[-1] == ("2026-01-01 00:00", "2026-02-10 00:00")


def test_windows_by_mode(frame):
    targets = frame("dataset string, area_key string", [("actual_load", "A"), ("day_ahead_price", "A")])
    marks = frame("dataset string, area_key string, loaded_until_utc timestamp", [("actual_load", "A", at("2024-02-20 05:00"))])

    def plan(mode):
        return clock(planning.windows(targets, mode, "2024-03-01 10:00:00", watermarks=marks, ahead_days=planning.price_ahead()), "dataset", "window_start", "window_end")

    assert plan("test") == [("actual_load", "2024-02-27 00:00", "2024-03-01 00:00"), ("day_ahead_price", "2024-02-27 00:00", "2024-03-01 00:00")]
    assert plan("backfill") == [("actual_load", "2024-01-01 00:00", "2024-03-02 00:00"), ("day_ahead_price", "2024-01-01 00:00", "2024-03-03 00:00")]
    assert plan("incremental") == [("actual_load", "2024-02-17 05:00", "2024-03-02 00:00"), ("day_ahead_price", "2024-01-01 00:00", "2024-03-03 00:00")]
    with pytest.raises(ValueError):
        plan("other")


def test_weather_windows_are_batched(spark, frame):
    active = scope.active_rows(reference.country(spark)).select("country_code")
    locations = reference.weather_location(spark).join(active, "country_code").select(F.col("location_code").alias("area_key"))
    assert locations.count() == 11
    marks = locations.select(F.lit("weather_hourly_archive").alias("dataset"), "area_key", F.lit("2024-02-20").cast("timestamp").alias("loaded_until_utc"))
    plan = planning.weather_windows(locations, "incremental", "2024-03-01 05:00:00", watermarks=marks)
    assert plan.count() == 22
    calls = planning.batch_windows(plan, "area_key")
    assert clock(calls, "dataset", "chunk_start", "chunk_end", "calls_saved") == [
        ("weather_hourly_archive", "2024-02-13 00:00", "2024-02-24 00:00", 10), ("weather_hourly_forecast", "2024-02-23 00:00", "2024-03-03 00:00", 10)]
    test_mode = planning.weather_windows(locations, "test", "2024-03-01 05:00:00").where("dataset LIKE '%archive'")
    assert clock(test_mode.select("chunk_start", "chunk_end").distinct()) == [("2024-02-21 00:00", "2024-02-24 00:00")]


LOG = "dataset string, area_key string, request_start_utc timestamp, request_end_utc timestamp, status string, ingested_at_utc timestamp"


def attempt(area, start, end, status, seen):
    return ("load", area, at(start), at(end), status, at(seen))


def test_resume_and_watermark(frame):
    log = frame(LOG, [
        attempt("A", "2024-01-01", "2024-02-01", "error", "2024-03-01 01:00"), attempt("A", "2024-01-01", "2024-02-01", "ok", "2024-03-01 02:00"),
        attempt("A", "2024-02-01", "2024-03-10", "no_data", "2024-03-01 02:00"),
        attempt("B", "2024-01-01", "2024-02-01", "ok", "2024-03-01 01:00"), attempt("B", "2024-02-01", "2024-03-01", "error", "2024-03-01 01:00"),
        attempt("C", "2024-01-15", "2024-02-01", "error", "2024-03-01 01:00"), attempt("C", "2024-02-01", "2024-03-01", "ok", "2024-03-01 01:00")])
    assert clock(planning.advance_backfill(log, "2024-03-05 00:00:00")) == [
        ("load", "A", "2024-03-05 00:00"), ("load", "C", "2024-03-01 00:00")]
    assert clock(planning.advance_incremental(log.where("area_key <> 'C'"), "2024-03-05 00:00:00")) == []
    planned = log.select("dataset", "area_key", F.col("request_start_utc").alias("chunk_start"), F.col("request_end_utc").alias("chunk_end")).distinct()
    assert clock(planning.resume(planned, log), "area_key", "chunk_start") == [("B", "2024-02-01 00:00"), ("C", "2024-01-15 00:00")]


def test_pending_is_strictly_after_the_state(frame):
    files = frame("source string, dataset string, status string, ingested_at_utc timestamp, f int", [
        ("grid", "load", "ok", at("2024-01-02"), 1), ("grid", "load", "ok", at("2024-01-01"), 2), ("grid", "load", "no_data", at("2024-01-03"), 3), ("other", "load", "ok", at("2024-01-03"), 4), ("grid", "price", "ok", at("2020-01-01"), 5)])
    state = frame("dataset string, processed_until_ingested_at timestamp", [("load", at("2024-01-01"))])
    assert found(planning.pending(files, state, "grid", F.lit(True)), "f") == [(1,), (5,)]
    assert found(planning.pending(files, state, "grid", F.lit(True), mode="full"), "f") == [(1,), (2,), (5,)]


def test_batch_windows(frame):
    df = frame("dataset string, chunk_start int, chunk_end int, loc string", [("w", 1, 2, "b"), ("w", 1, 2, "a"), ("w", 2, 3, "a")])
    assert found(planning.batch_windows(df, "loc"), "chunk_start", "members", "calls_saved") == [(1, ["a", "b"], 1), (2, ["a"], 0)]


def test_reference_counts_and_weights(spark):
    # 12 country areas serve three datasets each, 18 bidding zones serve prices
    expected = {reference.country: 12, reference.area: 20, reference.dataset_area: 12 * 3 + 18, reference.interconnector: 40,
                reference.production_type: 21, reference.weather_location: 23}
    assert {f: f(spark).count() for f in expected} == expected
    assert reference.country(spark).where("is_active").count() == 4
    assert profile.uneven_weights(reference.weather_location(spark), "country_code", "weight").isEmpty()


def test_pilot_scope(spark):
    areas = scope.active_areas(reference.dataset_area(spark), reference.area(spark), reference.country(spark))
    assert dict(found(areas.groupBy("dataset").count())) == {"actual_load": 4, "actual_generation": 4, "installed_capacity": 4, "day_ahead_price": 10}
    borders = scope.active_borders(reference.interconnector(spark), reference.area(spark), reference.country(spark))
    assert borders.count() == 30


def test_reference_rows_have_a_known_size(spark):
    plan = reference.country(spark)._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan


def test_row_level_security(frame):
    df = frame("country_code string, v int", [("NL", 1), ("DE", 2), ("FR", 3)])
    policy = frame("user_name string, country_code string", [("u1", "NL"), ("u2", "*")])
    seen = {u: found(security.restrict(df, policy, u, "country_code"), "v") for u in ("u1", "u2", "u3")}
    assert seen == {"u1": [(1,)], "u2": [(1,), (2,), (3,)], "u3": []}


def test_evaluation(frame):
    runs = frame("`set` string, correct bigint, wrong bigint, pct double", [("heldout", 14, 0, 100.0), ("heldout", 13, 1, 92.9), ("heldout", 14, 0, 100.0)])
    assert found(profile.evaluation(runs)) == [("heldout", 41, 1, 92.9, 100.0, 97.6)]
