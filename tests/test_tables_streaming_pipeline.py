from pathlib import Path

import pytest
from pyspark.sql import functions as F

from helpers import at, clock, found
from test_sources import document, point, weather_file
from voltframe import session
from voltframe.operators.tables import Day, Lake
from voltframe.plans import pipeline
from voltframe.schemas import describe
from voltframe.sources import reference
from voltframe.sources.inline import rows
from voltframe.streaming import events as streams

DAILY = describe("date_key int !\nk string !\nv int")


@pytest.fixture
def store(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), {"daily": DAILY, "flat": DAILY}, {"daily": Day()})


def daily(spark, *values):
    return rows(spark, "date_key int, k string, v int", values)


def files_of(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_missing_table_reads_empty(store):
    assert store.read("daily").columns == ["date_key", "k", "v"] and store.read("daily").isEmpty()


def test_upsert_rewrites_touched_partitions_only(spark, store, tmp_path):
    store.append("daily", daily(spark, (1, "a", 1), (2, "a", 1)))
    before = files_of(tmp_path / "lake" / "daily" / "date_key=1")
    assert tuple(store.upsert("daily", daily(spark, (2, "a", 5), (3, "b", 1)), ["date_key", "k"])) == (1, 1, 0)
    assert found(store.read("daily")) == [(1, "a", 1), (2, "a", 5), (3, "b", 1)]
    assert files_of(tmp_path / "lake" / "daily" / "date_key=1") == before


def test_upsert_without_change_writes_nothing(spark, store, tmp_path):
    store.append("flat", daily(spark, (1, "a", 1)))
    before = files_of(tmp_path / "lake")
    assert tuple(store.upsert("flat", daily(spark, (1, "a", 1)), ["date_key", "k"])) == (0, 0, 0)
    assert files_of(tmp_path / "lake") == before


def test_snapshot_delete_on_a_partitioned_table(spark, store):
    store.append("daily", daily(spark, (1, "a", 1), (2, "a", 1)))
    assert tuple(store.upsert("daily", daily(spark, (2, "a", 1)), ["date_key", "k"], delete_missing=True)) == (0, 0, 1)
    assert found(store.read("daily")) == [(2, "a", 1)]


def test_required_columns(spark, store):
    with pytest.raises(Exception, match="k must not be NULL"):
        store.append("daily", daily(spark, (1, None, 1)))


def test_replace_window_empties_days_without_rows(spark, store):
    store.append("daily", daily(spark, (1, "a", 1), (2, "a", 1), (3, "a", 1)))
    store.replace_window("daily", daily(spark, (1, "late", 9), (3, "b", 2)), 2)
    assert found(store.read("daily")) == [(1, "a", 1), (3, "b", 2)]
    store.replace_window("daily", daily(spark, (3, "b", 2)), 2)
    assert found(store.read("daily")) == [(1, "a", 1), (3, "b", 2)]


def test_compaction(spark, store):
    for i in range(3):
        store.append("flat", daily(spark, (i, "a", i)).repartition(1))
    assert store.compact("flat", above=5) == (3, 3)
    assert store.compact("flat", above=2)[1] < 3
    assert found(store.read("flat"), "v") == [(0,), (1,), (2,)]


class _Session:
    """As much of a session as the folder choice looks at."""

    def __init__(self, master, configured=None):
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})()


def test_shared_folder_comes_from_the_session():
    assert session.new_folder(_Session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    assert session.shared_dir(_Session("local[2]")) == session.shared_dir(_Session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session("yarn"))


# ---- streaming -------------------------------------------------------------------------

EVENT = "id int, ts timestamp, k string, v int"


def stream_of(spark, path):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_latest_per_key_over_batches_and_replay(spark, tmp_path):
    feed, store = tmp_path / "in", Lake(spark, str(tmp_path / "lake"), {"state": describe("k string !\nts timestamp\nid int\nv int")})
    rows(spark, EVENT, [(1, at("2025-01-01 01:00"), "a", 1), (2, at("2025-01-01 02:00"), "a", 2)]).write.parquet(str(feed))

    def run(checkpoint):
        streams.keep_latest(stream_of(spark, feed).select("k", "ts", "id", "v"), store, "state", ["k"], ["ts", "id"], str(tmp_path / checkpoint))
        return found(store.read("state"), "k", "v")

    assert run("c1") == [("a", 2)]
    rows(spark, EVENT, [(3, at("2025-01-01 01:30"), "a", 3), (4, at("2025-01-01 01:00"), "b", 4)]).coalesce(1).write.mode("append").parquet(str(feed))
    assert run("c1") == [("a", 2), ("b", 4)]        # the older row for a changes nothing
    assert run("c2") == [("a", 2), ("b", 4)]        # a full replay changes nothing either


def test_late_events_are_dropped(spark, tmp_path):
    feed = tmp_path / "in"

    def send(*events):
        rows(spark, EVENT, events).coalesce(1).write.mode("append").parquet(str(feed))

    windows = lambda: streams.tumbling(stream_of(spark, feed), "ts", "10 minutes", "1 hour", ["k"], {"n": F.count(F.lit(1))})
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    send((1, at("2025-01-01 00:10"), "a", 1))
    send((2, at("2025-01-01 03:00"), "a", 1))
    streams.to_table(windows(), out, check)
    send((3, at("2025-01-01 00:20"), "a", 1), (4, at("2025-01-01 05:00"), "a", 1))
    streams.to_table(windows(), out, check)
    assert clock(spark.read.parquet(out), "window_start", "n") == [("2025-01-01 00:00", 1), ("2025-01-01 03:00", 1)]


def test_repeats_are_dropped_across_batches(spark, tmp_path):
    feed, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")

    def send(*events):
        rows(spark, EVENT, events).repartition(2).write.mode("append").parquet(str(feed))
        streams.to_table(streams.first_seen(stream_of(spark, feed), "ts", "1 day", ["id"]), out, check)

    send(*[(1, at("2025-01-01 00:10"), "a", 1)] * 4, (2, at("2025-01-01 00:10"), "a", 1))
    send((1, at("2025-01-01 00:10"), "a", 1), (3, at("2025-01-01 01:10"), "a", 1))
    assert found(spark.read.parquet(out), "id") == [(1,), (2,), (3,)]


# ---- the daily job ---------------------------------------------------------------------


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def log_row(dataset, area, path, seen, source="grid", status="ok"):
    return ("r", source, dataset, area, at("2025-01-01"), at("2025-01-02"), status, path, 1, 1, None, at(seen))


@pytest.fixture
def job(spark, tmp_path):
    raw, store = tmp_path / "raw", pipeline.lake(spark, str(tmp_path / "lake"))
    psr = lambda code: f"<MktPSRType><psrType>{code}</psrType></MktPSRType>"
    put(raw / "grid", "load_nl.xml", document(point(1, 100) + point(2, 140), "A01", res="PT1H"))
    put(raw / "grid", "load_bad.xml", document(point(1, 100) + point(2, "abc"), "A01"))
    put(raw / "grid", "gen_nl.xml", document(point(1, 60), "A03", res="PT30M", extra=psr("B16")).replace(
        "</GL_Document>", "") + document(point(1, 20), "A03", res="PT1H", extra=psr("B04")).split('"urn:x">')[1])
    put(raw / "grid", "price_nl.xml", document(point(1, -5, "price.amount") + point(2, 30, "price.amount"), "A01", res="PT1H"))
    put(raw / "grid", "flow.xml", document(point(1, 12), "A03", res="PT1H"))
    (raw / "weather").mkdir()
    weather_file(raw / "weather" / "w_ams.json", ["2025-01-01T00:00"], "[4]")
    put(raw / "holidays", "nl.json", '[{"countryCode":"NL","date":"2025-01-01","localName":"N","name":"New Year"},{"countryCode":"NL","date":"2025-01-02"}]')
    store.append("ctl_ingest_log", rows(spark, store.schemas["ctl_ingest_log"], [
        log_row("actual_load", "NL", "grid/load_nl.xml", "2025-01-03 01:00"), log_row("actual_load", "DE", "grid/load_bad.xml", "2025-01-03 02:00"),
        log_row("actual_generation", "NL", "grid/gen_nl.xml", "2025-01-03 01:00"), log_row("day_ahead_price", "NL", "grid/price_nl.xml", "2025-01-03 01:00"),
        log_row("crossborder_flow", "DE>NL", "grid/flow.xml", "2025-01-03 01:00"), log_row("actual_load", "FR", None, "2025-01-03 01:00", status="no_data"),
        log_row("weather_hourly_archive", "NL-AMS", "weather/w_ams.json", "2025-01-03 01:00", source="weather")]))
    return raw, store


def run(spark, raw, store, as_of="2025-01-05 06:00:00"):
    return pipeline.run(store, str(raw), reference.country(spark), reference.area(spark), reference.production_type(spark),
                        reference.weather_location(spark), as_of)


def test_daily_job_end_to_end(spark, job):
    raw, store = job
    first = run(spark, raw, store)
    assert first["actual_load"] == {"inserted": 2, "updated": 0, "rejected": 1}
    assert first["gold"]["status"] == "OK"
    assert found(store.read("fact_load_hourly"), "area_code", "hour_key", "load_mwh") == [("NL", 0, pytest.approx(100)), ("NL", 1, pytest.approx(140))]
    carbon = store.read("fact_carbon_hourly").where("hour_key = 0").first()
    assert (float(carbon["total_generation_mwh"]), float(carbon["carbon_intensity_g_per_kwh"])) == (80.0, 158.5)
    assert found(store.read("fact_flow_hourly"), "from_country_code", "to_country_code", "flow_mwh")[0][:2] == ("DE", "NL")
    assert store.read("fact_price_hourly").where("price_eur_mwh < 0").count() == 1
    assert store.read("fact_weather_hourly").first()["is_observed"] is True
    assert found(store.read("dim_holiday"), "country_code", "date_key") == [("NL", 20250101)]
    assert sorted(r[0] for r in found(store.read("dq_quarantine"), "rule_name")) == ["missing_required_field", "xml_parse_error"]
    assert store.read("dim_emission_factor").where("is_current").count() == 21
    assert found(store.read("gold_run_log"), "status") == [("OK",)]
    checks = store.read("dq_check_result")
    assert checks.where("status = 'FAIL'").isEmpty()
    assert checks.count() == 7 + 5 + 1 + 6 + 8 + 5

    # a later run: one correction arrives, everything else stays as it was
    facts = {t: clock(store.read(t).drop("loaded_at_utc")) for t in pipeline.DAYS if t.startswith('fact_') and t != "fact_load_hourly"}
    put(raw / "grid", "load_nl2.xml", document(point(1, 110), "A01", res="PT1H"))
    store.append("ctl_ingest_log", rows(spark, store.schemas["ctl_ingest_log"], [log_row("actual_load", "NL", "grid/load_nl2.xml", "2025-01-06 01:00")]))
    second = run(spark, raw, store, "2025-01-07 06:00:00")
    assert second["actual_load"] == {"inserted": 0, "updated": 1, "rejected": 0}
    assert second["day_ahead_price"] == {"inserted": 0, "updated": 0, "rejected": 0}
    assert found(store.read("fact_load_hourly"), "load_mwh") == [(110,), (140,)]
    assert {t: clock(store.read(t).drop("loaded_at_utc")) for t in facts} == facts

    # load energy that gold cannot place: the check fails, is logged, and is raised
    store.append("silver_load", rows(spark, store.schemas["silver_load"], [("ZZ", at("2025-01-04"), 60, 9.0, 9.0, None, None, None)]))
    with pytest.raises(RuntimeError, match="9.000 MWh"):
        pipeline.load_gold(store, reference.country(spark), reference.area(spark), reference.production_type(spark), "2025-01-07 07:00:00")
    assert found(store.read("gold_run_log"), "status") == [("FAILED",), ("OK",), ("OK",)]


def test_seeding_leaves_switches_alone(spark, tmp_path):
    store = pipeline.lake(spark, str(tmp_path / "lake"))
    assert sum(c.inserted for c in pipeline.seed_reference(store).values()) == 12 + 20 + 54 + 40 + 21 + 23
    switched = store.read("country").withColumn("is_active", F.lit(True)).withColumn(
        "country_name", F.when(F.col("country_code") == "NL", "Holland").otherwise(F.col("country_name")))
    store.overwrite("country", switched)
    again = pipeline.seed_reference(store)
    assert tuple(again["country"]) == (0, 1, 0) and not any(any(c) for n, c in again.items() if n != "country")
    assert store.read("country").where("is_active").count() == 12
    assert store.read("country").where("country_name = 'Holland'").isEmpty()


def test_calendar_rules():
    assert pipeline.full_scan_due("2025-01-05") and not pipeline.full_scan_due("2025-01-06")
    assert pipeline.monthly_branch_due("2025-02-01") and not pipeline.monthly_branch_due("2025-02-02")


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    store = Lake(spark, str(tmp_path / "lake"), {"flat": describe("a int !\nb string")})
    store.overwrite("flat", spark.createDataFrame([(1, "x")], "a int, b string"))
    bad = spark.createDataFrame([(2, "y"), (None, "z")], "a int, b string")
    with pytest.raises(Exception, match="must not be NULL"):
        store.overwrite("flat", bad)
    assert found(store.read("flat")) == [(1, "x")]
    # a crash between the two renames: the next read puts the table back
    (tmp_path / "lake" / "flat").rename(tmp_path / "lake" / "flat.old")
    assert found(store.read("flat")) == [(1, "x")]
    store.overwrite("flat", store.read("flat").unionByName(spark.createDataFrame([(3, "w")], "a int, b string")))
    assert found(store.read("flat")) == [(1, "x"), (3, "w")]
    assert sorted(p.name for p in (tmp_path / "lake").iterdir()) == ["flat"]


def test_no_staged_folder_is_left(spark, tmp_path, monkeypatch):
    from voltframe.operators import tables

    made = []
    monkeypatch.setattr(tables, "new_folder", lambda s, label: made.append(str(tmp_path / f"{label}-{len(made)}")) or made[-1])
    store = Lake(spark, str(tmp_path / "lake"), {"daily": describe("date_key int !\nk string\nn bigint")}, {"daily": Day()})
    rows_of = lambda *r: spark.createDataFrame(list(r), "date_key int, k string, n bigint")
    store.append("daily", rows_of((20240101, "a", 1), (20240102, "a", 1), (20240103, "a", 1)))
    store.upsert("daily", rows_of((20240102, "a", 5)), ["date_key", "k"])
    store.replace_window("daily", rows_of((20240103, "b", 2)), 20240102)
    assert found(store.read("daily")) == [("a", 1, 20240101), ("b", 2, 20240103)] or found(store.read("daily"), "date_key", "k", "n") == [
        (20240101, "a", 1), (20240103, "b", 2)]
    assert made and not any(Path(m).exists() for m in made)


def test_buckets_without_new_rows_keep_their_files(spark, tmp_path):
    store = Lake(spark, str(tmp_path / "lake"), {"state": describe("k bigint\nv bigint")}, {"state": Day("bucket", of=("k",), buckets=16)})
    store.upsert("state", spark.range(200).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("v")), ["k"])
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "lake" / "state").rglob("*.parquet")}
    before = files()
    store.upsert("state", spark.createDataFrame([(7, 1)], "k bigint, v bigint"), ["k"])
    after = files()
    assert store.read("state").where("v = 1").count() == 1 and store.read("state").count() == 200
    assert len({p.parent for p in before} - {p.parent for p in before if after.get(p) == before[p]}) == 1


def test_thresholds_calendar_and_star_of_the_daily_job(spark, job, tmp_path):
    from voltframe.plans.measures import evaluate

    raw, store = job
    put(raw, "kpi.csv", "country_code,carbon_intensity_alert_gco2e_per_kwh,price_spike_alert_eur_per_mwh,renewable_share_target_pct,valid_from,owner,note\nnl,300,200,70,2025-01-01,me,n\n")
    pipeline.run(store, str(raw), reference.country(spark), reference.area(spark), reference.production_type(spark),
                 reference.weather_location(spark), "2025-01-05 06:00:00", thresholds_path=str(raw / "kpi.csv"), run_optimize=True)
    got = evaluate(pipeline.star(store), ["renewable_target", "renewable_gap", "carbon_alert_level", "renewable_gap_pp"], ["country_code"]).where("country_code = 'NL'").first()
    assert all(got[c] is not None for c in ("renewable_target", "renewable_gap", "carbon_alert_level", "renewable_gap_pp"))
    assert store.read("dim_hour").count() == 24 and store.read("dim_date").where("date_key = 20250101").count() == 1


def test_completeness_opens_recent_days_only(spark, tmp_path):
    store = pipeline.lake(spark, str(tmp_path / "lake"))
    store.append("silver_load", rows(spark, store.schemas["silver_load"], [("NL", at(f"2025-01-{d:02d}"), 60, 9.0, 9.0, None, None, None) for d in (1, 20)]))
    plan = store.read("silver_load", pipeline._day("2025-01-22", 7)[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day_key" in plan and ">= 20250115" in plan
    assert store.read("silver_load", days=[20250101]).count() == 1
