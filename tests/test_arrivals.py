"""Raw files by list and as streams, malformed texts, late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import at, clock, found
from test_sources import LOG, document, point, weather_file
from voltframe.plans import pipeline, silver
from voltframe.sources import files, json_records, reference, weather_json
from voltframe.streaming import documents as stream
from voltframe.streaming import events as streams

EVENT = "id int, ts timestamp, k string, v int"


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def log_rows(store, frame, *entries):
    store.append("ctl_ingest_log", frame(store.schemas["ctl_ingest_log"].simpleString()[7:-1].replace(":", " "), [
        ("r", source, dataset, area, at("2025-01-01"), at("2025-01-02"), "ok", path, 100, 1, None, at(seen)) for source, dataset, area, path, seen in entries]))


def test_a_processed_file_in_a_touched_folder_is_never_opened(spark, frame, tmp_path):
    raw, store = tmp_path / "raw", pipeline.lake(spark, str(tmp_path / "lake"))
    put(raw / "actual_load" / "NL", "old.xml", "x" * 50_000)
    put(raw / "actual_load" / "NL", "new.xml", document(point(1, 5), "A01"))
    put(raw / "actual_load" / "NL", "unlisted.xml", "y" * 50_000)
    log_rows(store, frame, ("grid", "actual_load", "NL", "actual_load/NL/old.xml", "2025-01-02"), ("grid", "actual_load", "NL", "actual_load/NL/new.xml", "2025-01-04"))
    store.append("ctl_silver_state", frame("dataset string, processed_until_ingested_at timestamp, updated_at_utc timestamp", [("actual_load", at("2025-01-03"), at("2025-01-03"))]))
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 10_000)     # reading either large file would raise
    try:
        assert silver.load_grid(store, str(raw), "actual_load", "2025-01-05") == {"inserted": 1, "updated": 0, "rejected": 0}
        with pytest.raises(Exception, match="(?i)length"):
            silver.load_grid(store, str(raw), "actual_load", "2025-01-05", mode="full")
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)
    assert found(store.read("silver_load"), "load_mw") == [(5.0,)]


def test_a_listed_file_that_is_gone_stops_the_job(spark, frame, tmp_path):
    (tmp_path / "x").mkdir()
    todo = frame(LOG, [("actual_load", "NL", "x/missing.xml", at("2025-01-02"))])
    with pytest.raises(Exception, match="(?i)not.*exist|PATH_NOT_FOUND"):
        files.documents(spark, str(tmp_path), todo).collect()


def test_scan_groups_are_bounded(spark, frame):
    listed = frame("file_path string, bytes bigint", [(f"a/{i}", 10 * (i % 7) if i % 11 else None) for i in range(500)])
    cut = files.grouped(listed, most_bytes=600, most_files=20).withColumn("b", F.coalesce("bytes", F.lit(files.UNKNOWN_BYTES)))
    groups = cut.groupBy("scan_group").agg(F.count("*").alias("n"), F.sum("b").alias("b"), F.max("b").alias("most")).collect()
    assert sum(g["n"] for g in groups) == 500 and len(groups) > 25
    assert all(g["n"] <= 20 and g["b"] - g["most"] <= 600 for g in groups)
    one = files.grouped(listed.drop("bytes"))
    assert one.select("scan_group").distinct().count() == 1 and files.grouped(listed.limit(0)).isEmpty()


def test_signs_in_names_are_taken_literally(spark, frame, tmp_path):
    put(tmp_path / "raw" / "a[1]", "x{2}.xml", document(point(1, 7)))
    put(tmp_path / "raw" / "a1", "x2.xml", document(point(1, 8)))
    docs = files.documents(spark, str(tmp_path / "raw"), frame(LOG, [("actual_load", "NL", "a[1]/x{2}.xml", at("2025-01-02"))]))
    assert [("<quantity>7" in r["text"], r["file_path"]) for r in docs.collect()] == [(True, "a[1]/x{2}.xml")]


def test_weather_of_listed_files_only(spark, frame, tmp_path):
    (tmp_path / "w").mkdir()
    weather_file(tmp_path / "w" / "a.json", ["2025-01-01T00:00"], "[1.5]")
    put(tmp_path / "w", "b.json", "{not json")
    log = frame(LOG, [("weather_hourly_archive", "NL-AMS", "w/a.json", at("2025-01-02"))])
    parsed = weather_json.parse(weather_json.scan(spark, str(tmp_path), log), log, reference.weather_location(spark))
    assert found(parsed, "temperature_2m", "_source_file") == [(1.5, "w/a.json")]


# ---- streams of documents --------------------------------------------------------------


def state_of(store):
    return clock(store.read("silver_load").drop("_silver_updated_at", "_bronze_ingested_at")), found(store.read("dq_quarantine").drop("detected_at"))


def test_documents_stream_into_silver_once(spark, tmp_path, monkeypatch):
    raw, store, check = tmp_path / "raw", pipeline.lake(spark, str(tmp_path / "lake")), str(tmp_path / "check")
    put(raw / "actual_load" / "NL" / "2025", "a.xml", document(point(1, 5) + point(2, 6), "A01"))
    put(raw / "actual_load" / "NL" / "2025", "bad.xml", document(point(1, "abc"), "A01"))
    put(raw / "crossborder_flow" / "DE_to_NL", "f.xml", document(point(1, 12), "A01"))
    put(raw / "unknown" / "NL", "u.xml", "?")
    stream.grid_to_silver(store, str(raw), check, "2025-01-05", most_files=1)
    assert found(store.read("silver_load"), "load_mw") == [(5.0,), (6.0,)]
    assert found(store.read("silver_flow"), "from_area_code", "to_area_code") == [("DE", "NL")]
    first = state_of(store)
    assert [r[3] for r in first[1]] == ["value is not a number"]

    # a replay of everything by another checkpoint changes nothing
    stream.grid_to_silver(store, str(raw), str(tmp_path / "other"), "2025-01-06")
    assert state_of(store) == first

    # a batch that fails after its merge is done again by the next start
    put(raw / "actual_load" / "NL" / "2025", "c.xml", document(point(1, 9), "A01"))
    merge = silver.merge_intervals

    def merged_then_lost(*a, **k):
        merge(*a, **k)
        raise RuntimeError("lost")

    monkeypatch.setattr(silver, "merge_intervals", merged_then_lost)
    with pytest.raises(Exception, match="lost"):
        stream.grid_to_silver(store, str(raw), check, "2025-01-07")
    monkeypatch.setattr(silver, "merge_intervals", merge)
    assert found(store.read("silver_load"), "load_mw") == [(6.0,), (9.0,)]
    after = state_of(store)
    stream.grid_to_silver(store, str(raw), check, "2025-01-07")
    stream.grid_to_silver(store, str(raw), check, "2025-01-07")
    assert state_of(store) == after


def test_an_older_file_never_replaces_a_newer_value(spark, frame, tmp_path):
    import os

    raw, store = tmp_path / "raw", pipeline.lake(spark, str(tmp_path / "lake"))
    put(raw / "actual_load" / "NL", "new.xml", document(point(1, 9), "A01"))
    stream.grid_to_silver(store, str(raw), str(tmp_path / "check"), "2025-01-05")
    put(raw / "actual_load" / "NL", "old.xml", document(point(1, 5), "A01"))
    os.utime(raw / "actual_load" / "NL" / "old.xml", (1_600_000_000, 1_600_000_000))
    stream.grid_to_silver(store, str(raw), str(tmp_path / "other"), "2025-01-06")
    assert found(store.read("silver_load"), "load_mw") == [(9.0,)]


def test_holidays_stream_with_malformed_lines(spark, tmp_path):
    raw, store = tmp_path / "raw", pipeline.lake(spark, str(tmp_path / "lake"))
    good = '{"countryCode":"NL","date":"2025-01-01","localName":"N","name":"New Year"}'
    put(raw / "h", "a.json", f"{good}\n{good[:20]}\n")
    for run in range(2):
        stream.holidays_to_silver(store, str(raw), str(tmp_path / f"check{run}"), "2025-01-05")
    assert found(store.read("silver_holiday"), "country_code", "name") == [("NL", "New Year")]
    assert found(store.read("dq_quarantine"), "rule_name", "details") == [("malformed_json", good[:20])]


# ---- malformed JSON --------------------------------------------------------------------

GOOD = '{"countryCode":"NL","date":"2025-01-01","name":"N"}'


@pytest.mark.parametrize("text,good,bad", [
    (GOOD, 1, []), (f"[{GOOD},{GOOD}]", 2, []), (f"{GOOD}\n{GOOD}", 2, []), (f"﻿[{GOOD}]", 1, []), ("", 0, []), (" \n ", 0, []), ("[]", 0, []),
    ('{"x":{"a":1}\n,"countryCode":"NL"}', 1, []), (f"[{GOOD},", 0, [f"[{GOOD},"]), (f"{GOOD} trailing", 0, [f"{GOOD} trailing"]),
    (f"{GOOD}\n{GOOD[:9]}\n{GOOD}", 2, [GOOD[:9]]), (f"[{GOOD}]\n[{GOOD}", 1, [f"[{GOOD}"]), ("no json", 0, ["no json"]), ('{"countryCode":5}', 1, [])])
def test_two_stages(frame, text, good, bad):
    read = json_records.parsed(frame("source_file string, text string", [("f", text)]), "text", json_records.HOLIDAY).collect()
    assert sum(r["_malformed"] is None for r in read) == good
    assert [r["_malformed"] for r in read if r["_malformed"] is not None] == bad


def test_a_null_text_gives_nothing(frame):
    assert json_records.parsed(frame("source_file string, text string", [("f", None)]), "text", json_records.HOLIDAY).isEmpty()


# ---- late rows -------------------------------------------------------------------------


def test_late_rows_are_kept_and_merged(spark, frame, tmp_path):
    windows = streams.LateWindows(spark, str(tmp_path / "state"), "ts", "1 hour", "10 minutes", ["k"], {
        "n": (F.count(F.lit(1)), F.sum), "last": (F.max("id"), F.max)})
    batches = [frame(EVENT, [(1, at("2025-01-01 00:05"), "a", 1), (2, at("2025-01-01 03:00"), "a", 1)]),
               frame(EVENT, [(3, at("2025-01-01 00:06"), "a", 1), (4, at("2025-01-01 05:00"), "b", 1), (5, at("2025-01-01 02:30"), "a", 1)])]
    for i, b in enumerate(batches):
        windows.add(b, i)
    assert found(windows.late_rows(), "id") == [(3,)]
    want = [("2025-01-01 00:00", "a", 2, 3), ("2025-01-01 02:30", "a", 1, 5), ("2025-01-01 03:00", "a", 1, 2)]
    assert clock(windows.closed(), "window_start", "k", "n", "last") == want
    assert clock(windows.closed(with_late=False), "window_start", "n") == [("2025-01-01 00:00", 1), ("2025-01-01 02:30", 1), ("2025-01-01 03:00", 1)]
    assert windows.mark() == dt.datetime(2025, 1, 1, 4)
    windows.add(batches[1], 1)      # the batch is done again
    assert clock(windows.closed(), "window_start", "k", "n", "last") == want and windows.late_rows().count() == 1
