import codecs

import pytest

from helpers import at, clock, found
from voltframe.functions import scalars
from voltframe.plans import silver
from voltframe.sources import files, grid_xml, json_records, reference, thresholds, weather_json

START = "2025-01-01T00:00Z"


def point(position, value, tag="quantity"):
    return f"<Point><position>{position}</position><{tag}>{value}</{tag}></Point>"


def document(points, curve=None, end="2025-01-01T02:00Z", res="PT30M", start=START, extra=""):
    curve = f"<curveType>{curve}</curveType>" if curve else ""
    span = (f"<start>{start}</start>" if start else "") + f"<end>{end}</end>"
    return (f'<?xml version="1.0"?><GL_Document xmlns="urn:x">{"<TimeSeries>"}{extra}{curve}<Period><timeInterval>{span}</timeInterval>'
            f"<resolution>{res}</resolution>{points}</Period></TimeSeries></GL_Document>")


def parse(frame, text, dataset="actual_load"):
    return grid_xml.read_documents(frame("dataset string, area_key string, f string, text string", [(dataset, "NL", "f1", text)]))


def values(frame, text, dataset="actual_load"):
    read = parse(frame, text, dataset)
    assert read.first()["fault"] is None
    return [(t[11:], v) for t, v in clock(grid_xml.intervals(read, "area_key"), "ts_utc", "value")]


def fault(frame, text, dataset="actual_load"):
    read = parse(frame, text, dataset)
    assert grid_xml.intervals(read).isEmpty()
    return found(grid_xml.rejected(read, "silver_load", "f"), "rule_name", "details", "record_key")


@pytest.mark.parametrize("curve,expected", [
    ("A03", [("00:00", 5.0), ("00:30", 5.0), ("01:00", 7.0), ("01:30", 7.0)]),
    ("A01", [("00:00", 5.0), ("01:00", 7.0)]), (None, [("00:00", 5.0), ("01:00", 7.0)])])
def test_curves(frame, curve, expected):
    assert values(frame, document(point(1, 5) + point(3, 7), curve)) == expected


def test_curve_edges(frame):
    assert values(frame, document(point(2, 4), "A03")) == [("00:30", 4.0), ("01:00", 4.0), ("01:30", 4.0)]
    for curve in ("A01", "A03"):
        assert values(frame, document(point(5, 4), curve)) == []
    assert values(frame, document(point(2, 3) + point(2, 9))) == [("00:30", 9.0)]
    # a point without a value is a gap, filled like any other
    assert values(frame, document(point(1, 5) + "<Point><position>2</position></Point>", "A03"))[1] == ("00:30", 5.0)
    # out of order, and an end that is not a whole number of steps
    assert values(frame, document(point(3, 7) + point(1, 5), "A03", end="2025-01-01T01:45Z")) == [("00:00", 5.0), ("00:30", 5.0), ("01:00", 7.0)]


def test_price_tag_and_psr(frame):
    text = document(point(1, 42.5, "price.amount") + point(2, 1), "A01", res="PT1H")
    assert values(frame, text, "day_ahead_price") == [("00:00", 42.5)]
    out = '<outBiddingZone_Domain.mRID codingScheme="A01"></outBiddingZone_Domain.mRID>'
    psr = "<MktPSRType><psrType>B10</psrType></MktPSRType>"
    for extra, direction in [(psr, "generation"), (out + psr, "consumption")]:
        read = parse(frame, document(point(1, 1), extra=extra), "actual_generation")
        assert found(grid_xml.intervals(read), "psr_type_code", "direction") == [("B10", direction)]
    assert found(grid_xml.intervals(parse(frame, document(point(1, 1), extra=out))), "direction") == [(None,)]


def test_resolutions_may_change_inside_a_document(frame):
    text = document(point(1, 5), res="PT60M", end="2025-01-01T01:00Z").replace("</TimeSeries></GL_Document>", "") + (
        "<Period><timeInterval><start>2025-01-01T01:00Z</start><end>2025-01-01T01:30Z</end></timeInterval><resolution>PT15M</resolution>"
        + point(1, 6) + point(2, 7) + "</Period></TimeSeries></GL_Document>")
    got = clock(grid_xml.intervals(parse(frame, text)), "ts_utc", "resolution_minutes", "value")
    assert [(t[11:], r, v) for t, r, v in got] == [("00:00", 60, 5.0), ("01:00", 15, 6.0), ("01:15", 15, 7.0)]


@pytest.mark.parametrize("text,reason", [
    (document(point(1, 5) + point(2, "abc") + point(3, 1)), "value is not a number"),
    (document(point("x", 5)), "missing or unreadable position"),
    (document("<Point><quantity>5</quantity></Point>"), "missing or unreadable position"),
    (document(point(1, 5), res="P1D"), "unsupported resolution"),
    (document(point(1, 5), start=None), "missing or unreadable start or end"),
    (document(point(1, 5))[:-20], "malformed XML"), ("", "malformed XML"), ("no xml", "malformed XML"),
])
def test_a_fault_rejects_the_whole_document(frame, text, reason):
    assert fault(frame, text) == [("xml_parse_error", reason, "f1")]


def test_document_without_series_is_sound_and_empty(frame):
    assert values(frame, "<Ack><reason>none</reason></Ack>") == []


def test_prefixed_namespaces(frame):
    text = document(point(1, 5)).replace("<TimeSeries>", "<ns:TimeSeries>").replace("</TimeSeries>", "</ns:TimeSeries>")
    assert values(frame, text.replace("xmlns=", "xmlns:ns='urn:y' xmlns=")) == [("00:00", 5.0)]


def test_prefixes_are_part_of_the_markup_only(frame):
    """Ends must name the tag they close, any letter may begin a prefix, and text is no tag."""
    text = document(point(1, 5))
    assert fault(frame, text.replace("<Point>", "<a:Point>").replace("</Point>", "</b:Point>")) == [("xml_parse_error", "malformed XML", "f1")]
    assert values(frame, text.replace("Point>", "\u00e9:Point>")) == [("00:00", 5.0)]
    psr = "<MktPSRType><psrType><![CDATA[<q:B10]]></psrType></MktPSRType>"
    assert found(grid_xml.intervals(parse(frame, document(point(1, 1), extra=psr))), "psr_type_code") == [("<q:B10",)]


def test_each_instant_is_read_once(frame):
    plan = grid_xml.intervals(parse(frame, "<a/>"), "f", faults=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(scalars.ISO_TIMESTAMP) == 2 and plan.count("from_xml") == 1       # a start and an end


def test_the_first_fault_in_order_is_named(frame):
    """Whatever the place of the faults in the document."""
    def series(points, **changed):
        return "<TimeSeries>" + document(points, **changed).split("<TimeSeries>")[1].split("</TimeSeries>")[0] + "</TimeSeries>"

    faulty = [(series(point(1, 5), start="x"), "missing or unreadable start or end"), (series(point(1, 5), res="P1D"), "unsupported resolution"),
              (series(point(1, 5) + point(2, "NaN")), "value is not a number"), (series(point("x", 5)), "missing or unreadable position")]
    docs = [("actual_load", reason, "<a>" + series(point(1, 1)) + "".join(t for t, _ in reversed(faulty[k:])) + "</a>") for k, (_, reason) in enumerate(faulty)]
    read = grid_xml.read_documents(frame("dataset string, want string, text string", docs))
    assert found(read.where("fault <=> want"), "want") == sorted((w,) for _, w, _ in docs)


def test_scan_joins_the_audit_log(spark, frame, tmp_path):
    folder = tmp_path / "actual_load" / "NL"
    folder.mkdir(parents=True)
    (folder / "a.xml").write_text(document(point(1, 5)))
    (folder / "b.xml").write_text(document(point(1, 6)))
    todo = frame("dataset string, area_key string, file_path string, ingested_at_utc timestamp", [("actual_load", "NL", "actual_load/NL/b.xml", at("2025-01-02"))])
    docs = files.documents(spark, str(tmp_path), todo, "*.xml", modified_after="2000-01-01")
    assert found(grid_xml.intervals(grid_xml.read_documents(docs)), "value") == [(6.0,)]
    assert files.documents(spark, str(tmp_path), todo, "*.xml", modified_after="2999-01-01").isEmpty()


def test_tolerant_json(spark, tmp_path):
    one = '{"countryCode":"NL","date":"2025-01-01","localName":"Nieuwjaar","name":"New Year","global":false}'
    bare = '{"countryCode":"NL","date":"2025-04-27","localName":"K","name":"King"}'
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_bytes(codecs.BOM_UTF8 + f"[{one},\n{bare}]".encode())
    (tmp_path / "b.json").write_text(one.replace("NL", "DE"))
    (tmp_path / "sub" / "c.json").write_bytes(codecs.BOM_UTF8 + f"{one.replace('NL', 'FR')}\r\n\r\n{bare.replace('NL', 'FR')}\n".encode())
    (tmp_path / "d.json").write_text('[{"countryCode":"IT","date":"2025-01-01"},{"countryCode":"IT","date":"01.02.2025","name":"x"}]')
    (tmp_path / "e.json").write_text('{\n "countryCode": "PL",\n "date": "2025-01-01",\n "name": "P"\n}')
    (tmp_path / "ignored.txt").write_text("x")
    good, bad = json_records.clean_holidays(json_records.holiday_files(spark, str(tmp_path)))
    assert found(good, "country_code", "name", "is_nationwide") == [
        ("DE", "New Year", False), ("FR", "King", True), ("FR", "New Year", False), ("NL", "King", True), ("NL", "New Year", False), ("PL", "P", True)]
    assert found(bad, "record_key", "rule_name") == [("IT|01.02.2025|x", "missing_required_field"), ("IT|2025-01-01", "missing_required_field")]


def test_broken_json_is_quarantined(frame):
    df = frame("source_file string, text string", [("f", '[{"countryCode":"NL"')])
    assert json_records.records(df, "text", json_records.HOLIDAY).isEmpty()
    bad = json_records.malformed(json_records.parsed(df, "text", json_records.HOLIDAY), "silver_holiday", "source_file", "2025-01-01")
    assert found(bad, "rule_name", "details", "source_file") == [("malformed_json", '[{"countryCode":"NL"', "f")]


def weather_file(path, times, temperature, zone="GMT"):
    empty = ",".join(["null"] * len(times))
    others = "".join(f',"{v}":[{empty}]' for v in weather_json.VARIABLES[1:])
    hours = ",".join(f'"{t}"' for t in times)
    path.write_text(f'{{"latitude":1.0,"timezone":"{zone}","hourly":{{\n"time":[{hours}],"temperature_2m":{temperature}{others}}}}}')


LOG = "dataset string, area_key string, file_path string, ingested_at_utc timestamp"


def test_weather_files(spark, frame, tmp_path):
    weather_file(tmp_path / "arch.json", ["2025-01-01T00:00", "2025-01-01T01:00", "2025-01-01T02:00"], "[1.5,null,2]")
    weather_file(tmp_path / "fc.json", ["2025-01-01T00:00", "2025-01-01T03:00"], "[9.5,8]", "UTC")
    log = frame(LOG, [("weather_hourly_archive", "NL-AMS", "x/arch.json", at("2025-01-02")), ("weather_hourly_forecast", "NL-AMS", "x/fc.json", at("2025-01-03"))])
    parsed = weather_json.parse(weather_json.read(spark, str(tmp_path)), log, reference.weather_location(spark))
    best = silver.best_weather(parsed)
    assert [(t[11:], v, s, c) for t, v, s, c in clock(best, "ts_utc", "temperature_2m", "data_source", "country_code")] == [
        ("00:00", 1.5, "archive", "NL"), ("02:00", 2.0, "archive", "NL"), ("03:00", 8.0, "forecast", "NL")]


def test_weather_guards(spark, frame, tmp_path):
    weather_file(tmp_path / "a.json", ["2025-01-01T00:00"], "[1]", "Europe/Rome")
    log = frame(LOG, [("weather_hourly_archive", "XX-YYY", "x/a.json", at("2025-01-02"))])
    with pytest.raises(Exception, match="Europe/Rome"):
        weather_json.parse(weather_json.read(spark, str(tmp_path)), log, reference.weather_location(spark)).collect()
    weather_file(tmp_path / "a.json", ["2025-01-01T00:00"], "[1]")
    with pytest.raises(Exception, match="XX-YYY"):
        weather_json.parse(weather_json.read(spark, str(tmp_path)), log, reference.weather_location(spark)).collect()


def test_thresholds(spark, tmp_path):
    (tmp_path / "kpi.csv").write_text("country_code,carbon_intensity_alert_gco2e_per_kwh,price_spike_alert_eur_per_mwh,renewable_share_target_pct,valid_from,owner,note\n"
                                      'nl,350,200,70,2024-01-01,"Team, energy\n')
    row = thresholds.read(spark, str(tmp_path / "kpi.csv")).first()
    assert (row["country_code"], row["renewable_share_target_pct"], str(row["valid_from"]), row["owner"]) == ("NL", 70.0, "2024-01-01", '"Team')


def test_documents_are_judged_without_a_shuffle(frame):
    plan = grid_xml.intervals(parse(frame, "<a/>"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
