"""File formats: grid XML, weather JSON, tolerant JSON, CSV. Documents are written from the given
tables one per row, so parsing grows with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltframe.functions.scalars import exact_sum, iso_minutes, split_pair
from voltframe.operators import series
from voltframe.plans import silver
from voltframe.registry import views
from voltframe.registry.base import plain, query, rounded, table
from voltframe.session import new_folder
from voltframe.sources import files, grid_xml, json_records, thresholds, weather_json

# ---- grid documents: every event becomes a two-hour document -------------------------------


def _spread(df, key):
    """Spread narrow rows over the session's shuffle partitions before text is built from them,
    as separate files would be; one row group would otherwise be parsed by one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _documents(spark, sf):
    """Clicks repeat values (A03), views list them (A01), signups list a position twice, purchases
    name no curve and use a namespace prefix, errors carry a value that is no number."""
    e = _spread(table(spark, sf, "events"), "event_id").select(
        "event_id", "event_type", "value", F.col("user_id").alias("area"),
        F.date_trunc("hour", "ts").cast("timestamp").alias("start"), F.col("ts").cast("timestamp").alias("ingested_at_utc"))

    def iso(c):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm'Z'")

    def point(position, value):
        return F.concat(F.lit(f"<Point><position>{position}</position><quantity>"), value, F.lit("</quantity></Point>"))

    v = F.col("value").cast("string")
    kind = F.col("event_type")
    points = (F.when(kind == "click", F.concat(point(1, v), point(3, F.lit("7"))))
               .when(kind == "view", F.concat(point(1, v), point(3, F.lit("7")), point(5, F.lit("1"))))
               .when(kind == "signup", F.concat(point(2, F.lit("3")), point(2, v)))
               .when(kind == "error", F.concat(point(1, v), point(2, F.lit("abc"))))
               .otherwise(F.concat(point(4, v), point(1, F.lit("9.5")))))
    curve = (F.when(kind.isin("click", "signup"), "<curveType>A03</curveType>").when(kind == "view", "<curveType>A01</curveType>").otherwise(""))
    domain = F.when(kind == "view", '<outBiddingZone_Domain.mRID codingScheme="A01">X</outBiddingZone_Domain.mRID>').otherwise("")
    body = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><Doc xmlns="urn:grid:1" xmlns:n="urn:grid:2"><mRID>'), F.col("event_id").cast("string"),
        F.lit("</mRID><TimeSeries>"), domain, F.lit("<MktPSRType><psrType>"), kind, F.lit("</psrType></MktPSRType>"), curve,
        F.lit("<Period><timeInterval><start>"), iso("start"), F.lit("</start><end>"), iso(F.col("start") + F.expr("INTERVAL 2 HOUR")),
        F.lit("</end></timeInterval><resolution>PT30M</resolution>"), points, F.lit("</Period></TimeSeries></Doc>"))
    prefixed = F.regexp_replace(body, r"<(/?)(TimeSeries|Period|Point)>", "<$1n:$2>")
    return e.select("event_id", F.lit("actual_generation").alias("dataset"), F.concat(F.lit("A"), F.col("area").cast("string")).alias("area_key"),
                    F.concat(F.lit("doc-"), F.col("event_id").cast("string")).alias("file_path"), "ingested_at_utc",
                    F.when(kind == "purchase", prefixed).otherwise(body).alias("text"))


_SLOTS = """
WITH slot(event_type, position, first) AS (VALUES ('click', 1, true), ('click', 2, true), ('click', 3, false), ('click', 4, false),
  ('view', 1, true), ('view', 3, false), ('signup', 2, true), ('signup', 3, true), ('signup', 4, true), ('purchase', 1, false), ('purchase', 4, true)),
x AS (SELECT event_id, e.event_type AS psr_type_code, CASE WHEN e.event_type = 'view' THEN 'consumption' ELSE 'generation' END AS direction,
  'A' || user_id AS area_key, date_trunc('hour', ts) + INTERVAL 30 MINUTE * (position - 1) AS ts_utc, ts AS ingested,
  CASE WHEN first THEN value WHEN e.event_type = 'purchase' THEN 9.5 ELSE 7 END AS value
  FROM events e JOIN slot s ON s.event_type = e.event_type)
"""


@query("xml_intervals", _SLOTS + """
SELECT event_id, area_key, psr_type_code, direction, ts_utc, CAST(30 AS BIGINT) AS resolution_minutes, CAST(value AS DOUBLE) AS value FROM x""")
def xml_intervals(spark, sf):
    parsed = grid_xml.read_documents(_documents(spark, sf))
    return plain(grid_xml.intervals(parsed, "event_id", "area_key").drop("dataset"))


@query("xml_quarantine", """
SELECT 'silver_generation' AS table_name, 'doc-' || event_id AS record_key, 'xml_parse_error' AS rule_name, 'value is not a number' AS details,
  'doc-' || event_id AS source_file, TIMESTAMP '2024-02-01' AS detected_at FROM events WHERE event_type = 'error'""")
def xml_quarantine(spark, sf):
    parsed = grid_xml.read_documents(_documents(spark, sf))
    return plain(grid_xml.rejected(parsed, "silver_generation", "file_path", "2024-02-01"))


@query("xml_to_silver", _SLOTS + """
SELECT area_key AS area_code, ts_utc, CAST(30 AS BIGINT) AS resolution_minutes, psr_type_code, direction, CAST(value AS DOUBLE) AS power_mw,
  round(value * 0.5, 6) AS energy_mwh,
  CASE WHEN direction = 'generation' AND psr_type_code <> 'signup' THEN round(value * 0.5 * CASE psr_type_code WHEN 'click' THEN 48 ELSE 12 END, 6) END AS co2e_kg
FROM (SELECT *, row_number() OVER (PARTITION BY area_key, ts_utc, psr_type_code, direction ORDER BY ingested DESC, 'doc-' || event_id DESC) AS k FROM x) WHERE k = 1""")
def xml_to_silver(spark, sf):
    """Documents to generation rows: parse, keep the latest ingest, attach the factor."""
    parsed = grid_xml.read_documents(_documents(spark, sf))
    found = (grid_xml.intervals(parsed, "area_key", "file_path", "ingested_at_utc")
             .withColumnsRenamed({"file_path": "_source_file", "ingested_at_utc": "_bronze_ingested_at"}))
    factors = views.factors(spark).where("valid_to IS NULL").select("psr_type_code", "lifecycle_gco2e_per_kwh")
    rows = silver.shape("actual_generation", silver.latest_intervals(found), factors)
    out = rows.select("area_code", "ts_utc", "resolution_minutes", "psr_type_code", "direction", "power_mw", "energy_mwh", "co2e_kg")
    return plain(rounded(out, "energy_mwh", "co2e_kg"))


@query("flow_pair_split", """
SELECT 'A' || s_nationkey AS from_area_code, 'A' || c_nationkey AS to_area_code, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 4 AS energy_mwh
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2""")
def flow_pair_split(spark, sf):
    flows = views.flows(spark, sf).select(F.concat_ws(">", "from_area_code", "to_area_code").alias("area_key"),
                                          F.col("flow_mw").alias("value"), F.lit(15).alias("resolution_minutes"))
    shaped = silver.shape("crossborder_flow", flows)
    return plain(shaped.groupBy("from_area_code", "to_area_code").agg(exact_sum("energy_mwh").alias("energy_mwh")))


# ---- JSON ------------------------------------------------------------------------------


@query("weather_json_flatten", """
SELECT event_id, date_trunc('hour', ts) + INTERVAL 1 HOUR * i AS ts_utc, CASE i WHEN 0 THEN value WHEN 2 THEN value + 1 END AS temperature_2m,
  CASE i WHEN 0 THEN 5 END AS wind_speed_100m, CASE WHEN i = 3 THEN 1.5 END AS precipitation
FROM events, range(0, 4) r(i) WHERE i <> 1""".replace("CASE i WHEN 0 THEN 5 END", "CAST(CASE i WHEN 0 THEN 5 END AS DOUBLE)").replace(
    "CASE WHEN i = 3 THEN 1.5 END", "CAST(CASE WHEN i = 3 THEN 1.5 END AS DOUBLE)").replace(
    "CASE i WHEN 0 THEN value WHEN 2 THEN value + 1 END", "round(CASE i WHEN 0 THEN value WHEN 2 THEN value + 1 END, 6)"))
def weather_json_flatten(spark, sf):
    """One document of four hours per event; the second hour has no value and is dropped."""
    hour = F.date_trunc("hour", "ts").cast("timestamp")
    times = F.concat_ws('","', *[F.date_format(hour + F.expr(f"INTERVAL {i} HOUR"), "yyyy-MM-dd'T'HH:mm") for i in range(4)])
    v = F.col("value")
    text = F.concat(F.lit('{"timezone":"GMT","hourly":{"time":["'), times, F.lit('"],"temperature_2m":['), v.cast("string"), F.lit(",null,"),
                    (v + 1).cast("string"), F.lit('],"wind_speed_100m":[5.0],"precipitation":[null,null,null,1.5]}}'))
    docs = _spread(table(spark, sf, "events"), "event_id").select("event_id", F.from_json(text, weather_json.SCHEMA).alias("doc")).select("event_id", "doc.*")
    flat = weather_json.flatten(docs, "event_id")
    return plain(rounded(flat.select("event_id", "ts_utc", "temperature_2m", "wind_speed_100m", "precipitation"), "temperature_2m"))


@query("weather_best_reading", views.ctes("wx") + """
SELECT loc AS location_code, country_code, h AS ts_utc, src AS data_source, lpad(CAST(event_id AS VARCHAR), 12, '0') AS _source_file FROM wx""")
def weather_best_reading(spark, sf):
    best = silver.best_weather(views.weather(spark, sf))
    return plain(best.select("location_code", "country_code", "ts_utc", "data_source", "_source_file"))


@query("json_arrays_flatten", """
SELECT vec_id, CAST(i AS BIGINT) AS i, CAST(embedding[i + 1] AS DOUBLE) AS value FROM embeddings, range(0, 2000) r(i) WHERE i < len(embedding)""")
def json_arrays_flatten(spark, sf):
    e = table(spark, sf, "embeddings")
    index = F.sequence(F.lit(0), F.size("embedding") - 1)
    zipped = F.arrays_zip(index.alias("i"), F.col("embedding").cast("array<double>").alias("value"))
    return plain(e.where(F.size("embedding") > 0).select("vec_id", F.inline(zipped)))


@query("json_props", """
SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum FROM events GROUP BY 1""")
def json_props(spark, sf):
    e = table(spark, sf, "events").select("event_type", F.from_json("props", "k bigint").alias("p"))
    return plain(e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("p.k").alias("k_sum")))


def _holiday_texts(spark, sf):
    """Orders as holiday files: with BOM and array, as an object, as lines, and without a name."""
    o = _spread(table(spark, sf, "orders"), "o_orderkey").select(
        "o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    key = F.col("o_orderkey").cast("string")

    def record(name, extra=""):
        return F.concat(F.lit('{"countryCode":"C'), key, F.lit('","date":"'), F.col("day"), F.lit('","localName":"L"'), F.lit(extra), name, F.lit("}"))

    first, second = record(F.lit(',"name":"N1"')), record(F.lit(',"name":"N2"'), ',"global":false')
    urgent, high, medium, low = [F.col("o_orderpriority") == p for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")]
    text = (F.when(urgent, F.concat(F.lit("﻿["), first, F.lit(",\n"), second, F.lit("]")))
             .when(high, first).when(medium, F.concat(F.lit("﻿"), first, F.lit("\r\n"), second, F.lit("\n")))
             .when(low, record(F.lit(""))).otherwise(F.concat(F.lit("["), first, F.lit(","), first, F.lit("]"))))
    return o.select(F.concat(F.lit("f"), key).alias("source_file"), text.alias("text"))


_HOLIDAYS = """
WITH n(p, name, nationwide) AS (VALUES ('1-URGENT', 'N1', true), ('1-URGENT', 'N2', false), ('2-HIGH', 'N1', true),
  ('3-MEDIUM', 'N1', true), ('3-MEDIUM', 'N2', false), ('4-NOT SPECIFIED', 'N1', true))
"""


@query("json_tolerant", _HOLIDAYS + """
SELECT 'C' || o_orderkey AS country_code, strftime(o_orderdate, '%Y-%m-%d') AS holiday_date, 'L' AS local_name, name, nationwide AS is_nationwide,
  'f' || o_orderkey AS _source_file FROM orders JOIN n ON n.p = o_orderpriority""")
def json_tolerant(spark, sf):
    good, _ = json_records.clean_holidays(json_records.holidays(json_records.records(_holiday_texts(spark, sf), "text", json_records.HOLIDAY)))
    return plain(good)


@query("json_quarantine", """
SELECT 'silver_holiday' AS table_name, 'C' || o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d') AS record_key, 'missing_required_field' AS rule_name,
  'country_code, date or name is null' AS details, 'f' || o_orderkey AS source_file, TIMESTAMP '2024-02-01' AS detected_at FROM orders WHERE o_orderpriority = '5-LOW'""")
def json_quarantine(spark, sf):
    records = json_records.records(_holiday_texts(spark, sf), "text", json_records.HOLIDAY)
    return plain(json_records.clean_holidays(json_records.holidays(records), "2024-02-01")[1])


# ---- CSV and raw folders ---------------------------------------------------------------


@query("csv_thresholds", """
SELECT 'C' || c_custkey AS country_code, round(c_acctbal, 2) AS carbon_intensity_alert_gco2e_per_kwh, CAST(c_nationkey AS DOUBLE) AS price_spike_alert_eur_per_mwh,
  CAST(70 AS DOUBLE) AS renewable_share_target_pct, '2024-01-01' AS valid_from, '"' || c_mktsegment || '"' AS owner, c_name AS note FROM customer""")
def csv_thresholds(spark, sf):
    """Customers written as a threshold file and read back; quotes are ordinary text."""
    folder = new_folder(spark, "thresholds")
    c = table(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("country_code"), F.round("c_acctbal", 2).alias("carbon_intensity_alert_gco2e_per_kwh"),
        F.col("c_nationkey").alias("price_spike_alert_eur_per_mwh"), F.lit(70.0).alias("renewable_share_target_pct"), F.lit("2024-01-01").alias("valid_from"),
        F.concat(F.lit('"'), "c_mktsegment", F.lit('"')).alias("owner"), F.col("c_name").alias("note"))
    c.write.option("header", True).option("quote", "").csv(folder)
    return plain(thresholds.read(spark, folder))


@query("raw_layout", """
SELECT event_id, event_type || '/A' || user_id || '_to_B/' || strftime(ts, '%Y/%m') || '/' || event_type || '__A' || user_id || '_to_B__' ||
  strftime(date_trunc('month', ts), '%Y%m01T0000') || '_' || strftime(date_trunc('month', ts) + INTERVAL 1 MONTH, '%Y%m01T0000') || '__run1.xml' AS path FROM events""")
def raw_layout(spark, sf):
    month = F.date_trunc("month", "ts").cast("timestamp")
    area = F.concat(F.lit("A"), F.col("user_id").cast("string"), F.lit(">B"))
    path = files.raw_path(F.col("event_type"), area, month, month + F.expr("INTERVAL 1 MONTH"), F.lit("run1"), "xml")
    return table(spark, sf, "events").select("event_id", path.alias("path"))


@query("raw_partitions", """
SELECT event_type AS dataset, 'N' || (user_id % 5) || '_to_X' AS area, '2024' AS year, '01' AS month, count(*) AS n FROM events GROUP BY ALL""")
def raw_partitions(spark, sf):
    folder = new_folder(spark, "raw")
    docs = table(spark, sf, "events").select(
        F.col("event_type").alias("dataset"), F.concat(F.lit("N"), (F.col("user_id") % 5).cast("string"), F.lit(">X")).alias("area_key"),
        F.col("ts").alias("request_start_utc"), F.col("props").alias("text"))
    files.write_raw(docs, folder)
    stored = spark.read.option("basePath", folder).schema("text string, dataset string, area string, year string, month string").parquet(folder)
    return plain(stored.groupBy("dataset", "area", "year", "month").agg(F.count(F.lit(1)).alias("n")))


@query("iso_durations", """
SELECT p_partkey, CAST(CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 4 = 1 THEN p_size WHEN p_size % 4 = 2 THEN p_size * 60 ELSE p_size * 60 + 15 END AS DOUBLE) AS minutes
FROM part""")
def iso_durations(spark, sf):
    size, kind = F.col("p_size").cast("string"), F.col("p_size") % 4
    text = (F.when(kind == 0, F.concat(F.lit("P"), size, F.lit("D"))).when(kind == 1, F.concat(F.lit("PT"), size, F.lit("M")))
             .when(kind == 2, F.concat(F.lit(" PT"), size, F.lit("H "))).otherwise(F.concat(F.lit("PT"), size, F.lit("H15M"))))
    return table(spark, sf, "part").select("p_partkey", iso_minutes(text).cast("double").alias("minutes"))


@query("pair_codes", "SELECT n_name || '>' || r_name AS pair, n_name AS from_code, r_name AS to_code FROM nation JOIN region ON n_regionkey = r_regionkey")
def pair_codes(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    pairs = n.join(r, n.n_regionkey == r.r_regionkey).select(F.concat_ws(">", "n_name", "r_name").alias("pair"))
    from_code, to_code = split_pair("pair")
    return pairs.select("pair", from_code.alias("from_code"), to_code.alias("to_code"))


@query("fill_by_curve", """
WITH p AS (SELECT user_id, event_type, date_trunc('day', ts) AS day, hour(ts) + 1 AS position, arg_max(value, event_id) AS value
           FROM events GROUP BY ALL),
g AS (SELECT d.user_id, d.event_type, d.day, s.position FROM (SELECT DISTINCT user_id, event_type, day FROM p) d, range(1, 25) s(position)),
f AS (SELECT g.*, p.position IS NOT NULL AS listed, last_value(p.value IGNORE NULLS) OVER (PARTITION BY g.user_id, g.event_type, g.day ORDER BY g.position) AS value
      FROM g LEFT JOIN p USING (user_id, event_type, day, position))
SELECT user_id, event_type, day, CAST(position AS BIGINT) AS position, value FROM f WHERE value IS NOT NULL AND (listed OR event_type = 'click')""")
def fill_by_curve(spark, sf):
    """Clicks stand until the next position, all other types only where listed; a slot per hour of the day."""
    points = table(spark, sf, "events").select(
        "user_id", "event_type", F.date_trunc("day", "ts").alias("day"), (F.hour("ts") + 1).alias("position"), "value", "event_id")
    filled = series.fill_slots(points, ["user_id", "event_type", "day"], "position", 24, "value", carry=F.col("event_type") == "click", tie="event_id")
    return plain(filled.drop("event_id"))
