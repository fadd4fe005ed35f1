"""Raw files that Spark writes from the given tables: scanned by list, streamed, and parsed in two stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.operators.tables import Lake
from voltframe.plans import pipeline, silver
from voltframe.registry import views
from voltframe.registry.base import plain, query, rounded, table
from voltframe.session import new_folder
from voltframe.sources import files, grid_xml, json_records
from voltframe.streaming import documents as stream

AS_OF = "2024-02-01 00:00:00"
_LEAF = ["dataset", "area", "year", "month", "day"]


def _write_lines(lines: DataFrame, folder: str, leaf: list[str]) -> str:
    """One file per leaf folder, its lines in order of `place`: as raw files are laid out, without a document passing
    through one row."""
    spread = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (lines.repartition(spread, *leaf).sortWithinPartitions(*leaf, "place", "line").select(*leaf, "line")
     .write.partitionBy(*leaf).text(folder))
    return folder


def _log(spark, folder: str, source: str) -> DataFrame:
    """The audit log of the files below a folder; a file came in the day after the one it is about. Nothing is opened."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(
        files.relative_path("path", folder).alias("file_path"), F.col("length").alias("bytes"))

    def step(name: str):
        return F.regexp_extract("file_path", f"{name}=([^/]*)/", 1)

    day = F.to_timestamp(F.concat(step("year"), step("month"), step("day")), "yyyyMMdd")
    none = {c: F.lit(None) for c in ("request_start_utc", "request_end_utc", "points", "error_message")}
    return found.withColumns({"run_id": F.lit("r"), "source": F.lit(source), "dataset": step("dataset"), "area_key": step("area"), "status": F.lit("ok"),
                              "ingested_at_utc": day + F.expr("INTERVAL 1 DAY"), **none})


def _dated(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({n: F.date_format(ts, p) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))})


def _grid_files(spark, sf, dataset: str) -> str:
    """A document per area and day: the largest value of each type and hour stands for both half hours of it (purchases: the
    first one, then 7). Errors are documents of areas of their own, whose values are no numbers."""
    hours = (table(spark, sf, "events").withColumn("hour", F.date_trunc("hour", "ts"))
             .groupBy("event_type", F.concat(F.when(F.col("event_type") == "error", "E").otherwise("A"), (F.col("user_id") % 2).cast("string")).alias("area"), "hour")
             .agg(F.max("value").alias("value")))
    tag = "price.amount" if dataset == grid_xml.PRICE_DATASET else "quantity"

    def iso(c):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm'Z'")

    def point(position: int, value):
        return F.concat(F.lit(f"<Point><position>{position}</position><{tag}>"), value, F.lit(f"</{tag}></Point>"))

    kind, v = F.col("event_type"), F.col("value").cast("string")
    points = F.when(kind == "error", point(1, F.lit("abc"))).when(kind == "purchase", F.concat(point(1, v), point(2, F.lit("7")))).otherwise(point(1, v))
    series = F.concat(F.lit("<TimeSeries><MktPSRType><psrType>"), kind, F.lit("</psrType></MktPSRType><curveType>"),
                      F.when(kind == "purchase", "A01").otherwise("A03"), F.lit("</curveType><Period><timeInterval><start>"), iso("hour"),
                      F.lit("</start><end>"), iso(F.col("hour") + F.expr("INTERVAL 1 HOUR")), F.lit("</end></timeInterval><resolution>PT30M</resolution>"),
                      points, F.lit("</Period></TimeSeries>"))
    placed = _dated(hours, "hour").withColumn("dataset", F.lit(dataset))
    body = placed.select(*_LEAF, F.lit(1).alias("place"), series.alias("line"))
    around = F.explode(F.array(F.struct(F.lit(0).alias("place"), F.lit('<?xml version="1.0" encoding="UTF-8"?><Doc xmlns="urn:grid:1">').alias("line")),
                               F.struct(F.lit(2).alias("place"), F.lit("</Doc>").alias("line"))))
    frame = placed.select(*_LEAF).distinct().select(*_LEAF, around.alias("x")).select(*_LEAF, "x.*")
    return _write_lines(body.unionByName(frame), new_folder(spark, "raw-grid"), _LEAF)


_HALF_HOURS = """
WITH h AS (SELECT event_type, CASE WHEN event_type = 'error' THEN 'E' ELSE 'A' END || (user_id % 2) AS area, date_trunc('hour', ts) AS hour, max(value) AS value
           FROM events GROUP BY ALL),
x AS (SELECT event_type, area, hour + INTERVAL 30 MINUTE * i AS ts_utc, hour, CASE WHEN event_type = 'purchase' AND i = 1 THEN 7 ELSE value END AS value
      FROM h, range(0, 2) r(i) WHERE event_type <> 'error')
"""
_GENERATION = """
SELECT area AS area_code, ts_utc, event_type AS psr_type_code, CAST(value AS DOUBLE) AS power_mw, round(value * 0.5, 6) AS energy_mwh,
  CASE WHEN event_type <> 'signup' THEN round(value * 0.5 * CASE event_type WHEN 'click' THEN 48 WHEN 'view' THEN 510 ELSE 12 END, 6) END AS co2e_kg FROM x"""


def _lake(spark) -> Lake:
    return pipeline.lake(spark, new_folder(spark, "lake"))


def _factors(spark) -> DataFrame:
    return views.factors(spark).where("valid_to IS NULL").select("psr_type_code", "lifecycle_gco2e_per_kwh")


def _silver(store: Lake) -> DataFrame:
    rows = store.read("silver_generation").select("area_code", "ts_utc", "psr_type_code", "power_mw", "energy_mwh", "co2e_kg")
    return plain(rounded(rows, "energy_mwh", "co2e_kg"))


def _processed(spark, dataset: str, until: str) -> DataFrame:
    return spark.sql(f"SELECT '{dataset}' AS dataset, TIMESTAMP '{until}' AS processed_until_ingested_at, TIMESTAMP '{until}' AS updated_at_utc")


@query("scan_xml_files", _HALF_HOURS + _GENERATION + " WHERE hour >= TIMESTAMP '2024-01-10'")
def scan_xml_files(spark, sf):
    """Grid documents up to 9 January count as processed: only later ones are looked up, opened and merged."""
    folder, store = _grid_files(spark, sf, "actual_generation"), _lake(spark)
    store.append("ctl_ingest_log", _log(spark, folder, silver.GRID_SOURCE))
    store.append("ctl_silver_state", _processed(spark, "actual_generation", "2024-01-10"))
    for _ in range(2):  # the second run finds nothing to do
        silver.load_grid(store, folder, "actual_generation", AS_OF, _factors(spark))
    return _silver(store)


@query("scan_xml_faults", """
SELECT DISTINCT 'silver_generation' AS table_name, 'xml_parse_error' AS rule_name, 'value is not a number' AS details, 'E' || (user_id % 2) AS area,
  strftime(ts, '%Y-%m-%d') AS day FROM events WHERE event_type = 'error'""")
def scan_xml_faults(spark, sf):
    """One pass over the documents gives rows and faults; a second full run notes no fault twice."""
    folder, store = _grid_files(spark, sf, "actual_generation"), _lake(spark)
    store.append("ctl_ingest_log", _log(spark, folder, silver.GRID_SOURCE))
    for _ in range(2):
        silver.load_grid(store, folder, "actual_generation", AS_OF, _factors(spark), mode="full")
    step = {n: F.regexp_extract("source_file", f"{n}=([^/]*)/", 1) for n in ("area", "year", "month", "day")}
    return store.read("dq_quarantine").select("table_name", "rule_name", "details", step["area"].alias("area"),
                                              F.concat_ws("-", step["year"], step["month"], step["day"]).alias("day"))


@query("stream_documents_to_silver", _HALF_HOURS + _GENERATION)
def stream_documents_to_silver(spark, sf):
    """The same documents as a stream of files, in batches of 100; a replay of everything changes nothing."""
    folder, store = _grid_files(spark, sf, "actual_generation"), _lake(spark)
    for run in ("first", "replay"):
        stream.grid_to_silver(store, folder, f"{store.root}-{run}", AS_OF, _factors(spark), "*.txt", 100)
    return _silver(store)


@query("xml_load", _HALF_HOURS + """
SELECT area AS area_code, ts_utc, CAST(30 AS BIGINT) AS resolution_minutes, CAST(max(value) AS DOUBLE) AS load_mw, round(max(value) * 0.5, 6) AS energy_mwh
FROM x WHERE event_type = 'click' GROUP BY ALL""")
def xml_load(spark, sf):
    """Load documents through the daily job's own step; clicks are the load series, other types are left out beforehand."""
    return _single_series(spark, sf, "actual_load", "silver_load", ["load_mw", "energy_mwh"])


@query("xml_price", _HALF_HOURS + """
SELECT area AS area_code, ts_utc, CAST(30 AS BIGINT) AS resolution_minutes, CAST(max(value) AS DOUBLE) AS price_eur_mwh FROM x WHERE event_type = 'click' GROUP BY ALL""")
def xml_price(spark, sf):
    """Price documents, whose values stand in `price.amount`."""
    return _single_series(spark, sf, "day_ahead_price", "silver_price", ["price_eur_mwh"])


def _single_series(spark, sf, dataset: str, target: str, values: list[str]) -> DataFrame:
    folder, store = _grid_files(spark, sf, dataset), _lake(spark)
    todo = files.grouped(_log(spark, folder, silver.GRID_SOURCE), most_files=30).repartitionByRange("scan_group")
    todo = store.staged("pending", todo.select("dataset", "area_key", "file_path", "ingested_at_utc", "scan_group"))

    def clicks(group: DataFrame) -> DataFrame:
        read = grid_xml.read_documents(files.documents(spark, folder, group))
        rows = grid_xml.intervals(read, "area_key", "file_path", "ingested_at_utc", faults=True)
        return rows.where("psr_type_code = 'click' OR fault IS NOT NULL")

    silver.merge_intervals(store, store.staged_all("parsed", silver.by_group(todo, clicks)), dataset, AS_OF)
    return plain(rounded(store.read(target).select("area_code", "ts_utc", "resolution_minutes", *values), *values))


@query("scan_weather_files", """
SELECT 'L' || (user_id % 5) AS location_code, 'C' || (user_id % 5 % 3) AS country_code, date_trunc('hour', ts) AS ts_utc,
  round(max(value), 6) AS temperature_2m, 'archive' AS data_source FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY ALL""")
def scan_weather_files(spark, sf):
    """Weather files per location and day; those up to 19 January count as processed."""
    hours = (table(spark, sf, "events").groupBy(F.concat(F.lit("L"), (F.col("user_id") % 5).cast("string")).alias("area"), F.date_trunc("hour", "ts").alias("hour"))
             .agg(F.max("value").alias("v")))
    at = F.struct(F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time"), "v")
    days = _dated(hours, "hour").withColumn("dataset", F.lit("weather_hourly_archive")).groupBy(*_LEAF).agg(F.array_sort(F.collect_list(at)).alias("x"))
    text = F.concat(F.lit('{"timezone":"GMT",\n"hourly":'), F.to_json(F.struct(F.col("x.time").alias("time"), F.col("x.v").alias("temperature_2m"))), F.lit("}"))
    folder = _write_lines(days.select(*_LEAF, F.lit(0).alias("place"), text.alias("line")), new_folder(spark, "raw-weather"), _LEAF)
    store = _lake(spark)
    store.append("ctl_ingest_log", _log(spark, folder, silver.WEATHER_SOURCE))
    store.append("ctl_silver_state", _processed(spark, "weather", "2024-01-20"))
    places = spark.sql("SELECT concat('L', i) AS location_code, concat('C', i % 3) AS country_code, 1.0D AS weight FROM (SELECT explode(sequence(0, 4)) AS i)")
    silver.load_weather(store, folder, places, AS_OF)
    return plain(rounded(store.read("silver_weather_hourly").select("location_code", "country_code", "ts_utc", "temperature_2m", "data_source"), "temperature_2m"))


def _record(name: str, extra: str = "") -> F.Column:
    key = F.col("o_orderkey").cast("string")
    return F.concat(F.lit('{"countryCode":"C'), key, F.lit('","date":"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(f'",{extra}"name":"{name}"}}'))


@query("scan_holiday_files", """
SELECT 'C' || o_orderkey AS country_code, strftime(o_orderdate, '%Y-%m-%d') AS holiday_date, 'N' AS name FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') OR (o_orderpriority = '5-LOW' AND o_orderkey % 2 = 0)""")
def scan_holiday_files(spark, sf):
    """Holiday files per priority and year: arrays over many lines, one object per line (also behind a BOM), lines that break off
    (those alone are lost), and arrays without an end (lost as a whole). Nothing stops the load."""
    priority, cut = F.col("o_orderpriority"), F.col("o_orderkey") % 2 == 1
    urgent, medium, low, open_ = (priority == p for p in ("1-URGENT", "3-MEDIUM", "5-LOW", "4-NOT SPECIFIED"))
    one = _record("N")
    line = (F.when(urgent | open_, F.concat(one, F.lit(","))).when(low & cut, F.concat(F.lit(" "), F.left(one, F.length(one) - 1))).otherwise(one))
    orders = table(spark, sf, "orders").withColumn("year", F.date_format("o_orderdate", "yyyy")).withColumn("kind", F.left("o_orderpriority", F.lit(1)))
    leaf = ["kind", "year"]
    body = orders.select(*leaf, F.lit(1).alias("place"), line.alias("line"))
    ends = orders.select(*leaf).distinct().select(*leaf, F.inline(F.expr(
        """CASE kind WHEN '1' THEN array(struct(0 AS place, '[' AS line), struct(2 AS place, '{"countryCode":"C"}]' AS line))
                     WHEN '4' THEN array(struct(0 AS place, '[' AS line)) WHEN '3' THEN array(struct(0 AS place, '﻿' AS line)) END""")))
    folder = new_folder(spark, "raw-holidays")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (body.unionByName(ends).repartition(spread, *leaf).sortWithinPartitions(*leaf, "place", "line").select(*leaf, "line")
     .write.partitionBy(*leaf).text(folder))
    read = json_records.parsed(files.whole_text(spark, folder, "*.txt"), "text", json_records.HOLIDAY)
    store = _lake(spark)
    with store.scratch():
        silver.merge_holidays(store, store.staged("holidays", read), AS_OF)
    return plain(store.read("silver_holiday").select("country_code", "holiday_date", "name"))


def _broken_texts(spark, sf) -> DataFrame:
    """Orders as texts: an array without an end, an object over lines whose first line ends in a brace, a good line beside one
    that breaks off, no JSON at all, and empty."""
    priority = F.col("o_orderpriority")
    one = _record("N")
    text = (F.when(priority == "1-URGENT", F.concat(F.lit("["), one, F.lit(',{"countryCode":"NL"')))
             .when(priority == "2-HIGH", F.concat(F.lit('{"x":{"a":1}\n,'), F.substr(one, F.lit(2))))
             .when(priority == "3-MEDIUM", F.concat(one, F.lit("\r\n\n"), F.left(one, F.lit(12)), F.lit("\n")))
             .when(priority == "5-LOW", F.concat(F.lit("no json "), F.col("o_orderkey").cast("string"))).otherwise(""))
    return table(spark, sf, "orders").select(F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("source_file"), text.alias("text"))


_BROKEN = """
WITH r AS (SELECT o_orderkey, o_orderpriority AS p, '{"countryCode":"C' || o_orderkey || '","date":"' || strftime(o_orderdate, '%Y-%m-%d') || '","name":"N"}' AS one FROM orders),
bad AS (SELECT o_orderkey, CASE p WHEN '1-URGENT' THEN '[' || one || ',{"countryCode":"NL"' WHEN '3-MEDIUM' THEN one[1:12] WHEN '5-LOW' THEN 'no json ' || o_orderkey END AS part
        FROM r WHERE p IN ('1-URGENT', '3-MEDIUM', '5-LOW'))
"""


@query("json_malformed", _BROKEN + """
SELECT 'silver_holiday' AS table_name, 'f' || o_orderkey || '|' || md5(part) AS record_key, 'malformed_json' AS rule_name, part[1:200] AS details,
  'f' || o_orderkey AS source_file, TIMESTAMP '2024-02-01' AS detected_at FROM bad""")
def json_malformed(spark, sf):
    """What is no JSON goes to quarantine, line by line where other lines of the text are sound."""
    read = json_records.parsed(_broken_texts(spark, sf), "text", json_records.HOLIDAY)
    return plain(json_records.malformed(read, "silver_holiday", "source_file", AS_OF))


@query("json_two_stage", """
SELECT 'C' || o_orderkey AS country_code, strftime(o_orderdate, '%Y-%m-%d') AS holiday_date, 'N' AS name, 'f' || o_orderkey AS _source_file
FROM orders WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM')""")
def json_two_stage(spark, sf):
    """The sound records of the same texts."""
    good, _ = json_records.clean_holidays(json_records.holidays(json_records.records(_broken_texts(spark, sf), "text", json_records.HOLIDAY)))
    return plain(good.select("country_code", "holiday_date", "name", "_source_file"))
