"""Ingest scope, planning, resume and watermarks."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltframe.operators import planning, scope
from voltframe.operators.tables import Lake
from voltframe.plans import pipeline
from voltframe.registry import views
from voltframe.registry.base import plain, query, table
from voltframe.schemas import describe
from voltframe.session import new_folder

# ---- scope -----------------------------------------------------------------------------

_NATION = """
WITH a AS (SELECT 'A' || n_nationkey AS area_code, 'EIC-' || n_name AS eic_code, n_regionkey IN (0, 1, 2) AS is_ca,
  n_regionkey IN (2, 3, 4) AS is_bz, r_name <> 'ASIA' AS active FROM nation JOIN region ON n_regionkey = r_regionkey),
da AS (SELECT d AS dataset, a.* FROM a, (VALUES ('actual_load'), ('actual_generation'), ('installed_capacity')) v(d) WHERE is_ca
  UNION ALL SELECT 'day_ahead_price', a.* FROM a WHERE is_bz)
"""


@query("dataset_area", _NATION + "SELECT dataset, area_code FROM da")
def dataset_area(spark, sf):
    return scope.dataset_areas(views.areas(spark, sf))


@query("scope_join", _NATION + "SELECT dataset, area_code, eic_code FROM da WHERE active AND dataset <> 'installed_capacity'")
def scope_join(spark, sf):
    area = views.areas(spark, sf)
    wanted = scope.dataset_areas(area).withColumn("is_enabled", F.col("dataset") != "installed_capacity")
    return scope.active_areas(wanted, area, views.countries(spark, sf))


def _borders(spark, sf):
    ends = [f("from_area_code", "to_area_code").alias(n) for f, n in ((F.least, "from_area_code"), (F.greatest, "to_area_code"))]
    return views.flows(spark, sf).where("from_area_code <> to_area_code").select(*ends).distinct()


_BORDER = """
WITH b AS (SELECT DISTINCT least('A' || s_nationkey, 'A' || c_nationkey) AS f, greatest('A' || s_nationkey, 'A' || c_nationkey) AS t FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey WHERE s_nationkey <> c_nationkey),
d AS (SELECT f, t FROM b UNION ALL SELECT t, f FROM b)
"""


@query("directed_borders", _BORDER + "SELECT f AS from_area_code, t AS to_area_code FROM d")
def directed_borders(spark, sf):
    return scope.both_directions(_borders(spark, sf))


@query("border_scope", _BORDER + """
, a AS (SELECT 'A' || n_nationkey AS area_code, r_name <> 'ASIA' AS active FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT f AS from_area_code, t AS to_area_code FROM d JOIN a x ON x.area_code = f JOIN a y ON y.area_code = t WHERE x.active OR y.active""")
def border_scope(spark, sf):
    borders = scope.both_directions(_borders(spark, sf)).withColumn("is_enabled", F.lit(True))
    return scope.active_borders(borders, views.areas(spark, sf), views.countries(spark, sf))


@query("location_scope", """
SELECT 'L' || s_suppkey AS location_code, 'C' || n_regionkey AS country_code, s_acctbal AS latitude FROM supplier
JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'ASIA'""")
def location_scope(spark, sf):
    owner = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.concat(F.lit("C"), F.col("n_regionkey")).alias("country_code"))
    places = table(spark, sf, "supplier").join(owner, "s_nationkey").select(
        F.concat(F.lit("L"), F.col("s_suppkey")).alias("location_code"), "country_code", F.col("s_acctbal").alias("latitude"), F.lit(0.0).alias("longitude"))
    return scope.active_locations(places, views.countries(spark, sf)).drop("longitude")


_MARK_TABLE = describe("source string\ndataset string\narea_key string\nloaded_until_utc timestamp\nupdated_at_utc timestamp")


@query("watermark_upsert", """
SELECT o_orderpriority AS dataset, 'K' || (o_custkey % 50) AS area_key, max(o_orderdate) AS loaded_until_utc FROM orders GROUP BY ALL""")
def watermark_upsert(spark, sf):
    """The log of two runs moves the marks on; the first run again, arriving late, moves none back."""
    log = table(spark, sf, "orders").select(
        F.lit("grid").alias("source"), F.col("o_orderpriority").alias("dataset"), F.concat(F.lit("K"), (F.col("o_custkey") % 50).cast("string")).alias("area_key"),
        F.col("o_orderdate").cast("timestamp").alias("request_end_utc"), F.lit("ok").alias("status"))
    store = Lake(spark, new_folder(spark, "marks"), {"ctl_watermark": _MARK_TABLE})
    early, late = log.where("request_end_utc < '1998-01-01'"), log.where("request_end_utc >= '1998-01-01'")
    for run in (early, late, early):
        pipeline.record_watermarks(store, run, "2030-01-01 00:00:00")
    return plain(store.read("ctl_watermark").select("dataset", "area_key", "loaded_until_utc"))


@query("active_rows", "SELECT 'C' || r_regionkey AS country_code, r_name AS country_name FROM region WHERE r_name <> 'ASIA'")
def active_rows(spark, sf):
    return scope.active_rows(views.countries(spark, sf)).select("country_code", "country_name")


# ---- windows and chunks ----------------------------------------------------------------

_AS_OF = "2024-03-01 09:30:00"
_MARKS = """
WITH m AS (SELECT 'A' || (user_id % 25) AS area_key, event_type AS dataset, date_trunc('hour', max(ts)) AS until FROM events
  WHERE ts < TIMESTAMP '2024-01-25' AND event_type <> 'signup' GROUP BY ALL),
targets AS (SELECT DISTINCT 'A' || (user_id % 25) AS area_key, event_type AS dataset FROM events),
w AS (SELECT t.*, coalesce(m.until - INTERVAL 3 DAY, TIMESTAMP '2023-11-15') AS s,
  TIMESTAMP '2024-03-01' + CASE WHEN t.dataset = 'purchase' THEN INTERVAL 2 DAY ELSE INTERVAL 1 DAY END AS e
  FROM targets t LEFT JOIN m USING (area_key, dataset))
"""


def _chunk_sql(unit: str) -> str:
    return f"""SELECT area_key, dataset, greatest(s, x) AS chunk_start, least(e, x + INTERVAL 1 {unit}) AS chunk_end
FROM (SELECT w.*, unnest(generate_series(date_trunc('{unit}', s), e, INTERVAL 1 {unit})) AS x FROM w)
WHERE greatest(s, x) < least(e, x + INTERVAL 1 {unit})"""


def _targets(spark, sf):
    iv = views.intervals(spark, sf).select(F.col("area_code").alias("area_key"), F.col("psr_type_code").alias("dataset"), "ts_utc")
    early = iv.where((F.col("ts_utc") < F.lit("2024-01-25").cast("timestamp_ntz")) & (F.col("dataset") != "signup"))
    marks = early.groupBy("dataset", "area_key").agg(F.date_trunc("hour", F.max("ts_utc")).alias("loaded_until_utc"))
    return iv.select("area_key", "dataset").distinct(), marks


def _windows(spark, sf, mode):
    targets, marks = _targets(spark, sf)
    ahead = F.when(F.col("dataset") == "purchase", 2).otherwise(1)
    return planning.windows(targets, mode, _AS_OF, watermarks=marks, backfill_start="2023-11-15", ahead_days=ahead)


@query("plan_chunks", _MARKS + _chunk_sql("MONTH"))
def plan_chunks(spark, sf):
    return plain(planning.chunks(_windows(spark, sf, "incremental")))


@query("plan_year_chunks", _MARKS + _chunk_sql("YEAR"))
def plan_year_chunks(spark, sf):
    return plain(planning.chunks(_windows(spark, sf, "incremental"), "year"))


@query("plan_backfill", _MARKS.replace("coalesce(m.until - INTERVAL 3 DAY, TIMESTAMP '2023-11-15')", "TIMESTAMP '2023-11-15'") + _chunk_sql("MONTH"))
def plan_backfill(spark, sf):
    return plain(planning.chunks(_windows(spark, sf, "backfill")))


@query("plan_test_mode", """
SELECT DISTINCT 'A' || (user_id % 25) AS area_key, event_type AS dataset, c.s AS chunk_start, c.e AS chunk_end
FROM events, (VALUES (TIMESTAMP '2024-02-27', TIMESTAMP '2024-03-01')) c(s, e)""")
def plan_test_mode(spark, sf):
    return plain(planning.chunks(_windows(spark, sf, "test")))


def _order_log(spark, sf):
    """Orders as an audit log: one download attempt per order for the order's month."""
    month = F.date_trunc("month", "o_orderdate").cast("timestamp")
    status = F.when(F.col("o_orderstatus") == "F", "ok").when(F.col("o_orderstatus") == "P", "no_data").otherwise("error")
    return table(spark, sf, "orders").select(
        F.lit("orders").alias("dataset"), F.col("o_custkey").alias("area_key"), month.alias("request_start_utc"),
        (month + F.expr("INTERVAL 1 MONTH")).alias("request_end_utc"), status.alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("ingested_at_utc"), "o_orderkey")


_LOG = """
WITH log AS (SELECT o_custkey AS area_key, date_trunc('month', o_orderdate) AS s, date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS e,
  CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'P' THEN 'no_data' ELSE 'error' END AS status, o_orderdate AS seen, o_orderkey FROM orders)
"""


@query("plan_resume", _LOG + """
, months AS (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS s),
planned AS (SELECT c_custkey AS area_key, s, least(s + INTERVAL 1 MONTH, TIMESTAMP '2001-08-15') AS e FROM customer, months)
SELECT area_key, count(*) AS chunks, min(s) AS first_start, max(e) AS last_end FROM planned p
WHERE NOT EXISTS (SELECT 1 FROM log WHERE log.area_key = p.area_key AND log.s = p.s AND log.e = p.e AND status IN ('ok', 'no_data')) GROUP BY 1""")
def plan_resume(spark, sf):
    targets = table(spark, sf, "customer").select(F.lit("orders").alias("dataset"), F.col("c_custkey").alias("area_key"))
    planned = planning.chunks(planning.windows(targets, "backfill", "2001-08-14 08:00:00", backfill_start="1995-01-01"))
    left = planning.resume(planned, _order_log(spark, sf))
    return plain(left.groupBy("area_key").agg(F.count(F.lit(1)).alias("chunks"), F.min("chunk_start").alias("first_start"),
                                              F.max("chunk_end").alias("last_end")))


@query("advance_watermark", _LOG + """
SELECT area_key, least(max(e), TIMESTAMP '2001-06-15') AS loaded_until_utc FROM (
  SELECT *, row_number() OVER (PARTITION BY area_key, s, e ORDER BY seen DESC, o_orderkey DESC) AS k FROM log) WHERE k = 1
GROUP BY area_key HAVING count(*) FILTER (status = 'error') = 0""")
def advance_watermark(spark, sf):
    return plain(planning.advance_backfill(_order_log(spark, sf), "2001-06-15", ties=["o_orderkey"]).drop("dataset"))


@query("advance_incremental", _LOG + """
SELECT area_key, max(e) AS loaded_until_utc FROM log WHERE seen >= TIMESTAMP '2001-01-01' GROUP BY 1 HAVING count(*) FILTER (status = 'error') = 0""")
def advance_incremental(spark, sf):
    run = _order_log(spark, sf).where(F.col("ingested_at_utc") >= F.lit("2001-01-01").cast("timestamp"))
    return plain(planning.advance_incremental(run, None).drop("dataset"))


@query("batch_windows", _MARKS + f""", c AS ({_chunk_sql("YEAR")})
SELECT dataset, chunk_start, chunk_end, string_agg(area_key, ',' ORDER BY area_key) AS members, count(*) - 1 AS calls_saved FROM c GROUP BY ALL""")
def batch_windows(spark, sf):
    batches = planning.batch_windows(planning.chunks(_windows(spark, sf, "incremental"), "year"), "area_key")
    return plain(batches.withColumn("members", F.array_join("members", ",")))


_STATE = """state AS (SELECT event_type AS dataset, max(ts) AS until FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_type IN ('click', 'view') GROUP BY 1)"""


def _files(spark, sf):
    return table(spark, sf, "events").select("event_id", F.lit("grid").alias("source"), F.col("event_type").alias("dataset"),
                                             F.when(F.col("value") > 450, "error").otherwise("ok").alias("status"), F.col("ts").alias("ingested_at_utc"))


def _state(spark, sf):
    old = _files(spark, sf).where((F.col("ingested_at_utc") < F.lit("2024-01-20").cast("timestamp_ntz")) & F.col("dataset").isin("click", "view"))
    return planning.processed_until(old)


@query("pending_files", f"""
WITH {_STATE} SELECT event_id, event_type AS dataset FROM events LEFT JOIN state ON dataset = event_type
WHERE value <= 450 AND event_type <> 'error' AND (until IS NULL OR ts > until)""")
def pending_files(spark, sf):
    todo = planning.pending(_files(spark, sf), _state(spark, sf), "grid", F.col("dataset") != "error")
    return plain(todo.select("event_id", "dataset"))


@query("pending_full", "SELECT event_id, event_type AS dataset FROM events WHERE value <= 450 AND event_type <> 'error'")
def pending_full(spark, sf):
    todo = planning.pending(_files(spark, sf), _state(spark, sf), "grid", F.col("dataset") != "error", mode="full")
    return plain(todo.select("event_id", "dataset"))


@query("processed_until", "SELECT event_type AS dataset, max(ts) AS processed_until_ingested_at FROM events GROUP BY 1")
def processed_until(spark, sf):
    return plain(planning.processed_until(_files(spark, sf)))
