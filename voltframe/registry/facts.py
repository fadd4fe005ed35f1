"""Facts, dimensions and series operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voltframe.functions.scalars import exact_sum, hour_start
from voltframe.operators import dedupe, quality, series
from voltframe.plans import gold
from voltframe.registry import views
from voltframe.registry.base import half_up, plain, query, rounded, table

_KEYS = """CAST(strftime(h, '%Y%m%d') AS BIGINT) AS date_key, CAST(hour(h) AS BIGINT) AS hour_key, h AS ts_hour_utc"""

CARBON_SQL = views.ctes("carbon") + f"""
SELECT {_KEYS}, country_code, CAST(t AS DOUBLE) / 1000 AS total_generation_mwh, CAST(r AS DOUBLE) / 1000 AS renewable_mwh,
  CAST(l AS DOUBLE) / 1000 AS low_carbon_mwh, CAST(v AS DOUBLE) / 1000 AS factor_covered_mwh, CAST(c AS DOUBLE) / 1000 AS co2e_kg,
  CASE WHEN t > 0 THEN CAST({half_up('r * 10000', 't')} AS DOUBLE) / 100 END AS renewable_share_pct,
  CASE WHEN t > 0 THEN CAST({half_up('l * 10000', 't')} AS DOUBLE) / 100 END AS low_carbon_share_pct,
  CASE WHEN v > 0 THEN CAST({half_up('c * 100', 'v')} AS DOUBLE) / 100 END AS carbon_intensity_g_per_kwh,
  CASE WHEN t > 0 THEN CAST({half_up('v * 10000', 't')} AS DOUBLE) / 100 END AS factor_coverage_pct
FROM carbon"""


@query("carbon_hourly", CARBON_SQL)
def carbon_hourly(spark, sf):
    return plain(views.carbon_fact(spark, sf).drop("loaded_at_utc"))


@query("load_hourly", views.ctes("loadf") + f"""
SELECT {_KEYS}, area_code, country_code, CAST(load3 AS DOUBLE) / 1000 AS load_mwh, CAST(avg3 AS DOUBLE) / 1000 AS avg_load_mw,
  CAST(cov AS BIGINT) AS coverage_minutes FROM loadf""")
def load_hourly(spark, sf):
    return plain(gold.load_hourly(views.loads(spark, sf), views.areas(spark, sf), views.LOADED_AT).drop("loaded_at_utc"))


@query("load_hourly_from_date", views.ctes("loadf") + f"""
SELECT {_KEYS}, area_code, country_code, CAST(load3 AS DOUBLE) / 1000 AS load_mwh, CAST(avg3 AS DOUBLE) / 1000 AS avg_load_mw,
  CAST(cov AS BIGINT) AS coverage_minutes FROM loadf WHERE h >= TIMESTAMP '2024-01-24'""")
def load_hourly_from_date(spark, sf):
    fact = gold.load_hourly(views.loads(spark, sf), views.areas(spark, sf), views.LOADED_AT, from_date="2024-01-24")
    return plain(fact.drop("loaded_at_utc"))


@query("generation_hourly", views.ctes("gen") + f"""
SELECT {_KEYS}, area_code, country_code, psr AS psr_type_code, CAST(g3 AS DOUBLE) / 1000 AS generation_mwh,
  CASE WHEN psr <> 'signup' THEN CAST(c3 AS DOUBLE) / 1000 END AS co2e_kg, CAST(cov AS BIGINT) AS coverage_minutes FROM gen""")
def generation_hourly(spark, sf):
    return plain(views.generation_fact(spark, sf).drop("loaded_at_utc"))


@query("price_hourly_preferred", views.ctes("pricef") + f"""
SELECT {_KEYS}, area_code, country_code, CAST(p2 AS DOUBLE) / 100 AS price_eur_mwh, CAST(lo2 AS DOUBLE) / 100 AS min_price_eur_mwh,
  CAST(hi2 AS DOUBLE) / 100 AS max_price_eur_mwh, CAST(res AS BIGINT) AS source_resolution_minutes, n AS source_slots FROM pricef""")
def price_hourly_preferred(spark, sf):
    return plain(gold.price_hourly(views.prices(spark, sf), views.areas(spark, sf), views.LOADED_AT).drop("loaded_at_utc"))


@query("flow_one_resolution", views.ctes("flowf") + f"""
SELECT {_KEYS}, fa AS from_area_code, ta AS to_area_code, fc AS from_country_code, tc AS to_country_code,
  CAST(f3 AS DOUBLE) / 1000 AS flow_mwh, CAST(res AS BIGINT) AS source_resolution_minutes, CAST(cov AS BIGINT) AS coverage_minutes
FROM flowf""")
def flow_one_resolution(spark, sf):
    return plain(gold.flow_hourly(views.flows(spark, sf), views.areas(spark, sf), views.LOADED_AT).drop("loaded_at_utc"))


@query("weather_fact_hourly", views.ctes("weatherf") + f"""
SELECT {_KEYS}, country_code, CAST(temp2 AS DOUBLE) / 100 AS temperature_c, CAST(wind2 AS DOUBLE) / 100 AS wind_speed_100m_kmh,
  CAST(solar2 AS DOUBLE) / 100 AS solar_radiation_wm2, CAST(cloud2 AS DOUBLE) / 100 AS cloud_cover_pct,
  CAST(rain2 AS DOUBLE) / 100 AS precipitation_mm, CAST(arch3 AS DOUBLE) / 1000 AS archive_share, observed AS is_observed FROM weatherf""")
def weather_fact_hourly(spark, sf):
    return plain(gold.weather_hourly(views.country_weather(spark, sf), views.LOADED_AT).drop("loaded_at_utc"))


@query("dimension_misses", """
SELECT 'A' || (user_id % 25) AS area_code, count(*) AS dropped_rows FROM events
JOIN nation ON n_nationkey = user_id % 25 WHERE n_regionkey NOT IN (0, 1, 2) GROUP BY 1""")
def dimension_misses(spark, sf):
    known = views.areas(spark, sf).where("is_country_area")
    return plain(gold.unmatched(views.intervals(spark, sf), known))


# ---- choice within a key ---------------------------------------------------------------


@query("latest_wins", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS k
  FROM lineitem) WHERE k = 1""")
def latest_wins(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    return plain(dedupe.latest(items, ["l_orderkey", "l_linenumber"], "l_shipdate", "l_partkey", "l_suppkey"))


@query("priority_latest", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_returnflag, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS k
  FROM lineitem) WHERE k = 1""")
def priority_latest(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate")
    return plain(dedupe.preferred_then_latest(items, ["l_orderkey", "l_linenumber"], F.col("l_returnflag") == "R",
                                              "l_shipdate", "l_partkey", "l_suppkey"))


@query("first_rows_per_group", """
SELECT doc_id, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS k FROM documents) WHERE k <= 3""")
def first_rows_per_group(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return plain(dedupe.first_n(docs, ["lang", "source"], [F.col("doc_id")], 3))


@query("top_with_ties", """
SELECT o_orderpriority, day, n FROM (
  SELECT *, rank() OVER (PARTITION BY o_orderpriority ORDER BY n DESC) AS k FROM (
    SELECT o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n FROM orders GROUP BY ALL)) WHERE k <= 3""")
def top_with_ties(spark, sf):
    days = table(spark, sf, "orders").groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return plain(dedupe.top_with_ties(days, [F.col("n").desc()], 3, ["o_orderpriority"]))


# ---- series ----------------------------------------------------------------------------


_FILL_SQL = """
WITH p AS (SELECT user_id, date_trunc('day', ts) AS day, hour(ts) + 1 AS position, arg_max(value, event_id) AS value
           FROM events GROUP BY 1, 2, 3),
grid AS (SELECT d.user_id, d.day, s.position FROM (SELECT DISTINCT user_id, day FROM p) d, range(1, 25) s(position)),
filled AS (SELECT g.user_id, g.day, g.position, p.position IS NOT NULL AS listed,
             last_value(p.value IGNORE NULLS) OVER (PARTITION BY g.user_id, g.day ORDER BY g.position) AS value
           FROM grid g LEFT JOIN p USING (user_id, day, position))
SELECT user_id, day, CAST(position AS BIGINT) AS position, value FROM filled """


def _hour_points(spark, sf):
    return table(spark, sf, "events").select("user_id", F.date_trunc("day", "ts").alias("day"),
                                             (F.hour("ts") + 1).alias("position"), "value", "event_id")


@query("forward_fill_slots", _FILL_SQL + "WHERE value IS NOT NULL")
def forward_fill_slots(spark, sf):
    filled = series.fill_slots(_hour_points(spark, sf), ["user_id", "day"], "position", 24, "value", carry=True, tie="event_id")
    return plain(filled.select("user_id", "day", "position", "value"))


@query("listed_slots", _FILL_SQL + "WHERE listed")
def listed_slots(spark, sf):
    listed = series.fill_slots(_hour_points(spark, sf), ["user_id", "day"], "position", 24, "value", carry=False, tie="event_id")
    return plain(listed.select("user_id", "day", "position", "value"))


@query("weighted_mean", """
SELECT n_name, round(sum(CASE WHEN s_acctbal >= 0 THEN s_acctbal * w END) / sum(CASE WHEN s_acctbal >= 0 THEN w END), 6) AS balance,
  round(sum(CASE WHEN s_acctbal >= 5000 THEN w ELSE 0 END) / CAST(sum(w) AS DOUBLE), 6) AS rich_share
FROM (SELECT *, s_suppkey % 3 + 1 AS w FROM supplier) JOIN nation ON n_nationkey = s_nationkey GROUP BY n_name""")
def weighted_mean(spark, sf):
    s = table(spark, sf, "supplier").select("s_nationkey", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal")).alias("balance"),
                                            (F.col("s_suppkey") % 3 + 1).cast("double").alias("w"))
    means = series.weighted_mean(s, ["s_nationkey"], ["balance"], "w", {"rich_share": F.col("balance") >= 5000})
    named = means.join(table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey")
    return rounded(named.select("n_name", "balance", "rich_share"), "balance", "rich_share")


@query("weather_country_hourly", views.ctes("wx", "wxc") + """
SELECT country_code, h AS ts_utc, round(temp_n / CAST(w_all AS DOUBLE) / 100, 6) AS temperature_2m,
  round(wind_n / CAST(wind_w AS DOUBLE) / 100, 6) AS wind_speed_100m, round(solar_n / CAST(w_all AS DOUBLE) / 100, 6) AS shortwave_radiation,
  round(cloud_n / CAST(w_all AS DOUBLE) / 100, 6) AS cloud_cover, round(rain_n / CAST(rain_w AS DOUBLE) / 100, 6) AS precipitation,
  round(w_arch / CAST(w_all AS DOUBLE), 6) AS archive_share FROM wxc""")
def weather_country_hourly(spark, sf):
    means = ["temperature_2m", "wind_speed_100m", "shortwave_radiation", "cloud_cover", "precipitation", "archive_share"]
    return plain(rounded(views.country_weather(spark, sf), *means))


@query("validity_asof", """
WITH versions AS (SELECT p_brand, p_partkey, p_retailprice, make_timestamp(1995 + (p_partkey % 6), 1, 1, 0, 0, 0) AS f FROM part),
v AS (SELECT p_brand, f, max(p_retailprice) AS price, lead(f) OVER (PARTITION BY p_brand ORDER BY f) AS t FROM versions GROUP BY p_brand, f)
SELECT l.p_brand, l.h AS ship_day, l.n, v.price AS price FROM (
  SELECT p_brand, date_trunc('day', l_shipdate) AS h, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL) l
LEFT JOIN v ON v.p_brand = l.p_brand AND l.h >= v.f AND (v.t IS NULL OR l.h < v.t)""")
def validity_asof(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_retailprice")
    start = F.make_timestamp_ntz(F.lit(1995) + (F.col("l_partkey") % 6).cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))

    versions = part.groupBy("p_brand", start.alias("valid_from")).agg(F.max("p_retailprice").alias("price")).withColumn(
        "valid_to", F.lead("valid_from").over(Window.partitionBy("p_brand").orderBy("valid_from")))
    shipped = (table(spark, sf, "lineitem").select("l_partkey", F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("ship_day"))
               .join(part.select("l_partkey", "p_brand"), "l_partkey").groupBy("p_brand", "ship_day").agg(F.count(F.lit(1)).alias("n")))
    return plain(series.validity_join(shipped, versions, "p_brand", "ship_day").select("p_brand", "ship_day", "n", "price"))


@query("touched_days_recompute", """
WITH touched AS (SELECT DISTINCT user_id, date_trunc('day', ts) AS d FROM events WHERE event_type = 'purchase')
SELECT e.user_id, strftime(t.d, '%Y-%m-%d') AS day, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total
FROM events e JOIN touched t ON t.user_id = e.user_id AND date_trunc('day', e.ts) = t.d GROUP BY ALL""")
def touched_days_recompute(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "value", "event_type")
    again = series.restrict_to_touched(e, e.where("event_type = 'purchase'"), ["user_id"], "ts")

    return plain(again.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total")))


# ---- dimensions and reconciliation -----------------------------------------------------


@query("dim_date", """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, strftime(d, '%Y-%m-%d') AS date, year(d) AS year, quarter(d) AS quarter,
  month(d) AS month, monthname(d) AS month_name, day(d) AS day_of_month, isodow(d) AS day_of_week, dayname(d) AS day_name,
  isodow(d) >= 6 AS is_weekend,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
       WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
      FROM (SELECT date_trunc('day', o_orderdate) AS o_orderdate FROM orders))""")
def dim_date(spark, sf):
    bounds = table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")).alias("first_day"),
                                            F.to_date(F.max("o_orderdate")).alias("last_day"))
    return plain(gold.dim_date(bounds))


@query("dim_hour_profile", """
SELECT CAST(hour(ts) AS BIGINT) AS hour_key, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00' AS hour_label,
  CASE hour(ts) // 6 WHEN 0 THEN 'Night' WHEN 1 THEN 'Morning' WHEN 2 THEN 'Afternoon' ELSE 'Evening' END AS day_part, count(*) AS n
FROM events GROUP BY ALL""")
def dim_hour_profile(spark, sf):
    counts = table(spark, sf, "events").groupBy(F.hour("ts").alias("hour_key")).agg(F.count(F.lit(1)).alias("n"))
    return plain(gold.dim_hour(spark).join(counts, "hour_key").select("hour_key", "hour_label", "day_part", "n"))


@query("dim_area", """
SELECT 'A' || n_nationkey AS area_code, 'EIC-' || n_name AS eic_code, n_name AS area_name, 'C' || n_regionkey AS country_code,
  r_name AS country_name, n_regionkey IN (0, 1, 2) AS is_country_area, n_regionkey IN (2, 3, 4) AS is_bidding_zone
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def dim_area(spark, sf):
    return plain(gold.dim_area(views.areas(spark, sf), views.countries(spark, sf)))


@query("dim_production_type", """
SELECT p_brand AS psr_type_code, p_brand AS production_type_name, min(p_type) AS fuel_category, min(p_size) < 5 AS is_renewable,
  max(p_size) > 45 AS is_low_carbon, CAST(round(CASE WHEN min(p_size) > 1 THEN min(p_size) END, 1) AS DOUBLE) AS lifecycle_gco2e_per_kwh,
  min(p_size) > 1 AS has_emission_factor, 'part' AS emission_factor_source FROM part GROUP BY p_brand""")
def dim_production_type(spark, sf):
    kinds = table(spark, sf, "part").groupBy("p_brand").agg(
        F.min("p_type").alias("fuel_category"), (F.min("p_size") < 5).alias("is_renewable"), (F.max("p_size") > 45).alias("is_low_carbon"),
        F.when(F.min("p_size") > 1, F.min("p_size")).alias("lifecycle_gco2e_per_kwh")).withColumns(
        {"psr_type_code": F.col("p_brand"), "grid_name": F.col("p_brand"), "emission_factor_source": F.lit("part")})
    return plain(gold.dim_production_type(kinds))


@query("reconcile_load", views.ctes("iv", "area", "loadf") + """
SELECT gold, silver, round(abs(gold - silver), 3) AS difference, CASE WHEN abs(gold - silver) <= 1 THEN 'OK' ELSE 'FAILED' END AS status FROM (
  SELECT CAST(CAST((SELECT sum(load3) FROM loadf) AS DECIMAL(18,0)) / 1000 AS DOUBLE) AS gold,
         CAST(round((SELECT sum(e4) FROM iv) / 10000.0, 3) AS DOUBLE) AS silver)""")
def reconcile_load(spark, sf):
    silver = views.loads(spark, sf)
    fact = gold.load_hourly(silver, views.areas(spark, sf), views.LOADED_AT)
    return rounded(gold.reconcile_load(fact, silver, "2024-01-01"), "gold", "silver", "difference", places=3)


@query("reconcile_failure", """
SELECT CASE WHEN abs(a - b) <= 1 THEN 'OK' ELSE 'FAILED' END AS status,
  CASE WHEN abs(a - b) <= 1 THEN 'Gold reconciled with Silver' ELSE 'Load MWh differs between Gold and Silver' END AS message,
  round(abs(a - b), 3) AS load_diff_mwh, '2024-01-01' AS checked_from_date
FROM (SELECT sum(l_quantity) AS a, sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) AS b FROM lineitem)""")
def reconcile_failure(spark, sf):
    items = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("decimal(12,2)").alias("q"), "l_returnflag")
    check = quality.reconcile(items, "q", items.where("l_returnflag <> 'R'"), "q")
    log = gold.run_log(check, "2024-02-01 00:00:00", "2024-02-01 00:05:00", "2024-01-01")
    return plain(log.select("status", "message", "load_diff_mwh", "checked_from_date"))


@query("hour_start_counts", "SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events GROUP BY 1")
def hour_start_counts(spark, sf):
    return plain(table(spark, sf, "events").groupBy(hour_start("ts").alias("h")).agg(F.count(F.lit(1)).alias("n")))


@query("validity_asof_many", """
WITH m AS (SELECT user_id % 5 AS k, date_trunc('minute', ts) AS valid_from, max(value) AS price, max(event_id) AS last_id FROM events WHERE event_type = 'click' GROUP BY 1, 2),
v AS (SELECT k, valid_from, price, CASE WHEN last_id % 4 = 0 THEN valid_from + INTERVAL 90 MINUTE END AS valid_to FROM m),
f AS (SELECT event_id, user_id % 5 AS k, ts FROM events WHERE event_type <> 'click')
SELECT event_id, CASE WHEN valid_to IS NULL OR ts < valid_to THEN price END AS price FROM f ASOF LEFT JOIN v ON f.k = v.k AND f.ts >= v.valid_from""")
def validity_asof_many(spark, sf):
    """Events against one version per key and minute: five keys hold everything, each cut into spans of two days."""
    e = table(spark, sf, "events").withColumn("k", F.col("user_id") % 5)
    minute = F.date_trunc("minute", "ts").cast("timestamp")
    versions = e.where("event_type = 'click'").groupBy("k", minute.alias("valid_from")).agg(F.max("value").alias("price"), F.max("event_id").alias("last"))
    versions = versions.select("k", "valid_from", F.when(F.col("last") % 4 == 0, F.col("valid_from") + F.expr("INTERVAL 90 MINUTE")).alias("valid_to"), "price")
    rows = e.where("event_type <> 'click'").select("event_id", "k", F.col("ts").cast("timestamp").alias("ts"))
    return plain(series.version_in_force(rows, versions, "k", "ts", span_seconds=2 * 86400, shares=2).select("event_id", "price"))
