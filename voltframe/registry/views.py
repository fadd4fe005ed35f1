"""The given tables seen as energy data, in Spark and, independently, as SQL for the checks.

Events are intervals (area = user, production type = event type), line items are flows
between the supplier's and the customer's nation, nations are areas and regions countries.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltframe.functions.scalars import date_key, energy_mwh
from voltframe.plans import gold, silver
from voltframe.plans.measures import Star
from voltframe.registry.base import half_up, table
from voltframe.sources.inline import rows

LOADED_AT = "2024-02-01 00:00:00"
AREAS = 25

_START = dt.datetime(2000, 1, 1, tzinfo=dt.UTC)
_SWITCH = dt.datetime(2024, 1, 16, tzinfo=dt.UTC)
FACTORS = [("click", 48, _START, None), ("view", 490, _START, _SWITCH), ("view", 510, _SWITCH, None),
           ("purchase", 12, _START, None), ("signup", None, _START, None)]
KINDS = [("click", "Renewable", True, True), ("view", "Fossil", False, False), ("purchase", "Nuclear", False, True),
         ("signup", "Other", False, False), ("error", "Storage", False, False)]


def factors(spark: SparkSession) -> DataFrame:
    values = [(k, None if f is None else Decimal(f), a, b) for k, f, a, b in FACTORS]
    return rows(spark, "psr_type_code string, lifecycle_gco2e_per_kwh decimal(6,1), valid_from timestamp, valid_to timestamp", values)


def kinds(spark: SparkSession) -> DataFrame:
    return rows(spark, "psr_type_code string, fuel_category string, is_renewable boolean, is_low_carbon boolean", KINDS)


def _resolution(number: str):
    return F.when(F.col(number) % 3 == 0, 60).otherwise(15)


def _area(key: str, prefix: str = "A"):
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def intervals(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(
        "event_id", F.concat(F.lit("A"), (F.col("user_id") % AREAS).cast("string")).alias("area_code"),
        F.col("ts").alias("ts_utc"), _resolution("event_id").alias("resolution_minutes"),
        F.col("event_type").alias("psr_type_code"),
        F.when(F.col("event_type") == "error", "consumption").otherwise("generation").alias("direction"),
        "value", energy_mwh("value", _resolution("event_id")).alias("energy_mwh"))


def loads(spark: SparkSession, sf: str) -> DataFrame:
    return intervals(spark, sf).withColumn("load_mw", F.col("value"))


def prices(spark: SparkSession, sf: str) -> DataFrame:
    return intervals(spark, sf).withColumn("price_eur_mwh", F.col("value") - 250)


def flows(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as border flows. Nations are attached to orders before the large join, so
    that it carries two short columns per side."""
    receiver = (table(spark, sf, "orders").select("o_orderkey", "o_custkey")
                .join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
                .select(F.col("o_orderkey").alias("l_orderkey"), _area("c_nationkey").alias("to_area_code")))
    sender = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), _area("s_nationkey").alias("from_area_code"))
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    minutes = _resolution("l_linenumber")
    return (items.join(sender, "l_suppkey").join(receiver, "l_orderkey")
            .select("from_area_code", "to_area_code", F.col("l_shipdate").alias("ts_utc"), minutes.alias("resolution_minutes"),
                    F.col("l_quantity").alias("flow_mw"), energy_mwh("l_quantity", minutes).alias("energy_mwh")))


def areas(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    return n.select(_area("n_nationkey").alias("area_code"), F.col("n_name").alias("area_name"),
                    _area("n_regionkey", "C").alias("country_code"),
                    F.col("n_regionkey").isin(0, 1, 2).alias("is_country_area"),
                    F.col("n_regionkey").isin(2, 3, 4).alias("is_bidding_zone"),
                    F.concat(F.lit("EIC-"), F.col("n_name")).alias("eic_code"))


def countries(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "region")
    return r.select(_area("r_regionkey", "C").alias("country_code"), F.col("r_name").alias("country_name"),
                    F.lit("UTC").alias("time_zone"), (F.col("r_name") != "ASIA").alias("is_active"))


def thresholds(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "region")
    key = F.col("r_regionkey")
    return r.select(_area("r_regionkey", "C").alias("country_code"),
                    (key * 10 + 300).cast("decimal(8,2)").alias("carbon_intensity_alert_gco2e_per_kwh"),
                    (key * 10 + 20).cast("decimal(6,2)").alias("renewable_share_target_pct"))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Events as weather readings per location and hour, several per hour."""
    kind, v = F.col("event_type"), F.col("value")
    country = table(spark, sf, "nation").select(_area("n_nationkey", "L").alias("location_code"),
                                                _area("n_regionkey", "C").alias("country_code"))
    e = table(spark, sf, "events").select(
        F.concat(F.lit("L"), (F.col("user_id") % AREAS).cast("string")).alias("location_code"),
        F.date_trunc("hour", "ts").cast("timestamp").alias("ts_utc"),
        (v - 100).alias("temperature_2m"), F.lit(None).cast("double").alias("wind_speed_10m"),
        F.when(kind != "signup", v).alias("wind_speed_100m"), (v * 2).alias("shortwave_radiation"),
        (F.col("event_id") % 101).cast("double").alias("cloud_cover"), F.when(kind != "error", v).alias("precipitation"),
        F.when(kind.isin("click", "view", "purchase"), "archive").otherwise("forecast").alias("data_source"),
        F.col("ts").cast("timestamp").alias("_bronze_ingested_at"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("_source_file"))
    return e.join(country, "location_code")


def locations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(_area("n_nationkey", "L").alias("location_code"),
                                             (F.col("n_nationkey") % 3 + 1).cast("double").alias("weight"))


class _Lazy(Mapping):
    """Tables built when first asked for."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def generation_fact(spark: SparkSession, sf: str) -> DataFrame:
    return gold.generation_hourly(intervals(spark, sf), areas(spark, sf), factors(spark), LOADED_AT)


def carbon_fact(spark: SparkSession, sf: str) -> DataFrame:
    return gold.carbon_hourly(generation_fact(spark, sf), kinds(spark), LOADED_AT)


def country_weather(spark: SparkSession, sf: str) -> DataFrame:
    return silver.country_weather(silver.best_weather(weather(spark, sf)), locations(spark, sf))


def _days(spark: SparkSession, sf: str) -> DataFrame:
    """The date dimension over all days that any fact of the star can have."""
    instants = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
    spans = [table(spark, sf, t).select(date_key(c).alias("date_key")) for t, c in instants.items()]
    return gold.dim_date(gold.fact_bounds(*spans))


def star(spark: SparkSession, sf: str) -> Star:
    return Star(
        _Lazy({
            "generation": lambda: generation_fact(spark, sf),
            "carbon": lambda: carbon_fact(spark, sf),
            "load": lambda: gold.load_hourly(loads(spark, sf), areas(spark, sf), LOADED_AT),
            "price": lambda: gold.price_hourly(prices(spark, sf), areas(spark, sf), LOADED_AT),
            "flow": lambda: gold.flow_hourly(flows(spark, sf), areas(spark, sf), LOADED_AT),
            "weather": lambda: gold.weather_hourly(country_weather(spark, sf), LOADED_AT),
            "threshold": lambda: thresholds(spark, sf),
        }),
        _Lazy({
            "date": lambda: _days(spark, sf),
            "hour": lambda: gold.dim_hour(spark),
            "country": lambda: countries(spark, sf),
            "area": lambda: areas(spark, sf).drop("country_code"),
            "production_type": lambda: kinds(spark),
        }))


# ---- the same views as SQL, in whole units so that rounding is exact -----------------------
# e4: energy in 1e-4 MWh; *3: thousandths; *2: hundredths.

CTES = {
    "iv": """iv AS (SELECT event_id, ts, 'A' || (user_id % 25) AS area_code, event_type AS psr, value,
  CASE WHEN event_id % 3 = 0 THEN 60 ELSE 15 END AS res, CAST(round(value * 100) AS BIGINT) AS v2,
  CAST(round(value * 100) AS BIGINT) * CASE WHEN event_id % 3 = 0 THEN 100 ELSE 25 END AS e4,
  date_trunc('hour', ts) AS h FROM events)""",
    "area": """area AS (SELECT 'A' || n_nationkey AS area_code, 'C' || n_regionkey AS country_code, n_name AS area_name,
  r_name AS country_name FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "ef": """ef(psr, f10, valid_from, valid_to) AS (VALUES
  ('click', 480, TIMESTAMP '2000-01-01', CAST(NULL AS TIMESTAMP)), ('view', 4900, TIMESTAMP '2000-01-01', TIMESTAMP '2024-01-16'),
  ('view', 5100, TIMESTAMP '2024-01-16', NULL), ('purchase', 120, TIMESTAMP '2000-01-01', NULL),
  ('signup', NULL, TIMESTAMP '2000-01-01', NULL))""",
    "kind": """kind(psr, fuel_category, is_renewable, is_low_carbon) AS (VALUES ('click', 'Renewable', true, true),
  ('view', 'Fossil', false, false), ('purchase', 'Nuclear', false, true), ('signup', 'Other', false, false),
  ('error', 'Storage', false, false))""",
    "gen": f"""gen AS (SELECT x.h, x.area_code, a.country_code, a.country_name, x.psr, x.cov,
  {half_up('x.s4', '10')} AS g3, {half_up('x.s4 * ef.f10', '100')} AS c3
  FROM (SELECT h, area_code, psr, sum(e4) AS s4, sum(res) AS cov FROM iv WHERE psr <> 'error' GROUP BY ALL) x
  JOIN area a ON a.area_code = x.area_code
  LEFT JOIN ef ON ef.psr = x.psr AND x.h >= ef.valid_from AND (ef.valid_to IS NULL OR x.h < ef.valid_to))""",
    "carbon": """carbon AS (SELECT h, country_code, country_name, sum(g3) AS t, sum(CASE WHEN is_renewable THEN g3 ELSE 0 END) AS r,
  sum(CASE WHEN is_low_carbon THEN g3 ELSE 0 END) AS l, sum(CASE WHEN f10 IS NULL THEN 0 ELSE g3 END) AS v, sum(c3) AS c
  FROM (SELECT gen.*, kind.is_renewable, kind.is_low_carbon, CASE WHEN gen.psr = 'signup' THEN NULL ELSE gen.c3 END AS f10
        FROM gen JOIN kind USING (psr)) GROUP BY h, country_code, country_name)""",
    "loadf": f"""loadf AS (SELECT x.h, x.area_code, a.country_code, a.country_name, x.cov, {half_up('x.s4', '10')} AS load3,
  {half_up('x.s4 * 60', 'x.cov * 10')} AS avg3
  FROM (SELECT h, area_code, sum(e4) AS s4, sum(res) AS cov FROM iv GROUP BY ALL) x JOIN area a USING (area_code))""",
    "pricef": f"""pricef AS (SELECT h, area_code, country_code, country_name, res, n, {half_up('s2', 'n')} AS p2, lo2, hi2 FROM (
  SELECT x.*, a.country_code, a.country_name, row_number() OVER (PARTITION BY x.area_code, h ORDER BY CASE WHEN res = 60 THEN 0 ELSE 1 END, res) AS k
  FROM (SELECT h, area_code, res, count(*) AS n, sum(v2 - 25000) AS s2, min(v2 - 25000) AS lo2, max(v2 - 25000) AS hi2
        FROM iv GROUP BY ALL) x JOIN area a ON a.area_code = x.area_code) WHERE k = 1)""",
    "flowf": f"""flowf AS (SELECT x.h, fa, ta, fc, tc, res, cov, {half_up('s4', '10')} AS f3 FROM (
  SELECT y.*, row_number() OVER (PARTITION BY fa, ta, h ORDER BY cov DESC, res) AS k FROM (
    SELECT date_trunc('hour', l_shipdate) AS h, 'A' || s_nationkey AS fa, 'A' || c_nationkey AS ta,
      'C' || sn.n_regionkey AS fc, 'C' || cn.n_regionkey AS tc,
      CASE WHEN l_linenumber % 3 = 0 THEN 60 ELSE 15 END AS res,
      sum(CAST(round(l_quantity * 100) AS BIGINT) * CASE WHEN l_linenumber % 3 = 0 THEN 100 ELSE 25 END) AS s4,
      sum(CASE WHEN l_linenumber % 3 = 0 THEN 60 ELSE 15 END) AS cov
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON sn.n_nationkey = s_nationkey
    JOIN nation cn ON cn.n_nationkey = c_nationkey GROUP BY ALL) y) x WHERE k = 1)""",
    "wx": """wx AS (SELECT * FROM (SELECT 'L' || (user_id % 25) AS loc, 'C' || n_regionkey AS country_code, r_name AS country_name,
  date_trunc('hour', ts) AS h, event_id, event_type, CAST(round(value * 100) AS BIGINT) AS v2, event_id % 101 AS cloud,
  CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'archive' ELSE 'forecast' END AS src, n_nationkey % 3 + 1 AS w,
  row_number() OVER (PARTITION BY user_id % 25, date_trunc('hour', ts)
    ORDER BY CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 0 ELSE 1 END, ts DESC, event_id DESC) AS k
  FROM events JOIN nation ON n_nationkey = user_id % 25 JOIN region ON n_regionkey = r_regionkey) WHERE k = 1)""",
    "wxc": """wxc AS (SELECT country_code, country_name, h, sum((v2 - 10000) * w) AS temp_n, sum(w) AS w_all,
  sum(CASE WHEN event_type <> 'signup' THEN v2 * w END) AS wind_n, sum(CASE WHEN event_type <> 'signup' THEN w END) AS wind_w,
  sum(2 * v2 * w) AS solar_n, sum(100 * cloud * w) AS cloud_n, sum(CASE WHEN event_type <> 'error' THEN v2 * w END) AS rain_n,
  sum(CASE WHEN event_type <> 'error' THEN w END) AS rain_w, sum(CASE WHEN src = 'archive' THEN w ELSE 0 END) AS w_arch
  FROM wx GROUP BY country_code, country_name, h)""",
    "weatherf": f"""weatherf AS (SELECT h, country_code, country_name, {half_up('temp_n', 'w_all')} AS temp2,
  {half_up('wind_n', 'wind_w')} AS wind2, {half_up('solar_n', 'w_all')} AS solar2, {half_up('cloud_n', 'w_all')} AS cloud2,
  {half_up('rain_n', 'rain_w')} AS rain2, {half_up('w_arch * 1000', 'w_all')} AS arch3, w_arch = w_all AS observed FROM wxc)""",
}

NEEDS = {
    "gen": ["iv", "area", "ef", "gen"],
    "carbon": ["iv", "area", "ef", "kind", "gen", "carbon"],
    "loadf": ["iv", "area", "loadf"],
    "pricef": ["iv", "area", "pricef"],
    "flowf": ["area", "flowf"],
    "weatherf": ["area", "wx", "wxc", "weatherf"],
}


def ctes(*names: str) -> str:
    """The WITH clause holding the named views and everything below them."""
    wanted = list(dict.fromkeys(n for name in names for n in NEEDS.get(name, [name])))
    return "WITH " + ",\n".join(CTES[n] for n in wanted) + "\n"
