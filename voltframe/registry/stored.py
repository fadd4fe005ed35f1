"""Stored, day-partitioned tables: gold from changes, the star over stored facts, clustering, audit log and seeded reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltframe.functions.scalars import date_key
from voltframe.operators import planning
from voltframe.operators.tables import Day, Lake
from voltframe.plans import gold, pipeline, silver
from voltframe.plans.measures import GREENEST_HOUR, MEASURES, evaluate
from voltframe.registry import measures as sql
from voltframe.registry import views
from voltframe.registry.base import half_up, plain, query, rounded, table
from voltframe.schemas import KEYS, LINEAGE, TABLES, align, describe
from voltframe.session import new_folder

AS_OF = "2024-03-01 00:00:00"


def _types(spark) -> DataFrame:
    """The production types with the factor that is in force at the end."""
    now = views.factors(spark).where("valid_to IS NULL").select("psr_type_code", "lifecycle_gco2e_per_kwh")
    return views.kinds(spark).join(now, "psr_type_code", "left").withColumns(
        {"grid_name": F.col("psr_type_code"), "emission_factor_source": F.lit("given")})


def _hours(spark, sf) -> DataFrame:
    """One interval per area, type and hour: the largest value."""
    hour = F.date_trunc("hour", "ts_utc").cast("timestamp")
    return views.intervals(spark, sf).groupBy("area_code", "psr_type_code", "direction", hour.alias("ts_utc")).agg(F.max("value").alias("power_mw")).withColumns(
        {"resolution_minutes": F.lit(60), "_source_file": F.lit("first"), "_bronze_ingested_at": F.lit("2024-02-01").cast("timestamp"),
         "_silver_updated_at": F.lit(AS_OF).cast("timestamp")})


def _put_generation(store: Lake, rows: DataFrame) -> None:
    table_, keys = "silver_generation", KEYS["silver_generation"]
    whole = rows.withColumns({"energy_mwh": F.col("power_mw"), "co2e_kg": F.lit(None).cast("double")})
    store.upsert(table_, align(whole, TABLES[table_], table_), keys, lineage=LINEAGE, guard=silver.not_older,
                 note=silver.touched(store, table_, "area_code", AS_OF))


_CORRECTED = "area_code IN ('A3', 'A7') AND h >= TIMESTAMP '2024-01-05' AND h < TIMESTAMP '2024-01-07' OR area_code = 'A11' AND h = TIMESTAMP '2024-01-12 05:00:00'"
_CORRECTED_SQL = f"""
raw AS (SELECT area_code, psr, h, max(v2) * 10 + CASE WHEN {_CORRECTED} THEN 10000 ELSE 0 END AS g3 FROM iv WHERE psr <> 'error' GROUP BY area_code, psr, h),
priced AS (SELECT raw.*, country_code, CASE psr WHEN 'click' THEN 480 WHEN 'view' THEN 5100 WHEN 'purchase' THEN 120 END AS f10, is_renewable
           FROM raw JOIN area USING (area_code) JOIN kind USING (psr)),
costed AS (SELECT *, {half_up('g3 * f10', '10')} AS c3 FROM priced)"""


@query("gold_from_changes", views.ctes("iv", "area", "kind").rstrip() + f",{_CORRECTED_SQL}" + """
SELECT CAST(strftime(h, '%Y%m%d') AS BIGINT) AS date_key, h AS ts_hour_utc, country_code, CAST(sum(g3) AS DOUBLE) / 1000 AS total_generation_mwh,
  CAST(sum(CASE WHEN is_renewable THEN g3 ELSE 0 END) AS DOUBLE) / 1000 AS renewable_mwh, CAST(sum(CASE WHEN f10 IS NULL THEN NULL ELSE c3 END) AS DOUBLE) / 1000 AS co2e_kg,
  true AS only_touched_days FROM costed GROUP BY ALL""")
def gold_from_changes(spark, sf):
    """Corrections of two areas on two days and one hour of a third, all far older than the reload window: gold computes those
    hours again and leaves the files of all other days alone."""
    store = pipeline.lake(spark, new_folder(spark, "changes"))
    given = (views.countries(spark, sf), views.areas(spark, sf), _types(spark))
    rows = store.staged("hours", _hours(spark, sf))
    _put_generation(store, rows)
    pipeline.load_gold_changes(store, *given, "2024-02-02 00:00:00")
    before = {t: store.stamps(t) for t in ("fact_generation_hourly", "fact_carbon_hourly")}
    late = rows.withColumn("h", F.col("ts_utc")).where(_CORRECTED.replace("TIMESTAMP", "TIMESTAMP ")).drop("h")
    _put_generation(store, late.withColumns({"power_mw": F.col("power_mw") + 10, "_source_file": F.lit("second"),
                                             "_bronze_ingested_at": F.lit("2024-02-20").cast("timestamp")}))
    opened = set(pipeline.load_gold_changes(store, *given, AS_OF))
    changed = {d for t, old in before.items() for d, stamp in store.stamps(t).items() if old.get(d) != stamp}
    fact = store.read("fact_carbon_hourly").select("date_key", "ts_hour_utc", "country_code", "total_generation_mwh", "renewable_mwh", "co2e_kg")
    return plain(fact.withColumn("only_touched_days", F.lit(changed == opened and store.read("ctl_touched_hours").isEmpty())))


_WEEKEND_VIEWS = {v: f"w_{v} AS (SELECT * FROM {v} WHERE isodow(h) >= 6)" for v in ("carbon", "gen", "loadf", "pricef", "flowf", "weatherf")}
_WEEKEND_BORDER = """w_border AS (SELECT country_name, ex, im FROM (SELECT fc AS country_code, f3 AS ex, NULL AS im FROM w_flowf
  UNION ALL SELECT tc, NULL, f3 FROM w_flowf) JOIN (SELECT DISTINCT country_code, country_name FROM area) USING (country_code))"""
LAKE_MEASURES = [*MEASURES, GREENEST_HOUR]


def _lake_sql() -> str:
    share, target = sql._div("sum(r)", "sum(t)"), "(SELECT CAST(target AS DOUBLE) / 100 FROM threshold x WHERE x.country_name = w_carbon.country_name)"
    exprs = {m: (("threshold" if v == "threshold" else f"w_{v}"), e) for m, (v, e) in sql._SQL.items()}
    exprs |= {"renewable_gap": ("w_carbon", f"{share} - {target}"), "renewable_gap_pp": ("w_carbon", f"({share} - {target}) * 100")}
    parts = [f"LEFT JOIN (SELECT country_name, {sql._value(m, e)} FROM {v} GROUP BY country_name) USING (country_name)" for m, (v, e) in exprs.items()]
    hours = f"(SELECT country_name, hour(h) AS k, {sql._div('sum(c)', 'sum(v)')} AS ci FROM w_carbon GROUP BY ALL HAVING sum(v) > 0)"
    best = f"LEFT JOIN (SELECT country_name, CAST(arg_min(k, (ci, k)) AS BIGINT) AS greenest_hour FROM {hours} GROUP BY country_name) USING (country_name)"
    head = views.ctes("carbon", "gen", "loadf", "pricef", "flowf", "weatherf").rstrip()
    withs = ",\n".join([head, *_WEEKEND_VIEWS.values(), _WEEKEND_BORDER, sql._THRESHOLD])
    return f"{withs}\nSELECT * FROM (SELECT DISTINCT country_name FROM area) " + "\n".join([*parts, best])


def stored_star(spark, sf) -> Lake:
    """All facts and dimensions of the star in a lake, the facts of hours partitioned by day."""
    star = views.star(spark, sf)
    # Flows span years here and would make thousands of small days; the others are partitioned as the daily job does.
    store = Lake(spark, new_folder(spark, "star"), TABLES, {t: d for t, d in pipeline.DAYS.items() if t != "fact_flow_hourly"})
    for fact in ("load", "generation", "carbon", "price", "flow", "weather"):
        store.append(f"fact_{fact}_hourly", star.facts[fact])
    store.overwrite("dim_date", star.dims["date"])
    store.overwrite("dim_hour", star.dims["hour"])
    store.overwrite("dim_country", gold.dim_country(views.countries(spark, sf)))
    store.overwrite("dim_area", gold.dim_area(views.areas(spark, sf), views.countries(spark, sf)))
    store.overwrite("dim_production_type", gold.dim_production_type(_types(spark)))
    limits = star.facts["threshold"].withColumns({"valid_from": F.lit("2024-01-01").cast("date"), "owner": F.lit(None), "note": F.lit(None),
                                                  "price_spike_alert_eur_per_mwh": F.lit(None)})
    store.overwrite("dim_kpi_threshold", limits)
    return store


@query("lake_measures", _lake_sql())
def lake_measures(spark, sf):
    """Every measure by country over the stored star, on weekends: the filter on the date dimension prunes the days of the facts."""
    found = evaluate(pipeline.star(stored_star(spark, sf)), LAKE_MEASURES, ["country_name"], [("day_of_week", F.col("day_of_week") >= 6)])
    return sql._clean(found, *MEASURES)


@query("table_compact_clustered", """
SELECT user_id, count(*) AS n, CAST(max(event_id) AS BIGINT) AS last_id, true AS fewer_files FROM events GROUP BY 1""")
def table_compact_clustered(spark, sf):
    """Days written in many small files of mixed users are packed in order of user: the rows of a user lie in fewer files."""
    store = Lake(spark, new_folder(spark, "cluster"), {"events": describe("event_id bigint\nuser_id bigint\nts timestamp")}, {"events": Day(ts="ts")})
    rows = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    week = rows.where("ts < TIMESTAMP '2024-01-04'")
    store.append("events", rows.where("ts >= TIMESTAMP '2024-01-04'"))
    for i in range(4):
        store.append("events", week.where(F.col("event_id") % 4 == i))

    def spread() -> int:
        """Files that hold rows of a user, summed over users, in the crowded days."""
        stored = spark.read.parquet(store.path("events")).where("date_key < 20240104")
        return stored.select("user_id", "date_key", F.col("_metadata.file_path")).distinct().count()

    before = spread()
    store.compact("events", above=2, rows_per_file=max(1, week.count() // 12), cluster_by=["user_id"])
    fewer = spread() < before
    return plain(store.read("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"), F.lit(fewer).alias("fewer_files")))


@query("audit_log", """
WITH d AS (SELECT o_orderpriority AS dataset, 'K' || (o_custkey % 20) AS area_key, date_trunc('month', o_orderdate) AS s, count(*) AS n FROM orders GROUP BY ALL),
l AS (SELECT *, CASE WHEN n % 7 = 0 AND s < TIMESTAMP '1997-01-01' THEN 'error' WHEN n % 5 = 0 THEN 'no_data' ELSE 'ok' END AS status FROM d)
SELECT l.dataset, l.area_key, count(*) AS chunks, count(*) FILTER (status = 'error') AS errors, CAST(sum(CASE WHEN status = 'ok' THEN n END) AS BIGINT) AS points,
  CASE WHEN count(*) FILTER (status = 'error') = 0 THEN max(s) + INTERVAL 1 MONTH END AS loaded_until_utc FROM l GROUP BY ALL""")
def audit_log(spark, sf):
    """Finished chunks, one per order priority, customer group and month, go into the audit log, and the watermarks of targets
    without a failure move on."""
    store = pipeline.lake(spark, new_folder(spark, "audit"))
    start = F.date_trunc("month", "o_orderdate").cast("timestamp")
    done = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("dataset"), F.concat(F.lit("K"), (F.col("o_custkey") % 20).cast("string")).alias("area_key"),
                                              start.alias("chunk_start")).agg(F.count(F.lit(1)).alias("n"))
    status = F.when((F.col("n") % 7 == 0) & (F.col("chunk_start") < F.lit("1997-01-01").cast("timestamp")), "error").when(F.col("n") % 5 == 0, "no_data").otherwise("ok")
    done = done.withColumns({"chunk_end": F.col("chunk_start") + F.expr("INTERVAL 1 MONTH"), "status": status}).withColumns(
        {"file_path": F.when(F.col("status") == "ok", F.concat_ws("/", "dataset", "area_key")), "bytes": F.col("n") * 100,
         "points": F.when(F.col("status") == "ok", F.col("n")), "error_message": F.when(F.col("status") == "error", "timeout")})
    pipeline.record_run(store, done, "run-1", silver.GRID_SOURCE, "2030-01-01 00:00:00")
    log = store.read("ctl_ingest_log").groupBy("dataset", "area_key").agg(
        F.count(F.lit(1)).alias("chunks"), F.count_if(F.col("status") == "error").alias("errors"), F.sum("points").alias("points"))
    marks = store.read("ctl_watermark").select("dataset", "area_key", "loaded_until_utc")
    return plain(log.join(marks, ["dataset", "area_key"], "left"))


@query("seeded_areas", """
WITH c(i, country_code) AS (SELECT row_number() OVER (ORDER BY code) - 1, code FROM (VALUES ('AT'), ('BE'), ('CH'), ('CZ'), ('DE'), ('ES'), ('FR'), ('IT'), ('NL'), ('PL'), ('PT'), ('SI')) v(code))
SELECT country_code, count(*) AS customers FROM customer JOIN c ON c_nationkey % 12 = i GROUP BY 1""")
def seeded_areas(spark, sf):
    """Customers by the countries of the seeded reference, which a second seeding leaves as they are."""
    store = pipeline.lake(spark, new_folder(spark, "seed"))
    pipeline.seed_reference(store)
    if any(any(c) for c in pipeline.seed_reference(store).values()):
        raise ValueError("a second seeding changed the reference")
    codes = store.read("country").agg(F.array_sort(F.collect_list("country_code")).alias("codes")).select(F.posexplode("codes").alias("i", "country_code"))
    customers = table(spark, sf, "customer").select((F.col("c_nationkey") % 12).alias("i"))
    return plain(customers.join(codes, "i").groupBy("country_code").agg(F.count(F.lit(1)).alias("customers")))
