"""Merges, history, window replacement, change feed, and the same on stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltframe.functions.scalars import date_key
from voltframe.operators import merge
from voltframe.operators.series import validity_join
from voltframe.operators.tables import Day, Lake
from voltframe.plans import gold
from voltframe.registry import views
from voltframe.registry.base import plain, query, table
from voltframe.schemas import describe
from voltframe.session import new_folder

# Target: orders before 1999. Source: orders from 1998 on, some of them edited.
_SIDES = """
WITH t AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, 'old' AS batch FROM orders WHERE o_orderdate < DATE '1999-01-01'),
s AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'O' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice, 'x' || o_orderpriority AS o_orderpriority, 'new' AS batch
  FROM orders WHERE o_orderdate >= DATE '1998-01-01'),
j AS (SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_orderkey IS NOT NULL AS in_t, s.o_orderkey IS NOT NULL AS in_s,
  t.o_orderstatus AS ts, s.o_orderstatus AS ss, t.o_totalprice AS tp, s.o_totalprice AS sp, t.o_orderpriority AS tq, s.o_orderpriority AS sq,
  t.batch AS tb, s.batch AS sb,
  t.o_orderstatus IS DISTINCT FROM s.o_orderstatus OR t.o_totalprice IS DISTINCT FROM s.o_totalprice AS differs
  FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey)
"""


def _final(action: str) -> str:
    new = "_action IN ('insert', 'update')"
    return _SIDES + f""", a AS (SELECT *, {action} AS _action FROM j)
SELECT o_orderkey, CASE WHEN {new} THEN ss ELSE ts END AS o_orderstatus, CASE WHEN {new} THEN sp ELSE tp END AS o_totalprice,
  CASE WHEN _action = 'insert' THEN sq ELSE tq END AS o_orderpriority, CASE WHEN {new} THEN sb ELSE tb END AS batch, _action
FROM a WHERE _action IS NOT NULL"""


def _sides(spark, sf):
    o = table(spark, sf, "orders")
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    target = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(*columns, F.lit("old").alias("batch"))
    source = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", "O").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice"),
        F.concat(F.lit("x"), "o_orderpriority").alias("o_orderpriority"), F.lit("new").alias("batch"))
    return target, source


_OPTIONS = {"lineage": ["batch"], "insert_only": ["o_orderpriority"]}


@query("merge_actions", _final("CASE WHEN in_t AND in_s AND differs THEN 'update' WHEN in_t THEN 'keep' ELSE 'insert' END"))
def merge_actions(spark, sf):
    return plain(merge.merge(*_sides(spark, sf), ["o_orderkey"], **_OPTIONS))


@query("merge_guarded", _final("""CASE WHEN in_t AND in_s AND differs AND NOT (ts = 'F' AND ss = 'O') THEN 'update'
  WHEN in_t THEN 'keep' ELSE 'insert' END"""))
def merge_guarded(spark, sf):
    return plain(merge.merge(*_sides(spark, sf), ["o_orderkey"], **_OPTIONS,
                             guard=lambda old, new: ~((old("o_orderstatus") == "F") & (new("o_orderstatus") == "O"))))


@query("merge_snapshot", _final("""CASE WHEN in_t AND in_s AND differs THEN 'update' WHEN in_t AND in_s THEN 'keep'
  WHEN in_t THEN 'delete' ELSE 'insert' END"""))
def merge_snapshot(spark, sf):
    return plain(merge.merge(*_sides(spark, sf), ["o_orderkey"], **_OPTIONS, delete_missing=True))


@query("merge_always_update", _final("CASE WHEN in_t AND in_s THEN 'update' WHEN in_t THEN 'keep' ELSE 'insert' END"))
def merge_always_update(spark, sf):
    return plain(merge.merge(*_sides(spark, sf), ["o_orderkey"], **_OPTIONS, test_change=False))


@query("merge_insert_only", """
SELECT o_orderkey, 'old' AS batch, 'keep' AS _action FROM orders WHERE o_orderdate < DATE '1999-01-01' UNION ALL
SELECT o_orderkey, 'new', 'insert' FROM orders WHERE o_orderdate >= DATE '1999-01-01'""")
def merge_insert_only(spark, sf):
    target, source = _sides(spark, sf)
    return plain(merge.insert_missing(target, source, ["o_orderkey"]).select("o_orderkey", "batch", "_action"))


@query("merge_action_counts", """
SELECT CASE WHEN o_orderdate >= DATE '1999-01-01' THEN 'insert'
  WHEN o_orderdate >= DATE '1998-01-01' AND (o_orderstatus = 'P' OR (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'O')) THEN 'update'
  ELSE 'keep' END AS _action, count(*) AS rows FROM orders GROUP BY 1""")
def merge_action_counts(spark, sf):
    return plain(merge.action_counts(merge.merge(*_sides(spark, sf), ["o_orderkey"], **_OPTIONS)))


@query("merge_null_keys", """
WITH d AS (SELECT d.doc_id, quality, lang FROM documents d LEFT JOIN labels USING (doc_id))
SELECT lang, CAST(quality AS BIGINT) AS quality, 'keep' AS _action, count(*) AS n FROM d GROUP BY ALL
UNION ALL SELECT lang, NULL, 'insert', count(*) FROM d WHERE quality IS NULL GROUP BY ALL""")
def merge_null_keys(spark, sf):
    """Rows whose key is NULL never match, however many there are."""
    d = (table(spark, sf, "documents").select("doc_id", "lang")
         .join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
         .select(F.when(F.col("quality").isNotNull(), F.col("doc_id")).alias("k"), "doc_id", "lang", "quality"))
    merged = merge.merge(d, d, ["k"])
    return plain(merged.groupBy("lang", F.col("quality").cast("bigint").alias("quality"), "_action").agg(F.count(F.lit(1)).alias("n")))


@query("state_upsert", """
WITH t AS (SELECT event_type AS dataset, max(ts) AS until FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> 'signup' GROUP BY 1),
s AS (SELECT event_type AS dataset, max(ts) AS until FROM events GROUP BY 1)
SELECT dataset, s.until AS processed_until_ingested_at, CASE WHEN t.dataset IS NULL THEN 'insert' ELSE 'update' END AS _action
FROM s LEFT JOIN t USING (dataset)""")
def state_upsert(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_type").alias("dataset"), "ts")

    def until(df):
        return df.groupBy("dataset").agg(F.max("ts").alias("processed_until_ingested_at"))

    early = e.where((F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")) & (F.col("dataset") != "signup"))
    return plain(merge.merge(until(early), until(e), ["dataset"], test_change=False))


# ---- history ---------------------------------------------------------------------------

_NOW = "2024-02-01 00:00:00"
_DIM = """
WITH src AS (SELECT p_partkey AS code, CASE WHEN p_type = 'ECONOMY' THEN p_retailprice + 1 WHEN p_type = 'PROMO' THEN NULL ELSE p_retailprice END AS factor,
  CASE WHEN p_brand = 'Brand#1' THEN '' ELSE p_brand END AS origin FROM part WHERE p_size >= 5),
dim AS (SELECT p_partkey AS code, p_retailprice AS factor, CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE p_brand END AS origin,
  TIMESTAMP '2010-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current FROM part WHERE p_size <= 40
  UNION ALL SELECT p_partkey, 1.0, 'old', TIMESTAMP '2000-01-01', TIMESTAMP '2010-01-01', false FROM part WHERE p_size <= 20),
cmp AS (SELECT dim.*, src.code IS NOT NULL AND (coalesce(src.factor, -1) <> coalesce(dim.factor, -1) OR coalesce(src.origin, '') <> coalesce(dim.origin, '')) AS changed
  FROM dim LEFT JOIN src ON src.code = dim.code AND dim.is_current),
nxt AS (
SELECT code, factor, origin, valid_from, CASE WHEN changed THEN TIMESTAMP '2024-02-01' ELSE valid_to END AS valid_to,
  is_current AND NOT changed AS is_current, CASE WHEN changed THEN 'close' ELSE 'keep' END AS _action FROM cmp
UNION ALL SELECT code, factor, origin, TIMESTAMP '2024-02-01', NULL, true, 'insert' FROM src
  WHERE code NOT IN (SELECT code FROM cmp WHERE is_current AND NOT changed))
"""


def _history(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("code"), "p_retailprice", "p_brand", "p_type", "p_size")

    def at(text):
        return F.lit(text).cast("timestamp")

    price = (F.when(F.col("p_type") == "ECONOMY", F.col("p_retailprice") + 1)
             .when(F.col("p_type") == "PROMO", F.lit(None)).otherwise(F.col("p_retailprice")))
    brand_1 = F.col("p_brand") == "Brand#1"
    source = p.where("p_size >= 5").select("code", price.alias("factor"), F.when(brand_1, "").otherwise(F.col("p_brand")).alias("origin"))
    versions = F.array(
        F.struct(F.col("p_retailprice").alias("factor"), F.when(~brand_1, F.col("p_brand")).alias("origin"), at("2010-01-01").alias("valid_from"),
                 F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current")),
        F.struct(F.lit(1.0).alias("factor"), F.lit("old").alias("origin"), at("2000-01-01").alias("valid_from"),
                 at("2010-01-01").alias("valid_to"), F.lit(False).alias("is_current")))
    kept = F.when(F.col("p_size") <= 20, versions).otherwise(F.slice(versions, 1, 1))
    dimension = p.where("p_size <= 40").select("code", F.inline(kept))
    return merge.scd2(dimension, source, "code", {"factor": -1, "origin": ""}, _NOW, first_load=False)


@query("scd2_apply", _DIM + "SELECT * FROM nxt")
def scd2_apply(spark, sf):
    return plain(_history(spark, sf))


@query("scd2_asof", _DIM + """
SELECT date_trunc('month', l_shipdate) AS month, count(*) AS n, count(origin) AS with_version,
  CAST(round(sum(CAST(round(factor * 100) AS BIGINT) * CAST(l_quantity AS BIGINT)) / 100.0, 2) AS DOUBLE) AS priced
FROM lineitem LEFT JOIN nxt ON nxt.code = l_partkey AND l_shipdate >= valid_from - INTERVAL 10 YEAR AND (valid_to IS NULL OR l_shipdate < valid_to - INTERVAL 10 YEAR)
GROUP BY 1""")
def scd2_asof(spark, sf):
    """Line items priced with the part version valid on the ship date (history moved ten years back)."""


    back = F.expr("INTERVAL 10 YEAR")
    versions = _history(spark, sf).select(F.col("code").alias("l_partkey"), "factor", "origin", (F.col("valid_from") - back).alias("valid_from"),
                                          (F.col("valid_to") - back).alias("valid_to"))
    items = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", F.col("l_shipdate").cast("timestamp").alias("at"))
    priced = validity_join(items, versions, "l_partkey", "at")
    cents = F.sum(F.round(F.col("factor") * 100).cast("bigint") * F.col("l_quantity").cast("bigint"))
    return plain(priced.groupBy(F.date_trunc("month", "at").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.count("origin").alias("with_version"), F.round(cents / F.lit(100.0), 2).alias("priced")))


# ---- replacement and change feed ---------------------------------------------------------


@query("delete_insert_window", """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate < DATE '2000-01-01'
UNION ALL SELECT o_orderkey, o_orderdate, round(o_totalprice * 2, 2) FROM orders WHERE o_orderdate >= DATE '2000-01-01' AND o_orderstatus <> 'P'""")
def delete_insert_window(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    edge = F.lit("2000-01-01").cast("timestamp_ntz")
    fresh = o.where((F.col("o_orderdate") >= edge) & (F.col("o_orderstatus") != "P")).withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    return plain(merge.replace_window(o.drop("o_orderstatus"), fresh.drop("o_orderstatus"), "o_orderdate", "2000-01-01"))


@query("snapshot_diff", _SIDES + """
SELECT o_orderkey, ts AS o_orderstatus, tp AS o_totalprice, 'delete' AS _change FROM j WHERE in_t AND NOT in_s
UNION ALL SELECT o_orderkey, ss, sp, 'insert' FROM j WHERE in_s AND NOT in_t
UNION ALL SELECT o_orderkey, ts, tp, 'update_before' FROM j WHERE in_t AND in_s AND differs
UNION ALL SELECT o_orderkey, ss, sp, 'update_after' FROM j WHERE in_t AND in_s AND differs""")
def snapshot_diff(spark, sf):
    before, after = [d.select("o_orderkey", "o_orderstatus", "o_totalprice") for d in _sides(spark, sf)]
    return plain(merge.diff(before, after, ["o_orderkey"]))


# ---- stored tables -----------------------------------------------------------------------

_ORDERS = describe("""
    o_orderkey bigint !
    o_orderstatus string
    o_totalprice double
    o_orderpriority string
    batch string
""")


@query("table_upsert", _final("CASE WHEN in_t AND in_s AND differs THEN 'update' WHEN in_t THEN 'keep' ELSE 'insert' END").replace(
    "SELECT o_orderkey, CASE", "SELECT o_orderkey, CAST(3 AS BIGINT) AS commits, CASE").replace(", _action\nFROM a", "\nFROM a"))
def table_upsert(spark, sf):
    """Load, upsert, upsert again: the second run of the same batch changes nothing."""
    store = Lake(spark, new_folder(spark, "upsert"), {"orders": _ORDERS})
    target, source = _sides(spark, sf)
    store.append("orders", target)
    first = store.upsert("orders", source, ["o_orderkey"], **_OPTIONS)
    again = store.upsert("orders", source, ["o_orderkey"], **_OPTIONS)
    commits = 1 + sum(bool(any(c)) for c in (first, again)) + (not any(again))
    return plain(store.read("orders").withColumn("commits", F.lit(commits)))


_DAILY = describe("""
    date_key int !
    event_type string
    n bigint
""")


@query("table_replace_window", """
SELECT CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_key, event_type, count(*) AS n FROM events
WHERE NOT (ts >= TIMESTAMP '2024-01-20' AND (event_type = 'click' OR ts >= TIMESTAMP '2024-01-28')) GROUP BY ALL""")
def table_replace_window(spark, sf):
    """Reload from 20 January with fewer rows; days left without rows are emptied."""


    store = Lake(spark, new_folder(spark, "window"), {"daily": _DAILY}, {"daily": Day()})
    daily = table(spark, sf, "events").groupBy(date_key("ts").alias("date_key"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    store.append("daily", daily)
    store.replace_window("daily", daily.where("event_type <> 'click' AND date_key < 20240128"), 20240120)
    return plain(store.read("daily"))


@query("table_compact", """
SELECT event_type, count(*) AS n, CAST(max(event_id) AS BIGINT) AS last_id, true AS only_crowded, true AS settled FROM events GROUP BY 1""")
def table_compact(spark, sf):
    """One day written in four rounds is packed, the other days keep their files; a second call has nothing to do."""
    store = Lake(spark, new_folder(spark, "compact"), {"events": describe("event_id bigint\nevent_type string\nts timestamp")}, {"events": Day(ts="ts")})
    rows = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    crowded = date_key("ts") == 20240110
    store.append("events", rows.where(~crowded | (F.col("event_id") % 4 == 0)))
    for i in (1, 2, 3):
        store.append("events", rows.where(crowded & (F.col("event_id") % 4 == i)))
    before = store.file_counts("events")
    store.compact("events", above=2)
    after = store.file_counts("events")
    only = all(after[d] == n for d, n in before.items() if n <= 2) and all(after[d] < n for d, n in before.items() if n > 2)
    settled = store.compact("events", above=2) == (sum(after.values()),) * 2
    return plain(store.read("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id"),
                                                                F.lit(only).alias("only_crowded"), F.lit(settled).alias("settled")))


@query("dims_refresh", """
SELECT 'C' || r_regionkey AS country_code, r_name AS country_name, r_name <> 'ASIA' AS is_active, count(*) AS areas
FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL""")
def dims_refresh(spark, sf):
    """Truncate-and-reload twice; the second load leaves one copy."""
    store = Lake(spark, new_folder(spark, "dims"))
    for _ in range(2):
        store.overwrite("dim_country", gold.dim_country(views.countries(spark, sf)))
        store.overwrite("dim_area", gold.dim_area(views.areas(spark, sf), views.countries(spark, sf)))
    country = store.read("dim_country").select("country_code", "country_name", "is_active")
    return plain(country.join(store.read("dim_area").groupBy("country_code").agg(F.count(F.lit(1)).alias("areas")), "country_code"))


