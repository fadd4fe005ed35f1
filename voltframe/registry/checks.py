"""Data-quality checks, quarantine, profiles and access rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltframe.operators import check_state, profile, quality, security
from voltframe.operators.tables import Day, Lake
from voltframe.registry import views
from voltframe.registry.base import plain, query, table
from voltframe.schemas import describe
from voltframe.session import new_folder
from voltframe.sources.inline import rows

AS_OF = "2024-01-31 12:00:00"


def _row(check: str, tbl: str, scope: str, metric: str, threshold: str, failed: str, ok: str, details: str = "''") -> str:
    return (f"SELECT '{check}' AS check_name, '{tbl}' AS table_name, '{scope}' AS scope, CAST({metric} AS DOUBLE) AS metric, "
            f"'{threshold}' AS threshold, CASE WHEN {ok} THEN 'PASS' ELSE '{failed}' END AS status, {details} AS details")


UNIQUE_SQL = _row("unique_key", "lineitem", "l_orderkey,l_linenumber", "n", "= 0", "FAIL", "n = 0") + """
FROM (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))"""


@query("dq_unique", UNIQUE_SQL)
def dq_unique(spark, sf):
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return quality.unique_key(items, "lineitem", ["l_orderkey", "l_linenumber"])


@query("dq_duplicate_keys", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def dq_duplicate_keys(spark, sf):
    return plain(quality.duplicate_keys(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"]))


REFERENCE_SQL = _row("area_in_reference", "lineitem", "l_suppkey", "n", "= 0", "FAIL", "n = 0") + """
FROM (SELECT count(DISTINCT l_suppkey) AS n FROM lineitem
        WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0))"""


@query("dq_reference", REFERENCE_SQL)
def dq_reference(spark, sf):
    known = table(spark, sf, "supplier").where("s_acctbal >= 0")
    return quality.in_reference(table(spark, sf, "lineitem"), "lineitem", "l_suppkey", known, "s_suppkey")


@query("dq_unknown_codes", """
SELECT DISTINCT 'lineitem' AS table_name, 'l_suppkey' AS column_name, CAST(l_suppkey AS VARCHAR) AS code
FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""")
def dq_unknown_codes(spark, sf):
    known = table(spark, sf, "supplier").where("s_acctbal >= 0")
    return quality.unknown_codes(table(spark, sf, "lineitem"), "lineitem", "l_suppkey", known, "s_suppkey")


@query("dq_unknown_values", """
SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 5000)""")
def dq_unknown_values(spark, sf):
    known = table(spark, sf, "supplier").where("s_acctbal >= 5000")
    return plain(quality.unknown_values(table(spark, sf, "lineitem"), "l_suppkey", known, "s_suppkey"))


_RULES = [("l_quantity", 1, 40), ("l_discount", 0, 0.05), ("l_extendedprice", 0, 1000000), ("l_tax", 0, 0)]
RANGE_SQL = "\nUNION ALL ".join(
    _row("value_range", "lineitem", c, f"count(*) FILTER ({c} < {lo} OR {c} > {hi})", f"[{lo}, {hi}]", "WARN",
         f"count(*) FILTER ({c} < {lo} OR {c} > {hi}) = 0") + " FROM lineitem" for c, lo, hi in _RULES)


@query("dq_range", RANGE_SQL)
def dq_range(spark, sf):
    return quality.value_ranges(table(spark, sf, "lineitem"), "lineitem", _RULES)


_PER_DAY = """
WITH per_day AS (SELECT area_code, day, sum(res) AS minutes, count(DISTINCT res) AS resolutions FROM (
  SELECT DISTINCT 'A' || (user_id % 25) AS area_code, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_id % 3 = 0 THEN 60 ELSE 15 END AS res, ts
  FROM events WHERE ts < TIMESTAMP '2024-01-30') GROUP BY area_code, day)
"""
_EXPECTED = 450


@query("dq_minutes_per_day", _PER_DAY + "SELECT area_code, day, CAST(minutes AS BIGINT) AS minutes, resolutions FROM per_day")
def dq_minutes_per_day(spark, sf):
    return plain(quality.minutes_per_day(views.intervals(spark, sf), ["area_code"], AS_OF))


@query("dq_worst_days", _PER_DAY + """
SELECT area_code, day, CAST(minutes AS BIGINT) AS minutes FROM per_day WHERE minutes < 450 ORDER BY minutes, area_code, day LIMIT 5""")
def dq_worst_days(spark, sf):
    per_day = quality.minutes_per_day(views.intervals(spark, sf), ["area_code"], AS_OF)
    return plain(quality.worst_days(per_day, ["area_code"], _EXPECTED).drop("resolutions"))


COMPLETENESS_SQL = _PER_DAY + f""", c AS (SELECT count(*) AS days, count(*) FILTER (minutes < {_EXPECTED}) AS gaps,
  count(*) FILTER (minutes > {_EXPECTED}) AS over_days FROM per_day),
w AS (SELECT string_agg(area_code || ' ' || day || ' ' || minutes || 'min', '; ' ORDER BY minutes, area_code, day) AS worst
  FROM (SELECT * FROM per_day WHERE minutes < {_EXPECTED} ORDER BY minutes, area_code, day LIMIT 5))
""" + _row("completeness_gap_days", "events", "area_code", "gaps", f"minutes < {_EXPECTED}", "WARN", "gaps = 0",
           "gaps || ' of ' || days || ' scope-days incomplete; worst: ' || worst") + " FROM c, w\nUNION ALL " + _row(
    "completeness_overlap_days", "events", "area_code", "over_days", f"minutes > {_EXPECTED}", "INFO", "over_days = 0",
    "over_days || ' scope-days published at more than one resolution'") + " FROM c"


@query("dq_completeness", COMPLETENESS_SQL)
def dq_completeness(spark, sf):
    return quality.completeness(views.intervals(spark, sf), "events", ["area_code"], AS_OF, expected=_EXPECTED)


@query("dq_completeness_recent", _PER_DAY.replace("WHERE ts <", "WHERE ts >= TIMESTAMP '2024-01-24' AND ts <") + """
SELECT area_code, day, CAST(minutes AS BIGINT) AS minutes, resolutions FROM per_day""")
def dq_completeness_recent(spark, sf):
    scoped = quality.recent(views.intervals(spark, sf), "ts_utc", AS_OF, 7)
    return plain(quality.minutes_per_day(scoped, ["area_code"], AS_OF))


def _freshness(limit: int) -> str:
    age = "CAST(date_diff('second', date_trunc('second', last), TIMESTAMP '2024-01-31 12:00:00') AS DOUBLE) / 3600"
    return _row("freshness_hours", "events", "max(ts_utc)", f"round({age}, 1)", f"<= {limit} h", "WARN", f"{age} <= {limit}",
                "'latest ts_utc ' || strftime(last, '%Y-%m-%d %H:%M:%S')") + " FROM (SELECT max(ts) AS last FROM events)"


@query("dq_freshness", _freshness(24) + "\nUNION ALL " + _freshness(72))
def dq_freshness(spark, sf):
    e = views.intervals(spark, sf)
    return quality.report(quality.freshness(e, "events", AS_OF, 24), quality.freshness(e, "events", AS_OF, 72))


@query("dq_report", f"""
SELECT 'run-1' AS run_id, TIMESTAMP '2024-01-31 12:00:00' AS checked_at, * FROM (
({UNIQUE_SQL}) UNION ALL ({REFERENCE_SQL}) UNION ALL ({RANGE_SQL}) UNION ALL ({_freshness(24)}))""")
def dq_report(spark, sf):
    report = quality.report(dq_unique(spark, sf), dq_reference(spark, sf), dq_range(spark, sf),
                            quality.freshness(views.intervals(spark, sf), "events", AS_OF, 24))
    return plain(quality.stamp(report, "run-1", AS_OF))


def _labelled(spark, sf):
    return (table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
            .join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left"))


@query("quarantine_split", """
SELECT 'documents' AS table_name, concat_ws('|', d.doc_id, lang, quality) AS record_key, 'missing_required_field' AS rule_name,
  'quality is null' AS details, source AS source_file, TIMESTAMP '2024-01-31 12:00:00' AS detected_at
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE quality IS NULL""")
def quarantine_split(spark, sf):
    _, bad = quality.split_required(_labelled(spark, sf), ["doc_id", "quality"])
    return plain(quality.quarantine(bad, "documents", ["doc_id", "lang", "quality"], "missing_required_field", "quality is null",
                                    "source", AS_OF))


@query("required_rows", "SELECT d.doc_id, lang, CAST(quality AS BIGINT) AS quality FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE quality IS NOT NULL")
def required_rows(spark, sf):
    good, _ = quality.split_required(_labelled(spark, sf), ["doc_id", "quality"])
    return plain(good.select("doc_id", "lang", "quality"))


# ---- profiles --------------------------------------------------------------------------


@query("status_pivot", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'F') AS F,
  count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def status_pivot(spark, sf):
    return plain(profile.count_matrix(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["O", "F", "P"]))


@query("profile", """
SELECT 'A' || (user_id % 25) AS area_code, CAST(CASE WHEN event_id % 3 = 0 THEN 60 ELSE 15 END AS BIGINT) AS resolution_minutes,
  min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS rows FROM events GROUP BY ALL""")
def profile_by_resolution(spark, sf):
    return plain(profile.profile(views.intervals(spark, sf), ["area_code", "resolution_minutes"], "ts_utc"))


@query("first_loaded", """
SELECT o_orderstatus AS dataset, count(*) AS keys, min(o_orderdate) AS min_loaded_until, max(o_orderdate) AS max_loaded_until FROM orders GROUP BY 1""")
def first_loaded(spark, sf):
    marks = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("dataset"), "o_orderdate")
    return plain(profile.loaded_range(marks, "dataset", "o_orderdate"))


@query("row_counts", """
SELECT 'region' AS table_name, count(*) AS row_count, CAST(count(*) FILTER (r_name <> 'ASIA') AS DOUBLE) AS flagged_rows FROM region
UNION ALL SELECT 'nation', count(*), NULL FROM nation UNION ALL SELECT 'orders', count(*), count(*) FILTER (o_orderstatus = 'O') FROM orders
UNION ALL SELECT 'lineitem', count(*), NULL FROM lineitem UNION ALL SELECT 'events', count(*), NULL FROM events""")
def row_counts(spark, sf):
    counts = profile.row_counts({
        "region": (table(spark, sf, "region"), F.col("r_name") != "ASIA"), "nation": (table(spark, sf, "nation"), None),
        "orders": (table(spark, sf, "orders"), F.col("o_orderstatus") == "O"), "lineitem": (table(spark, sf, "lineitem"), None),
        "events": (table(spark, sf, "events"), None)})
    return plain(counts.withColumn("flagged_rows", F.col("flagged_rows").cast("double")))


@query("weight_sum_check", """
SELECT s_nationkey AS nation, CAST(sum(w) AS DOUBLE) AS total_weight FROM (
  SELECT s.s_nationkey, CAST(10000 // n AS DECIMAL(9, 0)) / 10000 AS w FROM supplier s
  JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) c ON c.s_nationkey = s.s_nationkey)
GROUP BY 1 HAVING round(sum(w), 4) <> 1""".replace("s_nationkey AS nation", "CAST(s_nationkey AS BIGINT) AS nation").replace(
    "CAST(sum(w) AS DOUBLE)", "round(CAST(sum(w) AS DOUBLE), 4)"))
def weight_sum_check(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"))
    counts = s.groupBy("nation").agg(F.count(F.lit(1)).alias("n"))
    weights = s.join(counts, "nation").select("nation", (F.floor(F.lit(10000) / F.col("n")) / 10000).cast("decimal(5,4)").alias("weight"))
    return plain(profile.uneven_weights(weights, "nation", "weight"))


@query("left_join_count", """
SELECT c_custkey, c_mktsegment, count(o_orderkey) AS matches FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2""")
def left_join_count(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return plain(profile.match_counts(customers, orders, "c_custkey", "o_orderkey"))


@query("eval_rollup", """
WITH runs AS (SELECT lang, source, sum(quality) AS correct, count(*) - sum(quality) AS wrong, 100.0 * sum(quality) / count(*) AS pct
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id GROUP BY ALL)
SELECT lang AS set, CAST(sum(correct) AS BIGINT) AS correct, CAST(sum(wrong) AS BIGINT) AS wrong, round(min(pct), 6) AS min_pct, round(max(pct), 6) AS max_pct,
  round(100.0 * sum(correct) / (sum(correct) + sum(wrong)), 1) AS accuracy_pct FROM runs GROUP BY lang""")
def eval_rollup(spark, sf):
    verdicts = _labelled(spark, sf).where("quality IS NOT NULL")
    right = F.sum("quality")
    runs = verdicts.groupBy(F.col("lang").alias("set"), "source").agg(
        right.alias("correct"), (F.count(F.lit(1)) - right).alias("wrong"), (F.lit(100.0) * right / F.count(F.lit(1))).alias("pct"))
    out = profile.evaluation(runs)
    return plain(out.withColumns({c: F.round(c, 6) for c in ("min_pct", "max_pct")}))


# ---- access ----------------------------------------------------------------------------

_POLICY = [("anna", "C1"), ("anna", "C3"), ("otto", "*")]


def _policy(spark):
    return rows(spark, "user_name string, country_code string", _POLICY)


def _customers(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                               F.concat(F.lit("C"), F.col("n_regionkey").cast("string")).alias("country_code"))
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal").join(nation, "c_nationkey")


_CUSTOMERS = "SELECT c_custkey, 'C' || n_regionkey AS country_code FROM customer JOIN nation ON n_nationkey = c_nationkey"


@query("rls_filter", f"SELECT * FROM ({_CUSTOMERS}) WHERE country_code IN ('C1', 'C3')")
def rls_filter(spark, sf):
    return security.restrict(_customers(spark, sf), _policy(spark), "anna", "country_code").select("c_custkey", "country_code")


@query("rls_everything", _CUSTOMERS)
def rls_everything(spark, sf):
    return security.restrict(_customers(spark, sf), _policy(spark), "otto", "country_code").select("c_custkey", "country_code")


@query("rls_counts", f"""
SELECT u AS user_name, count(*) FILTER (country_code IN ('C1', 'C3') AND u = 'anna' OR u = 'otto') AS visible
FROM ({_CUSTOMERS}), (VALUES ('anna'), ('otto'), ('nobody')) v(u) GROUP BY u""")
def rls_counts(spark, sf):
    seen = [security.restrict(_customers(spark, sf), _policy(spark), u, "country_code").agg(F.count(F.lit(1)).alias("visible"))
            .select(F.lit(u).alias("user_name"), "visible") for u in ("anna", "otto", "nobody")]
    return quality.report(*seen)


@query("rls_fixed_role", f"SELECT * FROM ({_CUSTOMERS}) WHERE country_code = 'C2'")
def rls_fixed_role(spark, sf):
    return security.fixed_role(_customers(spark, sf), "country_code", "C2").select("c_custkey", "country_code")


@query("masked_rows", """
SELECT o_orderkey, 'xxxx' AS o_orderpriority, CAST(0 AS DOUBLE) AS o_totalprice, TIMESTAMP '1900-01-01' AS o_orderdate, o_orderstatus FROM orders""")
def masked_rows(spark, sf):
    seen = security.mask(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice", "o_orderdate")
    return plain(security.deny(seen, ["o_custkey"]))


# ---- maintained counts -----------------------------------------------------------------

_STORED = "(SELECT event_id, ts, user_id, value FROM events UNION ALL SELECT event_id, ts, user_id, value FROM events WHERE event_id % 50 = 0)"
_VALUE = [("value", 10, 900), ("user_id", 0, 1000000000)]


@query("dq_incremental", "\nUNION ALL ".join([
    _row("unique_key", "stored", "event_id,ts_utc", "n", "= 0", "FAIL", "n = 0") + f" FROM (SELECT count(*) AS n FROM (SELECT 1 FROM {_STORED} GROUP BY event_id, ts HAVING count(*) > 1))",
    *[_row("value_range", "stored", c, f"count(*) FILTER ({c} < {lo} OR {c} > {hi})", f"[{lo}, {hi}]", "WARN", f"count(*) FILTER ({c} < {lo} OR {c} > {hi}) = 0")
      + f" FROM {_STORED}" for c, lo, hi in _VALUE],
    _freshness(24).replace("'events' AS table_name", "'stored' AS table_name"),
    _row("user_in_reference", "stored", "user_id", "n", "= 0", "FAIL", "n = 0")
    + f" FROM (SELECT count(DISTINCT user_id) AS n FROM {_STORED} WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0))"]))
def dq_incremental(spark, sf):
    """Four rounds of changes: a load, a merge that changes values and one that changes them back, and appended copies. Each
    round counts only the days that it touched; the report is that of the whole table."""
    schemas, days = check_state.state_tables(["stored"])
    schema = describe("event_id bigint\nts_utc timestamp\nuser_id bigint\nvalue double")
    store = Lake(spark, new_folder(spark, "checks"), {**schemas, "stored": schema}, {**days, "stored": Day("day_key", "ts_utc")})
    rows = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts_utc"), "user_id", "value")
    known = table(spark, sf, "customer").where("c_acctbal >= 0").select("c_custkey")
    rules = check_state.Rules(["event_id", "ts_utc"], [check_state.Reference("user_id", known, "c_custkey", "user_in_reference")], _VALUE, 24)
    early = rows.where("ts_utc < TIMESTAMP '2024-01-08'")
    for change in (lambda: store.append("stored", rows.where("event_id % 3 > 0 OR ts_utc < TIMESTAMP '2024-01-08'")),
                   lambda: store.upsert("stored", early.withColumn("value", F.lit(-1.0)), ["event_id", "ts_utc"]),
                   lambda: store.upsert("stored", rows.where("event_id % 3 = 0 OR ts_utc < TIMESTAMP '2024-01-08'"), ["event_id", "ts_utc"]),
                   lambda: store.append("stored", rows.where("event_id % 50 = 0"))):
        change()
        check_state.refresh(store, "stored", rules)
    return check_state.checked(store, "stored", rules, AS_OF)
