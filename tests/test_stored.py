"""Maintained checks, versions in force, gold from changes, clustering, measures over stored facts."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import at, clock, found
from voltframe.operators import check_state, quality, series
from voltframe.operators.tables import Day, Lake
from voltframe.plans import gold, pipeline, questions, silver
from voltframe.plans.measures import MEASURES, evaluate
from voltframe.registry import all_queries, stored, views
from voltframe.schemas import KEYS, TABLES, describe
from voltframe.sources import reference
from voltframe.sources.inline import rows

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- maintained checks -----------------------------------------------------------------


@pytest.fixture
def checked(spark, tmp_path):
    schemas, days = check_state.state_tables(["t"])
    return Lake(spark, str(tmp_path / "lake"), {**schemas, "t": describe("k string\nts_utc timestamp\nv double")}, {**days, "t": Day("day_key", "ts_utc")})


def report_of(store, known, whole=False):
    rules = check_state.Rules(["k", "ts_utc"], [check_state.Reference("k", known, "code")], [("v", 0, 10)], 24)
    if not whole:
        return rules, lambda: found(check_state.checked(store, "t", rules, "2025-01-10"))
    t = store.read("t")
    return found(quality.report(quality.unique_key(t, "t", ["k", "ts_utc"]), quality.scan_checks(t, "t", [("v", 0, 10)], 24, "2025-01-10"),
                                quality.in_reference(t, "t", "k", known, "code")))


def test_counts_follow_every_change(spark, checked, frame):
    known = frame("code string", [("a",), ("b",)])
    rules, now = report_of(checked, known)
    schema = "k string, ts_utc timestamp, v double"
    put = lambda *r: checked.append("t", rows(spark, schema, [(k, at(f"2025-01-{d:02d} 0{h}:00"), v) for k, d, h, v in r]))
    assert check_state.refresh(checked, "t", rules) == [] and now() == report_of(checked, known, True)
    put(("a", 1, 1, 5.0), ("a", 1, 1, 6.0), ("x", 2, 1, 50.0), ("y", 3, 1, -1.0), ("b", 4, 1, None))
    assert check_state.refresh(checked, "t", rules) == [20250101, 20250102, 20250103, 20250104]
    assert now() == report_of(checked, known, True)
    put(("x", 2, 1, 1.0), ("z", 5, 2, 3.0))
    assert check_state.refresh(checked, "t", rules) == [20250102, 20250105] and now() == report_of(checked, known, True)
    checked.replace_parts("t", checked.read("t").limit(0), [20250102, 20250103])    # two days vanish
    assert check_state.refresh(checked, "t", rules) == [20250102, 20250103] and now() == report_of(checked, known, True)
    assert check_state.refresh(checked, "t", rules) == []


def test_only_changed_days_are_read(spark, checked, frame, monkeypatch):
    rules, _ = report_of(checked, frame("code string", [("a",)]))
    for d in (1, 2, 3):
        checked.append("t", rows(spark, "k string, ts_utc timestamp, v double", [("a", at(f"2025-01-0{d}"), 1.0)]))
    check_state.refresh(checked, "t", rules)
    checked.append("t", rows(spark, "k string, ts_utc timestamp, v double", [("b", at("2025-01-02"), 1.0)]))
    read, seen = Lake.read, []
    monkeypatch.setattr(Lake, "read", lambda self, table, *a, **k: seen.append((table, read(self, table, *a, **k))) or seen[-1][1])
    check_state.refresh(checked, "t", rules)
    plans = [df for table, df in seen if table == "t"]
    assert plans and all("day_key" in plan_of(df) and {r[0] for r in df.select(F.dayofmonth("ts_utc")).distinct().collect()} == {2} for df in plans)
    assert all("PartitionFilters: [(day_key" in plan_of(df) or "PartitionFilters: [isnotnull(day_key" in plan_of(df) for df in plans)


def test_a_key_that_spans_days_is_refused(checked):
    with pytest.raises(ValueError, match="several parts"):
        check_state.refresh(checked, "t", check_state.Rules(["k"]))


# ---- versions in force -----------------------------------------------------------------


def plain_versions(facts, versions):
    out = []
    for i, k, t in facts:
        started = [v for v in versions if k is not None and t is not None and v[0] == k and v[1] is not None and v[1] <= t]
        best = max(started, key=lambda v: (v[1], v[2] is None, v[2] or v[1]), default=None)
        out.append((i, best[3] if best and (best[2] is None or t < best[2]) else None))
    return sorted(out)


@pytest.mark.parametrize("span,shares", [(86400, 1), (1800, 3), (10**9, 2)])
def test_versions_against_plain_search(frame, span, shares):
    rng = random.Random(span)
    moment = lambda: at(f"2025-01-0{rng.randint(1, 3)} {rng.randint(0, 23):02d}:{rng.randint(0, 5)}0")
    versions = []
    for n in range(120):
        a = moment()
        b = moment()
        versions.append((rng.choice(["h", "h", "h", "c", None]), rng.choice([a, a, a, None]), b if rng.random() < 0.4 and b > a else None, n))
    seen = {}
    versions = [v for v in versions if seen.setdefault(v[:3], v) is v]
    facts = [(n, rng.choice(["h", "h", "c", "none", None]), rng.choice([moment(), moment(), None])) for n in range(300)]
    df = frame("id int, k string, ts timestamp", facts)
    vs = frame("k string, valid_from timestamp, valid_to timestamp, n int", versions)
    got = series.version_in_force(df, vs, "k", "ts", span_seconds=span, shares=shares)
    assert sorted((r["id"], r["n"]) for r in got.collect()) == plain_versions(facts, versions)
    assert got.columns == ["id", "k", "ts", "valid_from", "valid_to", "n"]


def test_versions_meet_no_join(spark):
    assert "Join" not in plan_of(all_queries()["validity_asof_many"](spark, SF))


def test_no_versions_at_all(frame):
    got = series.version_in_force(frame("id int, k string, ts timestamp", [(1, "a", at("2025-01-01"))]),
                                  frame("k string, valid_from timestamp, valid_to timestamp, n int", [("b", at("2025-01-01"), None, 1)]), "k", "ts")
    assert found(got, "id", "n") == [(1, None)]


# ---- gold from changes -----------------------------------------------------------------


def silver_rows(spark, store, table, *values):
    """Put rows into a silver table as a merge does, with its notes."""
    schema = TABLES[table]
    df = rows(spark, schema, [(*v, None, at("2025-01-01"), None) for v in values])
    scope = {"silver_flow": ("from_area_code", "to_area_code"), "silver_weather_country_hourly": ("country_code", None)}.get(table, ("area_code", None))
    store.upsert(table, df, KEYS[table], note=silver.touched(store, table, scope[0], "2025-02-01", scope[1]))


def facts_of(store):
    return {t: clock(store.read(t).drop("loaded_at_utc")) for t in pipeline.DAYS if t.startswith("fact_")}


def test_changed_hours_equal_a_full_reload(spark, tmp_path):
    given = (reference.country(spark), reference.area(spark), reference.production_type(spark))
    store = pipeline.lake(spark, str(tmp_path / "lake"))

    def put(day, x):
        t = at(f"2025-01-{day:02d} 03:00")
        half = at(f"2025-01-{day:02d} 03:30")
        silver_rows(spark, store, "silver_load", ("NL", t, 30, x, x / 2), ("NL", half, 30, x + 1, x / 2))
        silver_rows(spark, store, "silver_generation", ("NL", t, 60, "B16", "generation", x, x, 1.0), ("NL", t, 60, "B04", "generation", 2 * x, 2 * x, 1.0))
        silver_rows(spark, store, "silver_price", ("NL", t, 60, x))
        silver_rows(spark, store, "silver_flow", ("DE", "NL", t, 60, x, x))

    for day in (1, 2, 3):
        put(day, 10.0 * day)
    pipeline.load_gold(store, *given, "2025-02-01", from_date="2025-01-01")
    store.overwrite("ctl_touched_hours", store.read("ctl_touched_hours").limit(0))
    before, stamps = facts_of(store), {t: store.stamps(t) for t in pipeline.DAYS if t.startswith("fact_")}

    put(2, 99.0)        # late corrections, far older than any window
    assert pipeline.load_gold_changes(store, *given, "2025-02-02") == [20250102]
    changed = facts_of(store)
    assert changed != before and store.read("ctl_touched_hours").isEmpty()
    for t, old in stamps.items():
        assert {d for d, s in store.stamps(t).items() if old.get(d) != s} <= {20250102}
    assert pipeline.load_gold_changes(store, *given, "2025-02-03") == [] and facts_of(store) == changed
    pipeline.load_gold(store, *given, "2025-02-04", from_date="2025-01-01")
    assert facts_of(store) == changed


def test_hours_before_the_window_only(spark, tmp_path):
    given = (reference.country(spark), reference.area(spark), reference.production_type(spark))
    store = pipeline.lake(spark, str(tmp_path / "lake"))
    silver_rows(spark, store, "silver_load", ("NL", at("2025-01-01"), 60, 1.0, 1.0), ("NL", at("2025-01-09"), 60, 2.0, 2.0))
    assert pipeline.load_gold_changes(store, *given, "2025-01-10", before="2025-01-05") == [20250101]
    assert found(store.read("fact_load_hourly"), "date_key") == [(20250101,)]
    assert [r[0] for r in found(store.read("ctl_touched_hours").select(F.dayofmonth("ts_hour_utc")))] == [9]


# ---- measures over stored facts --------------------------------------------------------


@pytest.fixture(scope="module")
def star(spark):
    return pipeline.star(stored.stored_star(spark, SF))


def test_a_date_filter_prunes_stored_days(star):
    for measure in ("carbon_intensity", "avg_price", "load_mwh"):
        assert "dynamicpruning" in plan_of(evaluate(star, [measure], ["country_name"], [("day_of_week", F.col("day_of_week") >= 6)])).lower()


def test_cards_scan_each_fact_once(star):
    plan = plan_of(questions.cards(star))
    assert plan.count("total_generation_mwh") and sum("FileScan" in line and "fact_carbon_hourly" in line for line in plan.splitlines()) == 1


def test_rolled_up_measures_equal_direct_ones(spark):
    star = views.star(spark, SF)
    names = [m for m in MEASURES if m not in ("data_through", "intensity_is_reliable")]
    direct = {r["country_name"]: r for r in evaluate(star, names, ["country_name"]).collect()}
    for r in evaluate(star, [*names, "greenest_hour"], ["country_name"]).collect():
        assert all(r[n] == direct[r["country_name"]][n] or abs(r[n] - direct[r["country_name"]][n]) < 1e-9 for n in names)


# ---- clustering ------------------------------------------------------------------------


def test_clustered_files_hold_narrow_ranges(spark, tmp_path):
    store = Lake(spark, str(tmp_path / "lake"), {"t": describe("date_key int !\nk int\nv int"), "flat": describe("k int\nv int")}, {"t": Day()})
    for table in ("t", "flat"):
        for i in range(6):
            made = spark.range(2000).select(F.lit(1).alias("date_key"), (F.col("id") % 100).cast("int").alias("k"), F.lit(i).alias("v")).repartition(1)
            store.append(table, made if table == "t" else made.drop("date_key"))
        store.append("t", rows(spark, "date_key int, k int, v int", [(2, 1, 1)])) if table == "t" else None
        path = tmp_path / "lake" / table
        other = {p: p.stat().st_mtime_ns for p in (path / "date_key=2").glob("*.parquet")} if table == "t" else {}

        def holding(key):
            return spark.read.parquet(store.path(table)).where(F.col("k") == key).select(F.col("_metadata.file_path")).distinct().count()

        assert holding(17) >= 6
        store.compact(table, above=4, rows_per_file=1500, cluster_by=["k"])
        assert holding(17) <= 3 and store.read(table).count() == 12_000 + (table == "t")
        assert {p: p.stat().st_mtime_ns for p in (path / "date_key=2").glob("*.parquet")} == other if table == "t" else True
        spans = spark.read.parquet(store.path(table)).where("k IS NOT NULL").groupBy(F.col("_metadata.file_path")).agg((F.max("k") - F.min("k")).alias("w")).collect()
        assert max(r["w"] for r in spans) <= 30


def test_gold_dims_are_there():
    assert {"dim_date", "dim_hour"} <= set(TABLES) and gold.SEASONS
