"""The measures, the analytical questions and the report visuals."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltframe.plans import questions
from voltframe.plans.measures import MEASURES, evaluate
from voltframe.registry import views
from voltframe.registry.base import plain, query, rounded


def _d(expression: str, unit: int = 1) -> str:
    return f"CAST({expression} AS DOUBLE)" + (f" / {unit}" if unit != 1 else "")


def _div(a: str, b: str) -> str:
    return f"{_d(a)} / nullif({_d(b)}, 0)"


# measure -> (SQL view, expression over it); thousandths and hundredths are undone here
_SQL = {
    "total_generation_mwh": ("carbon", _d("sum(t)", 1000)),
    "renewable_share": ("carbon", _div("sum(r)", "sum(t)")),
    "low_carbon_share": ("carbon", _div("sum(l)", "sum(t)")),
    "carbon_intensity": ("carbon", _div("sum(c)", "sum(v)")),
    "factor_coverage": ("carbon", _div("sum(v)", "sum(t)")),
    "total_co2e_tonnes": ("carbon", _d("sum(c)", 1000000)),
    "data_through": ("carbon", "max(h)"),
    "exports_mwh": ("border", _d("sum(ex)", 1000)),
    "imports_mwh": ("border", _d("sum(im)", 1000)),
    "net_imports_mwh": ("border", _d("coalesce(sum(im), 0) - coalesce(sum(ex), 0)", 1000)),
    "generation_mwh": ("gen", _d("sum(g3)", 1000)),
    "load_mwh": ("loadf", _d("sum(load3)", 1000)),
    "avg_load_mw": ("loadf", _div("sum(avg3)", "count(*)") + " / 1000"),
    "avg_price": ("pricef", _div("sum(p2)", "count(*)") + " / 100"),
    "negative_price_hours": ("pricef", _d("nullif(count(*) FILTER (p2 < 0), 0)")),
    "avg_wind_100m": ("weatherf", _div("sum(wind2)", "count(wind2)") + " / 100"),
    "avg_solar": ("weatherf", _div("sum(solar2)", "count(*)") + " / 100"),
    "renewable_target": ("threshold", _d("max(target)", 100)),
    "carbon_alert_level": ("threshold", _d("max(alert)")),
    "carbon_intensity_floor": ("carbon", f"({_div('sum(c)', 'sum(v)')}) * ({_div('sum(v)', 'sum(t)')})"),
    "intensity_is_reliable": ("carbon", f"({_div('sum(v)', 'sum(t)')}) >= 0.9"),
}
_BORDER = """border AS (SELECT country_name, ex, im FROM (SELECT fc AS country_code, f3 AS ex, NULL AS im FROM flowf
  UNION ALL SELECT tc, NULL, f3 FROM flowf) JOIN (SELECT DISTINCT country_code, country_name FROM area) USING (country_code))"""
_THRESHOLD = """threshold AS (SELECT r_name AS country_name, r_regionkey * 10 + 20 AS target, r_regionkey * 10 + 300 AS alert FROM region)"""


def _with(view: str, *more: str) -> str:
    if view == "threshold":
        return f"WITH {_THRESHOLD}\n"
    if view == "border":
        return views.ctes("flowf").rstrip() + f",\n{_BORDER}\n"
    return views.ctes(view).rstrip() + "".join(f",\n{m}" for m in more) + "\n"


def _value(name: str, expression: str) -> str:
    return f"{expression} AS {name}" if name in ("data_through", "intensity_is_reliable") else f"round({expression}, 6) AS {name}"


def _clean(df, *names):
    numbers = [n for n in names if n not in ("data_through", "intensity_is_reliable")]
    return plain(rounded(df, *numbers))


def _register(name: str, sql: str) -> None:
    @query(f"measure_{name}", sql)
    def by_country(spark, sf):
        return _clean(evaluate(views.star(spark, sf), [name], ["country_name"]), name)


for _name, (_view, _expression) in _SQL.items():
    _register(_name, _with(_view) + f"SELECT country_name, {_value(_name, _expression)} FROM {_view} GROUP BY country_name")

_GAP = _with("carbon", _THRESHOLD) + f"""
SELECT country_name, round((share - target) * {{scale}}, 6) AS {{name}} FROM (
  SELECT country_name, {_div('sum(r)', 'sum(t)')} AS share FROM carbon GROUP BY 1)
JOIN (SELECT country_name, CAST(target AS DOUBLE) / 100 AS target FROM threshold) USING (country_name)"""
_register("renewable_gap", _GAP.format(scale=1, name="renewable_gap"))
_register("renewable_gap_pp", _GAP.format(scale=100, name="renewable_gap_pp"))
assert {f"measure_{m}" for m in MEASURES} <= {f"measure_{m}" for m in [*_SQL, "renewable_gap", "renewable_gap_pp"]}

_CI = _div("sum(c)", "sum(v)")
_HOURS = f"(SELECT country_code, country_name, hour(h) AS k, {_CI} AS ci FROM carbon GROUP BY ALL HAVING sum(v) > 0)"


@query("measure_greenest_hour", _with("carbon") + f"""
SELECT country_name, CAST(k AS BIGINT) AS greenest_hour FROM (
  SELECT *, row_number() OVER (PARTITION BY country_name ORDER BY ci, k) AS o FROM {_HOURS}) WHERE o = 1""")
def measure_greenest_hour(spark, sf):
    return plain(evaluate(views.star(spark, sf), ["greenest_hour"], ["country_name"]))


@query("measures_overall", _with("carbon") + f"""
SELECT round({_d('sum(t)', 1000)}, 6) AS total_generation_mwh, round({_CI}, 6) AS carbon_intensity, max(h) AS data_through FROM carbon""")
def measures_overall(spark, sf):
    names = ["total_generation_mwh", "carbon_intensity", "data_through"]
    return _clean(evaluate(views.star(spark, sf), names), *names)


@query("measures_two_facts", views.ctes("carbon", "pricef") + f"""
SELECT country_name, hour_key, round(carbon_intensity, 6) AS carbon_intensity, round(avg_price, 6) AS avg_price FROM
  (SELECT country_name, CAST(hour(h) AS BIGINT) AS hour_key, {_CI} AS carbon_intensity FROM carbon GROUP BY ALL)
  FULL JOIN (SELECT country_name, CAST(hour(h) AS BIGINT) AS hour_key, {_div('sum(p2)', 'count(*)')} / 100 AS avg_price FROM pricef GROUP BY ALL)
  USING (country_name, hour_key)""")
def measures_two_facts(spark, sf):
    names = ["carbon_intensity", "avg_price"]
    return _clean(evaluate(views.star(spark, sf), names, ["country_name", "hour_key"]), *names)


@query("net_imports", _with("border") + f"""
SELECT country_name, round({_d('sum(ex)', 1000)}, 6) AS exports_mwh, round({_d('sum(im)', 1000)}, 6) AS imports_mwh,
  round({_d('coalesce(sum(im), 0) - coalesce(sum(ex), 0)', 1000)}, 6) AS net_imports_mwh FROM border GROUP BY 1""")
def net_imports(spark, sf):
    names = ["exports_mwh", "imports_mwh", "net_imports_mwh"]
    return _clean(evaluate(views.star(spark, sf), names, ["country_name"]), *names)


@query("net_imports_overall", _with("border") + f"""
SELECT round({_d('sum(ex)', 1000)}, 6) AS exports_mwh, round({_d('sum(im)', 1000)}, 6) AS imports_mwh, CAST(0 AS DOUBLE) AS net_imports_mwh FROM border""")
def net_imports_overall(spark, sf):
    names = ["exports_mwh", "imports_mwh", "net_imports_mwh"]
    return _clean(evaluate(views.star(spark, sf), names), *names)


# ---- questions -------------------------------------------------------------------------


@query("q_greenest_hour", _with("carbon") + f"""
SELECT CAST(k AS BIGINT) AS hour_key, round(ci, 6) AS carbon_intensity FROM (
  SELECT *, rank() OVER (ORDER BY ci) AS o FROM {_HOURS} WHERE country_code = 'C3') WHERE o = 1""")
def q_greenest_hour(spark, sf):
    return _clean(questions.greenest_hours(views.star(spark, sf), "C3"), "carbon_intensity")


@query("q_greenest_hour_text", _with("carbon") + f"""
SELECT 'Typically ' || lpad(CAST(k AS VARCHAR), 2, '0') || ':00 UTC, about ' || printf('%.0f', ci) || ' gCO2e/kWh' AS answer FROM (
  SELECT *, rank() OVER (ORDER BY ci) AS o FROM {_HOURS} WHERE country_code = 'C3') WHERE o = 1""")
def q_greenest_hour_text(spark, sf):
    return questions.answer(questions.greenest_hours(views.star(spark, sf), "C3"), "greenest_hour")


@query("q_intensity_on_date", _with("carbon") + f"""
SELECT round({_CI}, 6) AS carbon_intensity FROM carbon WHERE country_code = 'C1' AND CAST(h AS DATE) = DATE '2024-01-15'""")
def q_intensity_on_date(spark, sf):
    return _clean(questions.intensity_on(views.star(spark, sf), "C1", "2024-01-15"), "carbon_intensity")


@query("q_overall", _with("carbon") + f"SELECT round({_CI}, 6) AS carbon_intensity, round({_div('sum(v)', 'sum(t)')}, 6) AS factor_coverage FROM carbon")
def q_overall(spark, sf):
    return _clean(questions.overall(views.star(spark, sf)), "carbon_intensity", "factor_coverage")


def _extreme(view: str, keys: str, expression: str, name: str, direction: str, where: str = "true") -> str:
    return _with(view) + f"""
SELECT {keys}, round(x, 6) AS {name} FROM (SELECT *, rank() OVER (ORDER BY x {direction}) AS o FROM (
  SELECT {keys}, {expression} AS x FROM (SELECT *, CAST(hour(h) AS BIGINT) AS hour_key, month(h) AS month, monthname(h) AS month_name, year(h) AS year FROM {view})
  WHERE {where} GROUP BY ALL) WHERE x IS NOT NULL) WHERE o = 1"""


@query("q_cleanest_country", _extreme("carbon", "country_name", _CI, "carbon_intensity", "ASC"))
def q_cleanest_country(spark, sf):
    return _clean(questions.cleanest_country(views.star(spark, sf)), "carbon_intensity")


@query("q_most_renewable_country", _extreme("carbon", "country_name", _div("sum(r)", "sum(t)"), "renewable_share", "DESC"))
def q_most_renewable_country(spark, sf):
    return _clean(questions.most_renewable_country(views.star(spark, sf)), "renewable_share")


@query("q_target_gap", _with("carbon", _THRESHOLD) + f"""
SELECT round(share, 6) AS renewable_share, round((share - target) * 100, 6) AS renewable_gap_pp FROM (
  SELECT {_div('sum(r)', 'sum(t)')} AS share FROM carbon WHERE country_code = 'C2'),
  (SELECT CAST(r_regionkey * 10 + 20 AS DOUBLE) / 100 AS target FROM region WHERE r_regionkey = 2)""")
def q_target_gap(spark, sf):
    return _clean(questions.target_gap(views.star(spark, sf), "C2"), "renewable_share", "renewable_gap_pp")


@query("q_target_gap_text", _with("carbon", _THRESHOLD) + f"""
SELECT 'Renewable share ' || printf('%.1f', 100 * share) || '% vs ' || printf('%.0f', 100 * target) || '% 2030 target, about '
  || printf('%.0f', (target - share) * 100) || ' percentage points below' AS answer FROM (
  SELECT {_div('sum(r)', 'sum(t)')} AS share FROM carbon WHERE country_code = 'C2'),
  (SELECT CAST(r_regionkey * 10 + 20 AS DOUBLE) / 100 AS target FROM region WHERE r_regionkey = 2)""")
def q_target_gap_text(spark, sf):
    return questions.target_gap_text(views.star(spark, sf), "C2")


@query("q_best_hour", _with("carbon") + f"""
SELECT CAST(k AS BIGINT) AS greenest_hour FROM (SELECT *, row_number() OVER (ORDER BY ci, k) AS o FROM {_HOURS} WHERE country_code = 'C4') WHERE o = 1""")
def q_best_hour(spark, sf):
    return plain(questions.best_hour(views.star(spark, sf), "C4"))


@query("q_dirtiest_month", _extreme("carbon", "month, month_name", _CI, "carbon_intensity", "DESC", "country_code = 'C0' AND year = 2024"))
def q_dirtiest_month(spark, sf):
    return _clean(questions.dirtiest_month(views.star(spark, sf), "C0", 2024), "carbon_intensity")


@query("q_renewable_in_year", _with("carbon") + f"""
SELECT round({_div('sum(r)', 'sum(t)')}, 6) AS renewable_share FROM carbon WHERE country_code = 'C1' AND year(h) = 2024""")
def q_renewable_in_year(spark, sf):
    return _clean(questions.renewable_in(views.star(spark, sf), "C1", 2024), "renewable_share")


_CHANGE = _with("carbon") + f""", p AS (SELECT
  {_div("sum(c) FILTER (day(h) <= 15)", "sum(v) FILTER (day(h) <= 15)")} AS a, {_div("sum(c) FILTER (day(h) > 15)", "sum(v) FILTER (day(h) > 15)")} AS b
  FROM carbon WHERE country_code = 'C2')
"""


def _change(spark, sf):
    day = F.col("day_of_month")
    return questions.intensity_change(views.star(spark, sf), "C2", ("day_of_month", day <= 15), ("day_of_month", day > 15))


@query("q_intensity_change", _CHANGE + """
SELECT CASE WHEN b < a THEN 'Decreased' ELSE 'Increased' END AS direction, round(a, 6) AS before, round(b, 6) AS after, round((b - a) / a, 6) AS change FROM p""")
def q_intensity_change(spark, sf):
    return _clean(_change(spark, sf), "before", "after", "change")


@query("q_intensity_change_text", _CHANGE + """
SELECT CASE WHEN b < a THEN 'Decreased' ELSE 'Increased' END || ' from ' || printf('%.1f', a) || ' to ' || printf('%.1f', b) || ' gCO2e/kWh (' ||
  printf('%+.1f', 100 * (b - a) / a) || '%)' AS answer FROM p""")
def q_intensity_change_text(spark, sf):
    return questions.answer(_change(spark, sf), "intensity_change")


@query("q_average_price", _with("pricef") + f"SELECT round({_div('sum(p2)', 'count(*)')} / 100, 6) AS avg_price FROM pricef WHERE country_code = 'C3' AND year(h) = 2024")
def q_average_price(spark, sf):
    return _clean(questions.average_price(views.star(spark, sf), "C3", 2024), "avg_price")


@query("q_negative_hours", _with("pricef") + """
SELECT CAST(nullif(count(*) FILTER (p2 < 0), 0) AS DOUBLE) AS negative_price_hours FROM pricef WHERE country_code = 'C1' AND year(h) = 2024""")
def q_negative_hours(spark, sf):
    return _clean(questions.negative_hours(views.star(spark, sf), "C1", 2024), "negative_price_hours")


@query("q_trade_balance", _with("border") + f"""
SELECT CASE WHEN v > 0 THEN 'Net importer' ELSE 'Net exporter' END AS label, round(abs(v) / 1000000, 6) AS twh FROM (
  SELECT {_d('coalesce(sum(im), 0) - coalesce(sum(ex), 0)', 1000)} AS v FROM border WHERE country_name = (SELECT r_name FROM region WHERE r_regionkey = 2))""")
def q_trade_balance(spark, sf):
    return _clean(questions.trade_balance(views.star(spark, sf), "C2"), "twh")


@query("q_fossil_share", _with("gen") + f"""
SELECT round({_div("sum(g3) FILTER (psr = 'view')", "sum(g3)")}, 6) AS share FROM gen WHERE country_code = 'C1'""")
def q_fossil_share(spark, sf):
    return _clean(questions.category_share(views.star(spark, sf), "C1", "Fossil"), "share")


@query("q_renewable_share_text", _with("carbon") + f"""
SELECT printf('%.1f', 100 * {_div('sum(r)', 'sum(t)')}) || '%' AS answer FROM carbon GROUP BY country_name""")
def q_renewable_share_text(spark, sf):
    return questions.answer(evaluate(views.star(spark, sf), ["renewable_share"], ["country_name"]), "renewable_share")


@query("q_cheapest_hour", _extreme("pricef", "hour_key", _div("sum(p2)", "count(*)") + " / 100", "avg_price", "ASC", "country_code = 'C2'"))
def q_cheapest_hour(spark, sf):
    return _clean(questions.cheapest_hours(views.star(spark, sf), "C2"), "avg_price")


@query("q_winter_wind", _with("weatherf") + f"""
SELECT round({_div('sum(wind2)', 'count(wind2)')} / 100, 6) AS avg_wind_100m FROM weatherf WHERE country_code = 'C3' AND month(h) IN (12, 1, 2)""")
def q_winter_wind(spark, sf):
    return _clean(questions.seasonal_wind(views.star(spark, sf), "C3", "Winter"), "avg_wind_100m")


# ---- report visuals --------------------------------------------------------------------


@query("v_cards", views.ctes("carbon", "pricef") + f"""
SELECT round({_CI}, 6) AS carbon_intensity, round({_div('sum(r)', 'sum(t)')}, 6) AS renewable_share,
  round({_div('sum(l)', 'sum(t)')}, 6) AS low_carbon_share, round({_div('sum(v)', 'sum(t)')}, 6) AS factor_coverage,
  (SELECT round({_div('sum(p2)', 'count(*)')} / 100, 6) FROM pricef) AS avg_price, round({_d('sum(c)', 1000000)}, 6) AS total_co2e_tonnes,
  (SELECT CAST(k AS BIGINT) FROM (SELECT hour(h) AS k, {_CI} AS ci FROM carbon GROUP BY 1) ORDER BY ci, k LIMIT 1) AS greenest_hour FROM carbon""")
def v_cards(spark, sf):
    return _clean(questions.cards(views.star(spark, sf)), "carbon_intensity", "renewable_share", "low_carbon_share",
                  "factor_coverage", "avg_price", "total_co2e_tonnes")


@query("v_mix_share", views.ctes("gen", "kind") + f"""
SELECT country_name, fuel_category, round(m, 6) AS generation_mwh, round(m / sum(m) OVER (PARTITION BY country_name), 6) AS share FROM (
  SELECT country_name, fuel_category, {_d('sum(g3)', 1000)} AS m FROM gen JOIN kind USING (psr) GROUP BY ALL)""")
def v_mix_share(spark, sf):
    return _clean(questions.mix_share(views.star(spark, sf)), "generation_mwh", "share")


@query("v_against_target", _with("carbon", _THRESHOLD) + f"""
SELECT country_name, round(share, 6) AS renewable_share, round(target, 6) AS renewable_target, round(share - target, 6) AS renewable_gap FROM (
  SELECT country_name, {_div('sum(r)', 'sum(t)')} AS share FROM carbon GROUP BY 1)
JOIN (SELECT country_name, CAST(target AS DOUBLE) / 100 AS target FROM threshold) USING (country_name)""")
def v_against_target(spark, sf):
    return _clean(questions.against_target(views.star(spark, sf)), "renewable_share", "renewable_target", "renewable_gap")


@query("v_intensity_drill", _with("carbon") + f"""
SELECT 'year' AS level, country_name, year(h) AS year, CAST(NULL AS DOUBLE) AS month, CAST(NULL AS VARCHAR) AS date, round({_CI}, 6) AS carbon_intensity FROM carbon GROUP BY ALL
UNION ALL SELECT 'month', country_name, year(h), month(h), NULL, round({_CI}, 6) FROM carbon GROUP BY ALL
UNION ALL SELECT 'day', country_name, year(h), month(h), strftime(h, '%Y-%m-%d'), round({_CI}, 6) FROM carbon GROUP BY ALL""")
def v_intensity_drill(spark, sf):
    drill = questions.intensity_drill(views.star(spark, sf))
    return _clean(drill.withColumn("month", F.col("month").cast("double")), "carbon_intensity")


@query("v_intensity_by_hour", _with("carbon") + f"SELECT CAST(hour(h) AS BIGINT) AS hour_key, round({_CI}, 6) AS carbon_intensity FROM carbon GROUP BY 1")
def v_intensity_by_hour(spark, sf):
    return _clean(questions.intensity_by_hour(views.star(spark, sf)), "carbon_intensity")


@query("v_country_slicer", "SELECT DISTINCT r_name AS country_name FROM events JOIN nation ON n_nationkey = user_id % 25 JOIN region ON r_regionkey = n_regionkey")
def v_country_slicer(spark, sf):
    return questions.slicer(views.star(spark, sf), "country", "country_name", "load")


@query("v_date_slicer", "SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS date FROM events WHERE event_type <> 'error'")
def v_date_slicer(spark, sf):
    return plain(questions.slicer(views.star(spark, sf), "date", "date", "generation"))
