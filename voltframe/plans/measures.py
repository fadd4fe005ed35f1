"""The named measures, as aggregates over the star.

A measure is built from base aggregates of one fact. Evaluating several measures, of whatever
grain, groups each fact once, joins only the dimensions that the grouping or the filter uses, and lines
the facts up by union and a final small aggregate, so no fact is ever joined to another.

Empty sums and counts are BLANK (NULL); BLANK minus x is -x; a division by zero or BLANK is
BLANK.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltframe.functions.scalars import ratio

DIMENSION_KEYS = {"date": "date_key", "hour": "hour_key", "country": "country_code",
                  "area": "area_code", "production_type": "psr_type_code"}


@dataclass(frozen=True)
class Star:
    """Facts and dimensions by name. Missing tables are fine as long as nothing asks for them."""

    facts: Mapping[str, DataFrame]
    dims: Mapping[str, DataFrame] = field(default_factory=dict)


Part = tuple[Callable[[], Column], Callable[[Column], Column]]


@dataclass(frozen=True)
class Base:
    """An aggregate over one fact: parts that are aggregated, each with the aggregate that adds up part results of finer
    groups, and the value made of them."""

    fact: str
    parts: tuple[Part, ...]
    value: Callable[..., Column]

    def aggregate(self) -> Column:
        return self.value(*[part() for part, _ in self.parts])

    def partial(self, name: str) -> list[Column]:
        """The parts as columns of a finer grouping."""
        return [part().alias(f"{name}_{i}") for i, (part, _) in enumerate(self.parts)]

    def of_group(self, name: str) -> Column:
        """The value within a finer group."""
        return self.value(*[F.col(f"{name}_{i}") for i in range(len(self.parts))])

    def rolled(self, name: str) -> Column:
        """The value over finer groups."""
        return self.value(*[merge(F.col(f"{name}_{i}")) for i, (_, merge) in enumerate(self.parts)])


@dataclass(frozen=True)
class Measure:
    needs: tuple[str, ...]
    value: Callable[[Mapping[str, Column]], Column]


def _sum(fact: str, column: str) -> Base:
    return Base(fact, ((lambda: F.sum(column), F.sum),), lambda total: total.cast("double"))


def _mean(fact: str, column: str) -> Base:
    return Base(fact, ((lambda: F.sum(column), F.sum), (lambda: F.count(column), F.sum)), lambda total, n: ratio(total.cast("double"), n))


def _greatest(fact: str, column: str, number: bool = True) -> Base:
    return Base(fact, ((lambda: F.max(column), F.max),), lambda most: most.cast("double") if number else most)


BASES: dict[str, Base] = {
    "generation_total": _sum("carbon", "total_generation_mwh"),
    "renewable": _sum("carbon", "renewable_mwh"),
    "low_carbon": _sum("carbon", "low_carbon_mwh"),
    "covered": _sum("carbon", "factor_covered_mwh"),
    "co2e": _sum("carbon", "co2e_kg"),
    "through": _greatest("carbon", "ts_hour_utc", number=False),
    "exports": _sum("border", "export_mwh"),
    "imports": _sum("border", "import_mwh"),
    "generation": _sum("generation", "generation_mwh"),
    "load": _sum("load", "load_mwh"),
    "load_mw": _mean("load", "avg_load_mw"),
    "price": _mean("price", "price_eur_mwh"),
    "negative": Base("price", ((lambda: F.count_if(F.col("price_eur_mwh") < 0), F.sum),), lambda n: F.nullif(n, F.lit(0))),
    "wind": _mean("weather", "wind_speed_100m_kmh"),
    "solar": _mean("weather", "solar_radiation_wm2"),
    "target": _greatest("threshold", "renewable_share_target_pct"),
    "alert": _greatest("threshold", "carbon_intensity_alert_gco2e_per_kwh"),
}


def _minus(a: Column, b: Column) -> Column:
    zero = F.lit(0.0)
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, zero) - F.coalesce(b, zero))


def _of(name: str) -> Measure:
    return Measure((name,), lambda b: b[name])


def _per(numerator: str, denominator: str) -> Measure:
    return Measure((numerator, denominator), lambda b: ratio(b[numerator], b[denominator]))


def _gap(b: Mapping[str, Column]) -> Column:
    return _minus(ratio(b["renewable"], b["generation_total"]), b["target"] / 100)


MEASURES: dict[str, Measure] = {
    "total_generation_mwh": _of("generation_total"),
    "renewable_share": _per("renewable", "generation_total"),
    "low_carbon_share": _per("low_carbon", "generation_total"),
    "carbon_intensity": _per("co2e", "covered"),
    "factor_coverage": _per("covered", "generation_total"),
    "total_co2e_tonnes": Measure(("co2e",), lambda b: b["co2e"] / 1000),
    "data_through": _of("through"),
    "exports_mwh": _of("exports"),
    "imports_mwh": _of("imports"),
    "net_imports_mwh": Measure(("imports", "exports"), lambda b: _minus(b["imports"], b["exports"])),
    "generation_mwh": _of("generation"),
    "load_mwh": _of("load"),
    "avg_load_mw": _of("load_mw"),
    "avg_price": _of("price"),
    "negative_price_hours": _of("negative"),
    "avg_wind_100m": _of("wind"),
    "avg_solar": _of("solar"),
    "renewable_target": Measure(("target",), lambda b: b["target"] / 100),
    "renewable_gap": Measure(("renewable", "generation_total", "target"), _gap),
    "carbon_alert_level": _of("alert"),
    "renewable_gap_pp": Measure(("renewable", "generation_total", "target"), lambda b: _gap(b) * 100),
    # documented companions of the carbon intensity
    "carbon_intensity_floor": Measure(("co2e", "covered", "generation_total"), lambda b: ratio(
        b["co2e"], b["covered"]) * ratio(b["covered"], b["generation_total"])),
    "intensity_is_reliable": Measure(("covered", "generation_total"), lambda b: ratio(
        b["covered"], b["generation_total"]) >= 0.90),
}
GREENEST_HOUR = "greenest_hour"


def border_sides(flow: DataFrame) -> DataFrame:
    """Each directed flow once as the sender's export and once as the receiver's import."""
    nothing = F.lit(None).cast(flow.schema["flow_mwh"].dataType)
    sides = F.array(
        F.struct(F.col("from_country_code").alias("country_code"), F.col("flow_mwh").alias("export_mwh"), nothing.alias("import_mwh")),
        F.struct(F.col("to_country_code").alias("country_code"), nothing.alias("export_mwh"), F.col("flow_mwh").alias("import_mwh")))
    return flow.select("date_key", "hour_key", F.inline(sides))


def _fact(star: Star, name: str) -> DataFrame:
    return border_sides(star.facts["flow"]) if name == "border" else star.facts[name]


def with_dimensions(star: Star, fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach the wanted columns the fact itself lacks. Rows unknown to a dimension stay, with
    NULL attributes, so totals are whole and a filter on an attribute leaves them out."""
    missing = [c for c in columns if c not in fact.columns]
    out = fact
    for name, key in DIMENSION_KEYS.items():
        dim = star.dims.get(name)
        taken = [c for c in missing if dim is not None and c in dim.columns and key in fact.columns]
        if taken:
            out = out.join(dim.select(key, *taken), key, "left")
            missing = [c for c in missing if c not in taken]
    if missing:
        raise ValueError(f"no dimension reachable from this fact has {missing}")
    return out


def _reduced(star: Star, fact_name: str, by: Sequence[str], where: Sequence[tuple[str, Column]]) -> tuple[list[str], DataFrame]:
    """The groupings that a fact can reach, and its rows after the filters that it can reach."""
    fact = _fact(star, fact_name)
    reachable = set(fact.columns)
    for dim_name, key in DIMENSION_KEYS.items():
        if key in fact.columns and dim_name in star.dims:
            reachable |= set(star.dims[dim_name].columns)
    tests = [(c, t) for c, t in where if c in reachable]
    groups = [c for c in by if c in reachable]
    joined = with_dimensions(star, fact, [*dict.fromkeys([*groups, *[c for c, _ in tests]])])
    return groups, reduce(lambda d, t: d.where(t[1]), tests, joined)


def _per_hour(star: Star, names: Sequence[str], by: Sequence[str], where: Sequence[tuple[str, Column]]) -> DataFrame:
    """Carbon bases and the greenest hour from one grouping of the fact by hour of day, which is then rolled up."""
    names = list(dict.fromkeys([*names, *MEASURES["carbon_intensity"].needs]))
    groups, kept = _reduced(star, "carbon", list(dict.fromkeys([*by, "hour_key"])), where)
    hours = kept.groupBy(*groups).agg(*[part for n in names for part in BASES[n].partial(n)])
    intensity = MEASURES["carbon_intensity"].value({n: BASES[n].of_group(n) for n in names})
    order = F.when(F.col("_intensity").isNotNull(), F.struct("_intensity", "hour_key"))
    return hours.withColumn("_intensity", intensity).groupBy(*by).agg(
        *[BASES[n].rolled(n).alias(n) for n in names], F.min_by("hour_key", order).cast("int").alias(GREENEST_HOUR))


def _bases(star: Star, names: Sequence[str], by: Sequence[str], where: Sequence[tuple[str, Column]], hourly: bool = False) -> DataFrame:
    """Base aggregates by group, each fact grouped once. A filter or grouping a fact cannot reach does not apply to it. With
    `hourly` the carbon fact also gives the greenest hour."""
    parts, wanted = [], list(names)
    for fact_name in dict.fromkeys([*["carbon"] * hourly, *[BASES[n].fact for n in names]]):
        mine = [n for n in names if BASES[n].fact == fact_name]
        if hourly and fact_name == "carbon":
            parts.append((list(by), _per_hour(star, mine, by, where).select(*by, *mine, GREENEST_HOUR)))
            wanted.append(GREENEST_HOUR)
            continue
        groups, kept = _reduced(star, fact_name, by, where)
        parts.append((groups, kept.groupBy(*groups).agg(*[BASES[n].aggregate().alias(n) for n in mine])))
    if len(parts) == 1 and parts[0][0] == list(by):
        return parts[0][1]
    if any(groups != list(by) for groups, _ in parts):
        raise ValueError("all requested measures must be groupable by the same columns")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p for _, p in parts])
    return stacked.groupBy(*by).agg(*[F.max(n).alias(n) for n in wanted])


def greenest_hour(star: Star, by: Sequence[str] = (), where: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """Hour of day with the lowest intensity; blanks are left out and ties give the earliest hour."""
    return evaluate(star, [GREENEST_HOUR], by, where)


def evaluate(star: Star, measures: Sequence[str], by: Sequence[str] = (),
             where: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """Measures per group. `where` lists (column, condition) pairs, the column telling which
    dimension the condition belongs to."""
    plain = [m for m in measures if m != GREENEST_HOUR]
    needed = list(dict.fromkeys(n for m in plain for n in MEASURES[m].needs))
    values = {n: F.col(n) for n in needed}
    made = {m: MEASURES[m].value(values).alias(m) for m in plain} | {GREENEST_HOUR: F.col(GREENEST_HOUR)}
    return _bases(star, needed, by, where, GREENEST_HOUR in measures).select(*by, *[made[m] for m in measures])
