"""Stress totals by scenario and region, and the combined view over domains.

Two ways lead to the same totals. ``by_scenario_region`` sums a gold table.
``stress_totals`` uses that conversion and stress are both multiplications by a
value per group: it sums the raw amounts per group first and multiplies the few
sums afterwards, so no row is expanded and only partial sums are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stresslake.functions.columns import exact_product
from stresslake.operators.cleaning import require_columns
from stresslake.operators.fx import Rates, attach_rates
from stresslake.operators.scenario import DEFAULT_SET, ScenarioSet, expand_scenarios
from stresslake.specs import (
    CURRENCY, FACTOR, RATE, REGION, SCENARIO, SPECS, TRANSFORMABLE, TableSpec, spec_for,
)

KEYS = [SCENARIO, REGION]


def by_scenario_region(gold: DataFrame, table: str | TableSpec) -> DataFrame:
    """Sum of the table's stressed amount per scenario and region."""
    measure = spec_for(table).measure
    require_columns(gold, [*KEYS, measure.target], f"aggregate {spec_for(table).name}")
    return gold.groupBy(*KEYS).agg(F.sum(measure.target).alias(measure.total))


def by_scenario(gold: DataFrame, table: str | TableSpec) -> DataFrame:
    """Sum of the table's stressed amount per scenario."""
    measure = spec_for(table).measure
    return gold.groupBy(SCENARIO).agg(F.sum(measure.target).alias(measure.combined))


def roll_up(totals: DataFrame, table: str | TableSpec) -> DataFrame:
    """Regional totals to scenario totals: a sum of sums, no second pass over gold."""
    measure = spec_for(table).measure
    return totals.groupBy(SCENARIO).agg(F.sum(measure.total).alias(measure.combined))


def _times(df: DataFrame, left: str, right: str) -> Column:
    return exact_product(
        F.col(left), df.schema[left].dataType, F.col(right), df.schema[right].dataType
    )


def stress_totals(
    df: DataFrame, table: str | TableSpec, rates: Rates,
    scenarios: ScenarioSet | DataFrame = DEFAULT_SET, keys: tuple[str, ...] = (REGION,),
    with_count: bool = False,
) -> DataFrame:
    """Totals per scenario and ``keys`` from unconverted rows, aggregated first.

    ``df`` needs the raw amount, the currency and the keys. The result equals
    convert, expand, stress and sum; exactly so for decimal amounts.
    """
    spec = spec_for(table)
    measure = spec.measure
    amount = measure.source.removesuffix("_usd")
    sums = df.groupBy(*keys, CURRENCY).agg(
        F.sum(amount).alias("_sum"), F.count(F.lit(1)).alias("_rows")
    )
    return stress_sums(sums, table, rates, scenarios, keys, with_count)


def stress_sums(
    sums: DataFrame, table: str | TableSpec, rates: Rates,
    scenarios: ScenarioSet | DataFrame = DEFAULT_SET, keys: tuple[str, ...] = (REGION,),
    with_count: bool = False,
) -> DataFrame:
    """Second half of :func:`stress_totals`, over (keys, currency, ``_sum``, ``_rows``)."""
    measure = spec_for(table).measure
    rated = attach_rates(sums, rates)
    in_base = rated.withColumn("_sum", _times(rated, "_sum", RATE))
    per_key = in_base.groupBy(*keys).agg(F.sum("_sum").alias("_sum"), F.sum("_rows").alias("_rows"))
    expanded = expand_scenarios(per_key, scenarios)
    return expanded.select(
        SCENARIO, *keys, _times(expanded, "_sum", FACTOR).alias(measure.total),
        *([F.col("_rows").alias("n")] if with_count else []),
    )


def combine(totals: Mapping[str, DataFrame], fill_key: bool = False) -> DataFrame:
    """Full outer join of the per-scenario totals; metrics missing on a side become 0.

    A NULL scenario id stays NULL unless ``fill_key`` asks for 0 as well.
    """
    frames = [totals[name] for name in TRANSFORMABLE if name in totals]
    joined = reduce(lambda a, b: a.join(b, SCENARIO, "full_outer"), frames)
    metrics = [c for c in joined.columns if c != SCENARIO]
    return fill_metrics(joined, joined.columns if fill_key else metrics)


def fill_metrics(df: DataFrame, names: list[str]) -> DataFrame:
    zero = {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in names}
    return df.withColumns(zero)


def combine_by_union(totals: Mapping[str, DataFrame]) -> DataFrame:
    """The combined view in one exchange: tag, union, sum per metric.

    Takes regional or scenario totals alike, so it also does the roll-up.
    """
    names = [n for n in TRANSFORMABLE if n in totals]
    long = []
    for name in names:
        measure = SPECS[name].measure
        frame = totals[name]
        value = measure.total if measure.total in frame.columns else measure.combined
        long.append(frame.select(SCENARIO, F.lit(name).alias("_metric"), F.col(value).alias("_v")))
    stacked = reduce(DataFrame.unionByName, long)
    wide = stacked.groupBy(SCENARIO).agg(*[
        F.sum(F.when(F.col("_metric") == name, F.col("_v"))).alias(SPECS[name].measure.combined)
        for name in names
    ])
    return fill_metrics(wide, [c for c in wide.columns if c != SCENARIO])


def aggregates(golds: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All report aggregates of the given gold tables, lazily, keyed by table name."""
    per_table = {name: by_scenario_region(gold, name) for name, gold in golds.items()}
    out = {f"aggregates_{name}": frame for name, frame in per_table.items()}
    out["aggregates_combined"] = combine_by_union(per_table)
    return out
