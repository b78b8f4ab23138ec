"""Scenario expansion: every row once per stress scenario."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.functions.columns import literal_frame, stress_level
from stresslake.operators.cleaning import default_date, require_columns
from stresslake.specs import (
    FACTOR, SCENARIO, SCENARIO_END, SCENARIO_START, SCENARIOS, TableSpec, spec_for,
)

# id and factor pairs, with the Spark type of the factor
ScenarioSet = tuple[Sequence[tuple[int, object]], str]
DEFAULT_SET: ScenarioSet = ([(row[0], row[-1]) for row in SCENARIOS], "double")
DECIMAL_SET: ScenarioSet = (DEFAULT_SET[0], "decimal(6,2)")


def scenario_table(spark: SparkSession) -> DataFrame:
    """The built-in scenario table in the registry schema."""
    schema = spec_for("scenario").schema
    rows = [
        F.struct(*[
            F.lit(str(value)).cast(f.dataType).alias(f.name)
            for value, f in zip((*row, SCENARIO_START, SCENARIO_END), schema, strict=True)
        ])
        for row in SCENARIOS
    ]
    return literal_frame(spark, F.array(*rows))


def first_scenarios(scenarios: DataFrame, limit: int | None = None) -> DataFrame:
    """Ids and factors of all scenarios, or of the first ``limit`` by id."""
    rows = require_columns(scenarios, [SCENARIO, FACTOR], "scenario").select(SCENARIO, FACTOR)
    return rows if limit is None else rows.orderBy(SCENARIO, FACTOR).limit(limit)


def active_scenarios(scenarios: DataFrame, day: str) -> DataFrame:
    """Scenarios whose validity covers ``day`` (start inclusive, end exclusive)."""
    date = F.lit(day).cast("date")
    return scenarios.where((F.col("effective_date") <= date) & (date < F.col("expiry_date")))


def expand_scenarios(
    df: DataFrame, scenarios: ScenarioSet | DataFrame = DEFAULT_SET, limit: int | None = None,
) -> DataFrame:
    """Every row once per scenario, with ``scenario_id`` and the factor added.

    A scenario table is joined without a key: all combinations are the result, and
    Spark picks the side to send by measured size. Scenarios that the caller passes as
    a literal become an array that each row unfolds in place. ``limit`` takes the first
    scenarios by id.
    """
    if isinstance(scenarios, DataFrame):
        return df.crossJoin(first_scenarios(scenarios, limit))
    pairs, factor_type = scenarios
    if limit is not None:
        pairs = sorted(pairs, key=lambda p: p[0])[:limit]
    # The cast types the array even when it is empty (then no row is left).
    array_type = f"array<struct<{SCENARIO}:int,{FACTOR}:{factor_type}>>"
    literal = F.array(*[
        F.struct(
            F.lit(number).cast("int").alias(SCENARIO),
            F.lit(None if factor is None else Decimal(str(factor))).cast(factor_type).alias(FACTOR),
        )
        for number, factor in pairs
    ]).cast(array_type)
    return df.select("*", F.inline(literal))


def add_stress(df: DataFrame, table: str | TableSpec) -> DataFrame:
    """Stressed amount of the table (if its USD amount is present) and ``stress_level``."""
    spec = spec_for(table)
    require_columns(df, [FACTOR], f"stress {spec.name}")
    added = {}
    if spec.measure and spec.measure.source in df.columns:
        added[spec.measure.target] = F.col(spec.measure.source) * F.col(FACTOR)
    return df.withColumns({**added, "stress_level": stress_level(F.col(FACTOR))})


def to_gold(
    df: DataFrame, table: str | TableSpec, scenarios: ScenarioSet | DataFrame = DEFAULT_SET,
    limit: int | None = None, as_of: str | None = None,
) -> DataFrame:
    """Silver to gold: expand over scenarios, stress the amount, make sure of the date."""
    spec = spec_for(table)
    gold = add_stress(expand_scenarios(df, scenarios, limit), spec)
    gold = default_date(gold, spec.date_col, as_of)
    return require_columns(gold, spec.gold_partitions, f"gold {spec.name}")
