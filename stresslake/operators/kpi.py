"""Reporting measures over aggregate tables.

All inputs are totals per scenario, region and possibly day, so their size is set
by the reporting grid and not by the number of records. Definitions are this
library's own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stresslake.functions.columns import stress_level
from stresslake.operators.aggregates import combine_by_union
from stresslake.specs import BASE_SCENARIO, FACTOR, REGION, SCENARIO, TableSpec, spec_for

# Card names of the combined metrics.
CARDS = {
    "txn_total": "transaction_volume",
    "liq_total": "total_liquidity",
    "loan_total": "total_exposure",
    "intraday_total": "net_intraday_position",
}


def kpi_cards(totals: Mapping[str, DataFrame]) -> DataFrame:
    """One row per scenario with the headline totals."""
    wide = combine_by_union(totals)
    return wide.select(SCENARIO, *[F.col(c).alias(n) for c, n in CARDS.items() if c in wide.columns])


def transaction_volume(totals: DataFrame) -> DataFrame:
    """Record count and stressed sum of transactions per scenario (needs ``n``)."""
    measure = spec_for("transactions").measure
    return totals.groupBy(SCENARIO).agg(
        F.sum("n").alias("transaction_count"), F.sum(measure.total).alias("transaction_volume")
    )


def stress_impact(combined: DataFrame, base: int = BASE_SCENARIO) -> DataFrame:
    """Change of each metric against the base scenario, in percent of its size.

    NULL where the base is zero or absent.
    """
    metrics = [c for c in combined.columns if c != SCENARIO]
    long = combined.unpivot([SCENARIO], metrics, "metric", "scenario_total")
    value = F.col("scenario_total").cast("double")
    base_value = F.max(F.when(F.col(SCENARIO) == base, value)).over(W.partitionBy("metric"))
    return (
        long.withColumn("base_total", base_value)
        .withColumn("scenario_total", value)
        .withColumn(
            "impact_pct",
            F.try_divide(F.col("scenario_total") - F.col("base_total"), F.abs("base_total")) * 100,
        )
    )


def select_slice(
    df: DataFrame, scenarios: Sequence[int] | None = None, regions: Sequence[str] | None = None
) -> DataFrame:
    """Scenario and region filters; on partitioned tables they prune directories."""
    if scenarios is not None:
        df = df.where(F.col(SCENARIO).isin(*scenarios))
    if regions is not None:
        df = df.where(F.col(REGION).isin(*regions))
    return df


def select_by(df: DataFrame, dimension: DataFrame, column: str = REGION) -> DataFrame:
    """Rows whose ``column`` stands in a (filtered) dimension table.

    On a table stored by that column Spark prunes directories while the query runs, once
    it knows what the filter of the dimension leaves. Repeated and NULL values of the
    dimension add no rows.
    """
    wanted = dimension.select(F.col(column)).distinct()
    return df.join(wanted, column, "left_semi")


# Levels of the dashboard: what a total is broken down by.
GRID = (("scenario_id",), ("region_code",), ("scenario_id", "region_code"), ("scenario_id", "day"), ())


def dashboard_grid(daily: Mapping[str, DataFrame], sets: Sequence[tuple[str, ...]] = GRID) -> DataFrame:
    """Totals of all tables at all levels of the dashboard, from one grouping.

    ``daily`` maps a table to its totals per scenario, region and day, with ``n``. A row
    has table_name, level (the columns it is broken down by, joined by ``x``), those
    columns (NULL where the level sums over them), n and total. Every table is read
    once; the levels are grouping sets over the same rows.
    """
    def long(name: str, totals: DataFrame) -> DataFrame:
        spec = spec_for(name)
        return totals.select(
            F.lit(name).alias("table_name"), SCENARIO, REGION, F.col(spec.date_col).alias("day"), "n",
            F.col(spec.measure.total).alias("total"),
        )

    rows = reduce(DataFrame.unionByName, [long(name, totals) for name, totals in daily.items()])
    keys = [SCENARIO, REGION, "day"]
    level = F.concat_ws("x", *[F.when(F.grouping(k) == 0, F.lit(k)) for k in keys])
    grouped = rows.groupingSets(
        [[F.col("table_name"), *map(F.col, s)] for s in sets], "table_name", *keys
    )
    return grouped.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), level.alias("level"))


def region_share(totals: DataFrame, table: str | TableSpec) -> DataFrame:
    """Each region's part of its scenario's total, in percent."""
    value = F.col(spec_for(table).measure.total).cast("double")
    whole = F.sum("region_total").over(W.partitionBy(SCENARIO))
    return totals.select(SCENARIO, REGION, value.alias("region_total")).withColumn(
        "share_pct", F.try_divide(F.col("region_total"), whole) * 100
    )


def daily_trend(daily: DataFrame, table: str | TableSpec) -> DataFrame:
    """Per scenario and region: daily total, previous day, change and running sum."""
    spec = spec_for(table)
    value, day = F.col(spec.measure.total), F.col(spec.date_col)
    series = W.partitionBy(SCENARIO, REGION).orderBy("day")
    previous = F.lag("daily_total").over(series)
    running = F.sum("daily_total").over(series.rowsBetween(W.unboundedPreceding, 0))
    return daily.select(SCENARIO, REGION, day.alias("day"), value.alias("daily_total")).select(
        SCENARIO, REGION, "day", "daily_total",
        previous.alias("previous_total"),
        (F.col("daily_total") - previous).alias("change"),
        running.alias("running_total"),
    )


def scenario_comparison(
    totals: DataFrame, table: str | TableSpec, scenarios: Sequence[int]
) -> DataFrame:
    """One row per region, one column for each of the given scenarios."""
    measure = spec_for(table).measure
    wide = totals.groupBy(REGION).pivot(SCENARIO, list(scenarios)).agg(F.sum(measure.total))
    return wide.toDF(REGION, *[f"scenario_{s}" for s in scenarios])


def level_insights(totals: DataFrame, factors: DataFrame, table: str | TableSpec) -> DataFrame:
    """Records and totals by stress level, from totals with ``n`` per scenario."""
    measure = spec_for(table).measure
    named = totals.join(factors.select(SCENARIO, FACTOR), SCENARIO)
    return named.groupBy(stress_level(F.col(FACTOR)).alias("stress_level")).agg(
        F.sum("n").alias("records"), F.sum(measure.total).alias(measure.total)
    )
