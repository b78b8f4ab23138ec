"""Registered queries over stored tables and streams, with the SQL they must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.operators import aggregates as agg
from stresslake.operators import kpi, scenario
from stresslake.plans import domains
from stresslake.plans import oracle as sql
from stresslake.plans.catalog import EXACT_RATES, LOADED, iso, money, priced, register
from stresslake.sources import readers, writers
from stresslake.specs import SPECS, TRANSFORMABLE, Layout
from stresslake.streaming import gated


@register("stream_gated_bronze", sql.STREAMED)
def stream_gated_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops through the gate in two runs of a stream; a run in between finds nothing new.

    Per drop its status, rows and issues, and the sum of the amounts that its rows have
    in bronze or in quarantine.
    """
    layout, table = Layout(writers.scratch_root(spark), undated=("transactions",)), "transactions"
    orders = domains.table(spark, sf_dir, "orders")

    def half(condition: str) -> DataFrame:
        only = orders.where(condition).select(F.col("o_orderkey").alias("transaction_id"))
        return domains.full_transactions(spark, sf_dir, only)

    def run() -> None:
        gated.stream_gated(spark, layout, table, as_of=LOADED).awaitTermination()

    writers.write_csv_drop(half("o_orderstatus = 'F'"), layout.raw(table), table, "1")
    run()
    run()
    writers.write_csv_drop(half("o_orderstatus <> 'F'"), layout.raw(table), table, "2")
    writers.write_csv_drop(domains.raw_transactions(spark, sf_dir), layout.raw(table), table, "3")
    run()

    amount = F.sum(F.col("transaction_amount").cast(domains.MONEY)).alias("total")
    held = [f(spark, layout, table) for f in (gated.streamed_bronze, gated.quarantined)]
    totals = held[0].groupBy(gated.LOAD).agg(amount).unionByName(held[1].groupBy(gated.LOAD).agg(amount))
    found = gated.load_log(spark, layout, table).join(totals, gated.LOAD)
    return found.select(gated.LOAD, "status", "rows", "note", money("total"))


# --- slices of stored gold ----------------------------------------------------------


def stored_gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Gold of a domain, written by scenario and region and read again."""
    layout = Layout(writers.scratch_root(spark), undated=(name,))
    spec = SPECS[name]
    silver = priced(domains.domain(spark, sf_dir, name), name)
    writers.write_partitioned(silver, layout.silver(name), layout.partitions(spec, "silver"), rebalance=False)
    rows = scenario.to_gold(readers.read_table(spark, layout.silver(name)), name, scenario.DECIMAL_SET)
    writers.write_partitioned(rows, layout.gold(name), layout.partitions(spec, "gold"), rebalance=False)
    return readers.read_table(spark, layout.gold(name))


STORED_SLICE = sql.base("loans") + "\nUNION ALL ".join(
    f"""SELECT '{kind}' AS slice, scenario_id, region_code, COUNT(*) AS n,
       {sql.money(f"SUM({sql._usd('loans')})", "total_stressed_exposure")}
FROM {sql._expanded("loans")} WHERE {condition} GROUP BY scenario_id, region_code"""
    for kind, condition in (
        ("named", "scenario_id IN (1, 5) AND region_code IN ('ASIA', 'EUROPE')"),
        ("dimension", "region_code IN (SELECT r_name FROM region WHERE r_name LIKE 'A%')"),
    )
)


@register("kpi_stored_slice", STORED_SLICE)
def kpi_stored_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of stored gold that read their own directories only.

    One names scenarios and regions; the other takes the regions that a filter of the
    region table leaves.
    """
    gold = stored_gold(spark, sf_dir, "loans")
    regions = domains.table(spark, sf_dir, "region").where("r_name LIKE 'A%'")
    slices = {
        "named": kpi.select_slice(gold, scenarios=[1, 5], regions=["ASIA", "EUROPE"]),
        "dimension": kpi.select_by(gold, regions.select(F.col("r_name").alias("region_code"))),
    }
    total = F.sum("stressed_exposure").alias("total_stressed_exposure")
    frames = [
        part.groupBy("scenario_id", "region_code").agg(F.count(F.lit(1)).alias("n"), total).select(
            F.lit(kind).alias("slice"), "scenario_id", "region_code", "n", money("total_stressed_exposure"))
        for kind, part in slices.items()
    ]
    return frames[0].unionByName(frames[1])


# --- dashboard ----------------------------------------------------------------------

DASHBOARD = sql.base(*TRANSFORMABLE) + "\nUNION ALL ".join(
    f"""SELECT '{n}' AS table_name,
       concat_ws('x', CASE WHEN GROUPING(scenario_id) = 0 THEN 'scenario_id' END,
                 CASE WHEN GROUPING(region_code) = 0 THEN 'region_code' END,
                 CASE WHEN GROUPING(day) = 0 THEN 'day' END) AS level,
       scenario_id, region_code, CAST(day AS VARCHAR) AS day, COUNT(*) AS n, {sql.money(f"SUM({sql._usd(n)})", "total")}
FROM (SELECT *, {SPECS[n].date_col} AS day FROM {sql._expanded(n)})
GROUP BY GROUPING SETS ((scenario_id), (region_code), (scenario_id, region_code), (scenario_id, day), ())"""
    for n in TRANSFORMABLE
)


@register("kpi_dashboard_grid", DASHBOARD)
def kpi_dashboard_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All totals of the dashboard by one pass of grouping sets over daily sums."""
    daily = {}
    for name in TRANSFORMABLE:
        day = SPECS[name].date_col
        sums = domains.regional_sums(spark, sf_dir, name, (day,))
        totals = agg.stress_sums(
            sums, name, EXACT_RATES, scenario.DECIMAL_SET, ("region_code", day), with_count=True
        )
        measure = SPECS[name].measure
        # A common type, wide enough for the sums and short enough to keep their scale.
        daily[name] = totals.withColumn(measure.total, F.col(measure.total).cast("decimal(30,12)"))
    grid = kpi.dashboard_grid(daily)
    return grid.select("table_name", "level", "scenario_id", "region_code", iso("day"), "n", money("total"))
