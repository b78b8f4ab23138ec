"""Registered queries: each operator over the test tables, with the SQL it must equal.

Money is decimal inside a query and rounded once, at its edge, to four decimals.
Dates leave as ISO text. Both keep results comparable between engines.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.operators import aggregates as agg
from stresslake.operators import cleaning, fx, kpi, quality, scenario, validate
from stresslake.plans import domains, medallion
from stresslake.plans import oracle as sql
from stresslake.sources import readers, writers
from stresslake.specs import FALLBACK_RATES, SCENARIOS, SPECS, TRANSFORMABLE, Layout

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

EXACT_RATES = {code: Decimal(str(rate)) for code, rate in FALLBACK_RATES.items()}
AS_OF = "1999-12-31"
LOADED = "2024-01-31"  # a day after all others


def register(name: str, oracle: str | None):
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLE[name] = oracle
        return query

    return add


def money(name: str, alias: str | None = None) -> Column:
    return F.col(name).cast("decimal(38,4)").cast("double").alias(alias or name)


def iso(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def priced(df: DataFrame, name: str) -> DataFrame:
    """Converted rows with the static rates as decimals."""
    return fx.convert_amounts(df, name, EXACT_RATES)


def gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = priced(domains.domain(spark, sf_dir, name), name)
    return scenario.to_gold(rows, name, scenario.DECIMAL_SET)


def regional_totals(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Totals with row counts by the aggregate-first plan."""
    sums = domains.regional_sums(spark, sf_dir, name)
    return agg.stress_sums(sums, name, EXACT_RATES, scenario.DECIMAL_SET, with_count=True)


# --- stress totals --------------------------------------------------------------

_TOTAL_NAMES = {
    "transactions": "agg_transaction_stress",
    "cash": "agg_liquidity_stress",
    "loans": "agg_loan_exposure",
    "intraday": "agg_intraday_position",
}


def _register_totals(name: str) -> None:
    total = SPECS[name].measure.total

    @register(_TOTAL_NAMES[name], sql.region_totals(name))
    def totals_only(spark: SparkSession, sf_dir: str) -> DataFrame:
        totals = regional_totals(spark, sf_dir, name)
        return totals.select("scenario_id", "region_code", money(total))

    @register(f"stress_totals_{name}", sql.region_totals(name, with_count=True))
    def early_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
        totals = regional_totals(spark, sf_dir, name)
        return totals.select("scenario_id", "region_code", money(total), "n")


for _name in TRANSFORMABLE:
    _register_totals(_name)

_COMBINED = [SPECS[n].measure.combined for n in TRANSFORMABLE]


@register("combined_metrics", sql.combined())
def combined_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By way of expanded gold rows; its equal by early sums is the rollup below."""
    totals = {n: agg.by_scenario(gold(spark, sf_dir, n), n) for n in TRANSFORMABLE}
    return agg.combine(totals).select("scenario_id", *map(money, _COMBINED))


@register("combined_metrics_rollup", sql.combined())
def combined_metrics_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = {n: regional_totals(spark, sf_dir, n) for n in TRANSFORMABLE}
    return agg.combine_by_union(totals).select("scenario_id", *map(money, _COMBINED))


@register("regional_rollup_loans", sql.rollup("loans"))
def regional_rollup_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = agg.roll_up(regional_totals(spark, sf_dir, "loans"), "loans")
    return rolled.select("scenario_id", money("loan_total"))


# --- currency conversion --------------------------------------------------------


def _register_conversion(name: str) -> None:
    spec, key = SPECS[name], sql.KEYS[name]
    usd = [f"{a}_usd" for a in spec.amounts]

    @register(f"fx_convert_{name}", sql.conversion(name))
    def converted(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = priced(domains.domain(spark, sf_dir, name), name)
        return rows.select(*key, "currency_code", money("rate_to_usd"), *map(money, usd))


for _name in TRANSFORMABLE:
    _register_conversion(_name)


def feed_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest feed rate per currency as a provider would answer: lower case, no AED."""
    newest = fx.latest_rates(domains.fx_feed(spark, sf_dir))
    return newest.where("currency_code <> 'AED'").select(
        F.lower("currency_code").alias("currency_code"), "rate_to_usd"
    )


def _register_resolution(mode: str) -> None:
    @register(f"fx_resolve_{mode}", sql.resolved(mode))
    def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
        chosen = fx.resolve_rates(feed_answer(spark, sf_dir), fx.rates_frame(spark, EXACT_RATES), mode)
        return chosen.select("currency_code", F.col("rate_to_usd").cast("double").alias("rate_to_usd"))


for _mode in ("per_currency", "all_or_nothing"):
    _register_resolution(_mode)


@register("fx_latest_rates", sql.LATEST_RATES)
def fx_latest_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = fx.latest_rates(domains.fx_feed(spark, sf_dir))
    return newest.select("currency_code", F.col("rate_to_usd").cast("double").alias("rate_to_usd"))


@register("fx_convert_feed_rates", sql.CONVERT_FEED)
def fx_convert_feed_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions at the newest rates of the whole feed, summed per currency."""
    newest = fx.latest_rates(domains.fx_feed(spark, sf_dir))
    chosen = fx.resolve_rates(newest, fx.rates_frame(spark, EXACT_RATES), "per_currency")
    rows = domains.domain(spark, sf_dir, "transactions")
    usd = fx.convert_amounts(rows, "transactions", chosen)
    return (
        usd.groupBy("currency_code")
        .agg(F.sum("transaction_amount_usd").alias("amount_usd"), F.count(F.lit(1)).alias("n"))
        .select("currency_code", money("amount_usd"), "n")
    )


@register("fx_convert_inverted", sql.CONVERT_INVERTED)
def fx_convert_inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed quoted per USD: inverting it turns 4 units per USD into 0.25 USD each."""
    quoted = {"USD": 1, "EUR": Decimal("0.8"), "JPY": 160, "AED": 4}
    live = fx.rates_frame(spark, quoted, "decimal(12,6)")
    chosen = fx.resolve_rates(live, fx.rates_frame(spark, EXACT_RATES), direction="base_to_quote")
    usd = fx.convert_amounts(domains.domain(spark, sf_dir, "transactions"), "transactions", chosen)
    return (
        usd.groupBy("currency_code", "rate_to_usd")
        .agg(F.sum("transaction_amount_usd").alias("amount_usd"))
        .select("currency_code", F.col("rate_to_usd").cast("double"), money("amount_usd"))
    )


@register("fx_convert_to_base", sql.CONVERT_TO_BASE)
def fx_convert_to_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-wise conversion by lookup, any case of the code."""
    rows = domains.domain(spark, sf_dir, "transactions")
    code = F.when(F.col("transaction_type") == "5-LOW", F.lower("currency_code")).when(
        F.col("transaction_type") != "1-URGENT", F.col("currency_code")
    )
    usd = fx.convert_to_base(F.col("transaction_amount"), code, EXACT_RATES)
    return rows.withColumn("amount_usd", usd).select("transaction_id", money("amount_usd"))


# --- scenarios ------------------------------------------------------------------


@register("scenario_expand_loans", sql.SCENARIO_EXPAND_LOANS)
def scenario_expand_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = gold(spark, sf_dir, "loans")
    return out.select(
        "loan_id", "tranche", "branch_id", iso("business_date"), "scenario_id",
        money("market_stress_factor"), money("stressed_exposure"), "stress_level",
    )


@register("scenario_first_n", sql.SCENARIO_FIRST_N)
def scenario_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the first three scenarios by id, read from a scenario table."""
    rows = domains.domain(spark, sf_dir, "cash")
    return (
        scenario.expand_scenarios(rows, scenario.scenario_table(spark), 3)
        .groupBy("scenario_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("closing_balance").alias("closing_balance"))
        .select("scenario_id", "n", money("closing_balance"))
    )


@register("stress_level_distribution", sql.LEVELS)
def stress_level_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and stressed exposure per level straight from the expanded rows."""
    rows = gold(spark, sf_dir, "loans")
    return (
        rows.groupBy("stress_level")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("stressed_exposure").alias("stressed_exposure"))
        .select("stress_level", "records", money("stressed_exposure"))
    )


# --- cleaning -------------------------------------------------------------------


@register("dedup_rows", sql.DEDUP_ROWS)
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line sent twice; one copy of each is left."""
    lines = domains.table(spark, sf_dir, "lineitem")
    return cleaning.dedup_rows(lines.unionByName(lines)).withColumn("l_shipdate", iso("l_shipdate"))


@register("clean_numeric_string_date", sql.CLEAN_TYPES)
def clean_numeric_string_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = domains.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "view", "n/a").when(kind != "error", F.col("value").cast("string")).alias("amount"),
        F.nullif(kind, F.lit("click")).alias("label"),
        F.when(kind == "signup", "soon").otherwise(F.col("ts").cast("date").cast("string")).alias("day"),
    )
    out = cleaning.ensure_numeric(text, "amount")
    out = cleaning.ensure_string(out, "label")
    out = cleaning.ensure_date(out, "day")
    out = cleaning.ensure_numeric(out, "fee", 1.5)
    out = cleaning.ensure_string(out, "branch")
    out = cleaning.ensure_date(out, "loaded", AS_OF)
    return out.select("event_id", "amount", "label", iso("day"), "fee", "branch", iso("loaded"))


@register("normalize_names", sql.NORMALIZE_NAMES)
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = domains.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(" Order Key"),
        F.col("o_orderpriority").alias("PRIORITY "),
        F.col("o_orderstatus").alias("Order Status"),
        F.col("o_custkey").alias("Cust Key"),
        F.col("o_totalprice").alias("TOTAL price"),
        F.col("o_orderdate").cast("date").cast("string").alias("Order_Date "),
    )
    return cleaning.normalize_names(orders)


@register("default_region", sql.DEFAULT_REGION)
def default_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without region and date get the defaults of the bronze layer."""
    rows = domains.table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return cleaning.to_bronze(rows, "loans", AS_OF).select(
        "s_suppkey", "region_code", iso("business_date")
    )


@register("default_currency", sql.DEFAULT_CURRENCY)
def default_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a currency column count as USD."""
    rows = domains.transaction_rows(spark, sf_dir)
    return priced(rows, "transactions").select(
        "transaction_id", "currency_code", money("transaction_amount_usd")
    )


@register("date_from_timestamp", sql.DATE_FROM_TIMESTAMP)
def date_from_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = domains.intraday_rows(spark, sf_dir).drop("as_of_timestamp_date")
    bronze = cleaning.to_bronze(rows, "intraday")
    return (
        bronze.groupBy("region_code", "as_of_timestamp_date")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("region_code", iso("as_of_timestamp_date"), "n")
    )


# --- validation -----------------------------------------------------------------


@register("validate_bronze", sql.VALIDATE_BRONZE)
def validate_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [
        validate.validate_bronze(domains.domain(spark, sf_dir, n), n) for n in TRANSFORMABLE
    ]
    frames.append(validate.validate_bronze(domains.fx_feed(spark, sf_dir), "fx_rates"))
    frames.append(validate.validate_bronze(scenario.scenario_table(spark), "scenario"))
    return reduce(DataFrame.unionByName, frames)


@register("validate_silver", sql.VALIDATE_SILVER)
def validate_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = cleaning.ensure_date(domains.raw_transactions(spark, sf_dir), "transaction_date")
    keys = {"loans": ("loan_id", "tranche")}
    frames = [validate.validate_silver(raw, "transactions"),
              validate.validate_silver(domains.fx_feed(spark, sf_dir), "fx_rates")]
    frames += [
        validate.validate_silver(domains.domain(spark, sf_dir, n), n, keys.get(n, ()))
        for n in ("cash", "loans", "intraday")
    ]
    return reduce(DataFrame.unionByName, frames)


@register("validate_gold", sql.VALIDATE_GOLD)
def validate_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        validate.validate_gold(gold(spark, sf_dir, n), n) for n in TRANSFORMABLE
    ])


@register("row_counts", sql.ROW_COUNTS)
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "lineitem", "customer", "events")
    return reduce(DataFrame.unionByName, [
        validate.count_rows(domains.table(spark, sf_dir, n)).select(
            F.lit(n).alias("table_name"), "row_count")
        for n in names
    ])


@register("duplicate_keys", sql.DUPLICATE_KEYS)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.duplicate_keys(
        domains.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber"
    )


@register("key_counts", sql.KEY_COUNTS)
def key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.key_counts(domains.raw_transactions(spark, sf_dir), "transaction_type")


# --- quality profile ------------------------------------------------------------


@register("null_metrics", sql.NULL_METRICS)
def null_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_metrics(domains.raw_loans(spark, sf_dir))


@register("worst_null_column", sql.WORST_NULL)
def worst_null_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.worst_null_column(domains.raw_transactions(spark, sf_dir))


@register("duplicate_metrics", sql.DUPLICATE_METRICS)
def duplicate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_metrics(domains.raw_transactions(spark, sf_dir), "transactions").unionByName(
        quality.duplicate_metrics(
            domains.raw_loans(spark, sf_dir), "loans", key=("loan_id", "tranche")
        )
    )


@register("semantic_types", sql.SEMANTIC_TYPES)
def semantic_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = domains.table(spark, sf_dir, "events")
    loans = quality.semantic_types(domains.raw_loans(spark, sf_dir))
    text = quality.semantic_types(events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("string").alias("event_time"),
        F.col("ts").cast("date").alias("event_day"),
        F.when(F.col("event_type") != "view", F.col("user_id").cast("string")).alias("user_text"),
        "value", "event_type",
    ))
    return loans.unionByName(text)


@register("schema_check", sql.SCHEMA_CHECK)
def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.schema_check(domains.raw_loans(spark, sf_dir), "loans")


@register("format_validity", sql.FORMAT_VALIDITY)
def format_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.format_validity(domains.raw_loans(spark, sf_dir), "loans")


@register("column_statistics", sql.COLUMN_STATISTICS)
def column_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = domains.table(spark, sf_dir, "lineitem").select(
        F.lit(None).cast("string").alias("note"),
        "l_orderkey", F.col("l_extendedprice").cast(domains.MONEY).alias("l_extendedprice"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_returnflag", "l_linenumber",
    )
    return quality.column_statistics(rows)


@register("business_rules", sql.BUSINESS_RULES)
def business_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    cash = domains.domain(spark, sf_dir, "cash").withColumn("opening_balance", F.col("closing_balance"))
    net = F.col("net_position") + F.when(F.col("inflow_amount") > 50, 0.01).otherwise(0).cast("decimal(4,2)")
    frames = {
        "transactions": domains.raw_transactions(spark, sf_dir),
        "loans": domains.raw_loans(spark, sf_dir),
        "cash": cash,
        "intraday": domains.intraday_rows(spark, sf_dir).withColumn("net_position", net),
        "fx_rates": domains.fx_feed(spark, sf_dir),
    }
    return reduce(DataFrame.unionByName, [
        quality.business_rule_checks(df, name, AS_OF) for name, df in frames.items()
    ])


@register("record_count_check", sql.RECORD_COUNT)
def record_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = domains.table(spark, sf_dir, "orders")
    return reduce(DataFrame.unionByName, [
        quality.record_count_check(orders, n) for n in (None, 15000, 14286, 100)
    ])


@register("quality_report", sql.QUALITY_REPORT)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    txn = quality.quality_report(
        domains.raw_transactions(spark, sf_dir), "transactions", as_of=AS_OF
    )
    loans = quality.quality_report(
        domains.raw_loans(spark, sf_dir), "loans", as_of=AS_OF, key=("loan_id", "tranche")
    )
    return txn.unionByName(loans)


# --- reporting measures ---------------------------------------------------------


@register("kpi_cards", sql.KPI_CARDS)
def kpi_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = {n: regional_totals(spark, sf_dir, n) for n in TRANSFORMABLE}
    cards = kpi.kpi_cards(totals)
    return cards.select("scenario_id", *[money(c) for c in kpi.CARDS.values()])


@register("kpi_transaction_volume", sql.KPI_VOLUME)
def kpi_transaction_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = kpi.transaction_volume(regional_totals(spark, sf_dir, "transactions"))
    return volume.select("scenario_id", "transaction_count", money("transaction_volume"))


@register("kpi_stress_impact_pct", sql.KPI_IMPACT)
def kpi_stress_impact_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.stress_impact(combined_metrics_rollup(spark, sf_dir))


@register("kpi_region_share", sql.KPI_SHARE)
def kpi_region_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = regional_totals(spark, sf_dir, "loans").withColumn(
        "total_stressed_exposure", F.col("total_stressed_exposure").cast("decimal(38,4)")
    )
    shares = kpi.region_share(totals, "loans")
    return shares.withColumn("share_pct", F.round("share_pct", 6))


@register("kpi_daily_trend", sql.KPI_TREND)
def kpi_daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = "as_of_timestamp_date"
    sums = domains.regional_sums(spark, sf_dir, "intraday", (day,))
    daily = agg.stress_sums(
        sums, "intraday", EXACT_RATES, scenario.DECIMAL_SET, ("region_code", day)
    )
    trend = kpi.daily_trend(daily, "intraday")
    values = ["daily_total", "previous_total", "change", "running_total"]
    return trend.select("scenario_id", "region_code", iso("day"), *map(money, values))


@register("kpi_scenario_pivot", sql.KPI_PIVOT)
def kpi_scenario_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = [row[0] for row in SCENARIOS]
    wide = kpi.scenario_comparison(regional_totals(spark, sf_dir, "transactions"), "transactions", ids)
    return wide.select("region_code", *[money(f"scenario_{i}") for i in ids])


@register("kpi_level_insights", sql.KPI_LEVELS)
def kpi_level_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = regional_totals(spark, sf_dir, "loans")
    levels = kpi.level_insights(totals, scenario.scenario_table(spark), "loans")
    return levels.select("stress_level", "records", money("total_stressed_exposure"))


@register("kpi_slice", sql.KPI_SLICE)
def kpi_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = regional_totals(spark, sf_dir, "cash")
    part = kpi.select_slice(totals, scenarios=[1, 5], regions=["ASIA", "EUROPE"])
    return part.select("scenario_id", "region_code", money("total_stressed_liquidity"), "n")


# --- layered runs ---------------------------------------------------------------
# Intermediate tables go to the session's shared checkpoint folder.


@register("ingest_latest_snapshot", sql.INGESTED)
def ingest_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raw drops of the same table; bronze holds the newer one."""
    layout = Layout(writers.scratch_root(spark))
    rows = domains.domain(spark, sf_dir, "intraday").drop("as_of_timestamp_date")
    old = rows.withColumn("net_position", F.col("net_position") * 2)
    writers.write_csv_drop(old, layout.raw("intraday"), "intraday", "20240101")
    writers.write_csv_drop(rows, layout.raw("intraday"), "intraday", "20240102")
    medallion.ingest_table(spark, layout, "intraday")
    return readers.read_table(spark, layout.bronze("intraday")).select(
        F.col("intraday_id").cast("bigint").alias("intraday_id"),
        iso("as_of_timestamp_date"), "region_code", "currency_code", "net_position",
    )


@register("ingest_all_tables", sql.INGESTED_ALL)
def ingest_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and amounts of all six tables in bronze, each from the newer of two drops."""
    layout = Layout(writers.scratch_root(spark), undated=("transactions", "loans", "intraday", "fx_rates"))
    frames = {n: domains.domain(spark, sf_dir, n) for n in TRANSFORMABLE}
    frames["fx_rates"] = domains.fx_feed(spark, sf_dir).withColumn("as_of_date", F.to_date("as_of_timestamp"))
    frames["scenario"] = scenario.scenario_table(spark)
    amounts = {n: SPECS[n].measure.source.removesuffix("_usd") for n in TRANSFORMABLE}
    amounts |= {"fx_rates": "fx_rate_to_usd", "scenario": "market_stress_factor"}
    for name, rows in frames.items():
        writers.write_csv_drop(rows.limit(0), layout.raw(name), name, "20240101")
        writers.write_csv_drop(rows, layout.raw(name), name, "20240102")
    medallion.ingest(spark, layout, as_of=AS_OF)
    return reduce(DataFrame.unionByName, [
        readers.read_table(spark, layout.bronze(name), "parquet" if name == "scenario" else None)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(amount).cast("decimal(18,6)")).alias("total"))
        .select(F.lit(name).alias("table_name"), "n", money("total"))
        for name, amount in amounts.items()
    ])


def _bronze_lake(spark: SparkSession, sf_dir: str) -> Layout:
    """A lake with the four domains and the scenarios in bronze."""
    # Their rows spread over many days, with few on each.
    layout = Layout(writers.scratch_root(spark), undated=("transactions", "loans", "intraday", "fx_rates"))
    for name in TRANSFORMABLE:
        bronze = cleaning.to_bronze(domains.domain(spark, sf_dir, name), name)
        partitions = layout.partitions(SPECS[name], "bronze")
        grouped = layout.many_directories(SPECS[name])
        writers.write_partitioned(bronze, layout.bronze(name), partitions, rebalance=grouped)
    factors = scenario.scenario_table(spark).withColumn(
        "market_stress_factor", F.col("market_stress_factor").cast("decimal(6,2)")
    )
    writers.write_unpartitioned(factors, layout.bronze("scenario"))
    return layout


@register("layer_roundtrip", sql.LAYER_TOTALS)
def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four domains through bronze, silver, gold and aggregates on storage."""
    layout = _bronze_lake(spark, sf_dir)
    medallion.run_pipeline(spark, layout, rates=EXACT_RATES)
    return reduce(DataFrame.unionByName, [
        readers.read_table(spark, layout.aggregate(f"aggregates_{n}")).select(
            F.lit(n).alias("table_name"), "scenario_id", "region_code",
            money(SPECS[n].measure.total, "total"),
        )
        for n in TRANSFORMABLE
    ])


@register("report_export", sql.REPORTED)
def report_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of all domains, their aggregates and the combined view as report extracts."""
    layout = Layout(writers.scratch_root(spark), undated=("transactions", "loans", "intraday"))
    for name in TRANSFORMABLE:
        silver = priced(domains.domain(spark, sf_dir, name), name)
        # By amount: it, its value in USD and the stressed amounts rise together, also in gold and its extract.
        writers.write_partitioned(
            silver, layout.silver(name), layout.partitions(SPECS[name], "silver"),
            rebalance=layout.many_directories(SPECS[name]), order=(SPECS[name].measure.source,),
        )
        stored = readers.read_table(spark, layout.silver(name))
        # A row's copies stay in its task, in the order of silver: no exchange of gold.
        writers.write_partitioned(
            scenario.to_gold(stored, name, scenario.DECIMAL_SET), layout.gold(name),
            layout.partitions(SPECS[name], "gold"), rebalance=False,
        )
    medallion.aggregate(spark, layout)
    medallion.export(spark, layout)

    def extract(name: str, value: str, region: Column) -> DataFrame:
        rows = spark.read.parquet(layout.report(name))
        return (
            rows.groupBy("scenario_id", region.alias("region_code"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
            .select(F.lit(name).alias("extract"), "scenario_id", "region_code", "n", money("total"))
        )

    region, parts = F.col("region_code"), []
    for name in TRANSFORMABLE:
        measure = SPECS[name].measure
        parts.append(extract(name, measure.target, region))
        parts.append(extract(f"aggregates_{name}", measure.total, region))
        combined = extract("aggregates_combined", measure.combined, F.lit(measure.combined))
        parts.append(combined)
    return reduce(DataFrame.unionByName, parts)


@register("run_report", sql.RUN_REPORT)
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run did with each table, one of them without a raw drop."""
    layout = Layout(writers.scratch_root(spark), undated=("transactions", "loans", "intraday"))
    for name in ("transactions", "loans", "cash"):
        rows = domains.domain(spark, sf_dir, name)
        writers.write_csv_drop(rows, layout.raw(name), name, "20240101")
    steps = medallion.ingest(spark, layout, TRANSFORMABLE, AS_OF)
    return medallion.run_report(spark, steps)


@register("ingest_named_drop", sql.ROW_COUNT_CUSTOMERS)
def ingest_named_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest drop whose name begins with the table's; a newer one of another name stays."""
    folder = f"{writers.scratch_root(spark)}/raw"
    customers = domains.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    writers.write_csv_drop(customers.limit(0), folder, "customer", "20240101")
    writers.write_csv_drop(customers, folder, "customer", "20240102")
    writers.write_csv_drop(customers.limit(0), folder, "client", "20240103")
    drop = readers.latest_snapshot(spark, folder, "customer")
    rows = readers.read_raw_csv(spark, drop)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c_acctbal").cast(domains.MONEY)).alias("balance")).select(
        "n", money("balance")
    )


@register("validate_layers", sql.VALIDATE_LAYERS)
def validate_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of all six tables of a lake in bronze, silver and gold."""
    layout = _bronze_lake(spark, sf_dir)
    rates = domains.fx_feed(spark, sf_dir).withColumn("as_of_date", F.to_date("as_of_timestamp"))
    writers.write_partitioned(
        rates, layout.bronze("fx_rates"), layout.partitions(SPECS["fx_rates"], "bronze"), rebalance=False
    )
    medallion.convert(spark, layout, rates=EXACT_RATES)
    medallion.stress(spark, layout)
    return medallion.validate_layers(spark, layout)


@register("validate_observed", sql.VALIDATE_OBSERVED)
def validate_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of silver and gold as a run observes them while it writes."""
    layout = _bronze_lake(spark, sf_dir)
    steps = medallion.run_pipeline(spark, layout, rates=EXACT_RATES, check=True)
    return medallion.observed_checks(spark, layout, steps)


@register("quality_gate", sql.QUALITY_GATE)
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops at the gate: one is written to bronze, one is refused with its issues."""
    layout = Layout(writers.scratch_root(spark), undated=("transactions", "loans"))
    drops = {"transactions": domains.full_transactions(spark, sf_dir), "loans": domains.raw_loans(spark, sf_dir)}
    for name, rows in drops.items():
        writers.write_csv_drop(rows, layout.raw(name), name, "20240101")
    return medallion.run_report(spark, medallion.ingest(spark, layout, drops, LOADED, gate=True))


@register("partition_column_failure", sql.PARTITION_FAILURE)
def partition_column_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without the date column of their table are not written; the row says why."""
    rows = domains.table(spark, sf_dir, "orders").select("o_orderkey", F.lit("ASIA").alias("region_code"))
    try:
        writers.write_partitioned(rows, f"{writers.scratch_root(spark)}/x", SPECS["transactions"].partitions)
        status = "written"
    except ValueError as error:
        status = "missing transaction_date" if "transaction_date" in str(error) else str(error)
    return rows.agg(F.count(F.lit(1)).alias("n")).withColumn("status", F.lit(status))


@register("combined_missing_metric", sql.combined_missing())
def combined_missing_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric that lacks a scenario counts as 0 there."""
    totals = {n: regional_totals(spark, sf_dir, n) for n in TRANSFORMABLE}
    totals["cash"] = totals["cash"].where("scenario_id <> 3")
    return agg.combine_by_union(totals).select("scenario_id", *map(money, _COMBINED))
