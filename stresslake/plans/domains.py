"""The star-schema test tables seen as banking domains.

orders are transactions, lineitem rows are loan tranches, customers hold cash
positions and events are intraday movements. A region's currency follows from its
name; AFRICA's is not in the rate table, so it takes the "no rate" path.

Lookups are plain joins in star order: the facts meet one dimension after the other, each
a scan of its own. Spark knows the size of a scan but multiplies those of a join, so a
chain of dimensions joined first would seem larger than the facts. Nothing is hinted;
dimensions beyond the broadcast threshold are joined by shuffling, split where skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.specs import SPECS

MONEY = "decimal(18,2)"
CASH_DAY = "2024-01-31"
# Currency by region name.
REGION_CURRENCY = {"AMERICA": "USD", "EUROPE": "EUR", "ASIA": "JPY", "MIDDLE EAST": "AED"}
OTHER_CURRENCY = "ZAR"
INFLOW_TYPES = ("purchase", "signup")
OUTFLOW_TYPES = ("error", "click")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def currency_of(region: Column) -> Column:
    known = [F.when(region == name, code) for name, code in REGION_CURRENCY.items()]
    return F.coalesce(*known, F.lit(OTHER_CURRENCY))


def with_place(df: DataFrame, sf_dir: str, nation: str) -> DataFrame:
    """Rows of known nations with region and currency instead of the nation key."""
    spark = df.sparkSession
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    regions = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region_code"))
    placed = (
        df.join(nations, F.col(nation) == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .drop(nation, "n_nationkey", "n_regionkey", "r_regionkey")
    )
    return placed.withColumn("currency_code", currency_of(F.col("region_code")))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer keys with their place."""
    return with_place(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), sf_dir, "c_nationkey")


def located(df: DataFrame, sf_dir: str, key: str, owner: str, owner_key: str, nation: str) -> DataFrame:
    """Rows whose ``key`` names a customer or supplier, with its region and currency."""
    owners = table(df.sparkSession, sf_dir, owner).select(owner_key, nation)
    return with_place(df.join(owners, F.col(key) == F.col(owner_key)).drop(owner_key), sf_dir, nation)


def transaction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.col("o_orderpriority").alias("transaction_type"),
        F.col("o_totalprice").cast(MONEY).alias("transaction_amount"),
    )


def loan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("l_extendedprice").cast(MONEY)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("loan_id"),
        F.col("l_linenumber").alias("tranche"),
        F.col("l_suppkey").alias("branch_id"),
        F.col("l_shipdate").cast("date").alias("business_date"),
        amount.alias("loan_amount"),
        (amount * (1 - F.col("l_discount").cast("decimal(4,2)")))
        .cast("decimal(18,4)").alias("outstanding_balance"),
        (F.col("l_tax") * 100).alias("interest_rate"),
    )


def cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    closing = F.col("c_acctbal").cast(MONEY)
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cash_position_id"),
        "c_nationkey",
        F.lit(CASH_DAY).cast("date").alias("business_date"),
        closing.alias("closing_balance"),
        (closing * F.lit("0.90").cast("decimal(4,2)"))
        .cast("decimal(18,4)").alias("available_liquidity"),
    )
    return with_place(rows, sf_dir, "c_nationkey")


def _movement(types: tuple[str, ...]) -> Column:
    zero = F.lit(0).cast(MONEY)
    return F.when(F.col("event_type").isin(*types), F.col("value").cast(MONEY)).otherwise(zero)


def intraday_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .select(
            F.col("event_id").alias("intraday_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").alias("as_of_timestamp"),
            F.col("ts").cast("date").alias("as_of_timestamp_date"),
            _movement(INFLOW_TYPES).alias("inflow_amount"),
            _movement(OUTFLOW_TYPES).alias("outflow_amount"),
        )
        .withColumn(
            "net_position", (F.col("inflow_amount") - F.col("outflow_amount")).cast(MONEY)
        )
    )


# Rows without a place, and the way to one: key column, table, its key and its nation.
_PLACED = {
    "transactions": (transaction_rows, ("customer_id", "customer", "c_custkey", "c_nationkey")),
    "loans": (loan_rows, ("branch_id", "supplier", "s_suppkey", "s_nationkey")),
    "intraday": (intraday_rows, ("customer_id", "customer", "c_custkey", "c_nationkey")),
}


def domain(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """All rows of a domain with region and currency."""
    if name == "cash":
        return cash(spark, sf_dir)
    rows, place = _PLACED[name]
    return located(rows(spark, sf_dir), sf_dir, *place)


def regional_sums(
    spark: SparkSession, sf_dir: str, name: str, by: tuple[str, ...] = ()
) -> DataFrame:
    """Raw amount and row count per region, currency and the columns in ``by``.

    Rows are summed per join key before the key is looked up. A key that holds a
    large part of the table is folded on the map side, and the join then sees it
    once.
    """
    amount = F.col(SPECS[name].measure.source.removesuffix("_usd"))
    sums = [F.sum(amount).alias("_sum"), F.count(F.lit(1)).alias("_rows")]
    if name == "cash":
        return cash(spark, sf_dir).groupBy("region_code", "currency_code", *by).agg(*sums)
    rows, place = _PLACED[name]
    per_key = rows(spark, sf_dir).groupBy(place[0], *by).agg(*sums)
    return (
        located(per_key, sf_dir, *place)
        .groupBy("region_code", "currency_code", *by)
        .agg(F.sum("_sum").alias("_sum"), F.sum("_rows").alias("_rows"))
    )


# Reference level of the derived rate feed, USD per unit.
FEED_LEVEL = {"USD": "1.0", "EUR": "1.09", "JPY": "0.0068", "AED": "0.2723", "ZAR": "0.0535"}


def fx_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate history: each order is one observation of its customer's currency.

    The rate moves up to 5 % around its level, driven by the order key.
    """
    level = F.coalesce(*[
        F.when(F.col("currency_code") == code, F.lit(rate).cast("decimal(12,6)"))
        for code, rate in FEED_LEVEL.items()
    ])
    move = (F.col("o_orderkey") % 101 + 950).cast("decimal(6,0)")
    rate = level * move * F.lit("0.001").cast("decimal(4,3)")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        located(orders, sf_dir, "o_custkey", "customer", "c_custkey", "c_nationkey")
        .select(
            F.col("o_orderkey").alias("fx_rate_id"),
            "currency_code",
            "region_code",
            rate.cast("decimal(12,6)").alias("fx_rate_to_usd"),
            F.col("o_orderdate").alias("as_of_timestamp"),
        )
    )


def fx_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as it is published: an observation comes out 3 to 47 days after its order."""
    late = (F.lit(3) + F.pmod(F.col("fx_rate_id"), F.lit(45))).cast("int")
    published = F.date_add(F.to_date("as_of_timestamp"), late)
    return fx_feed(spark, sf_dir).withColumn("as_of_timestamp", published)


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans as an unchecked text drop: bad dates and amounts, gaps, an extra column."""
    number = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("loan_id"),
        number.cast("string").alias("tranche"),
        F.concat(F.lit(" BR_"), F.col("l_suppkey").cast("string")).alias("branch_id"),
        F.when(number == 7, "31/12/2024")
        .otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("loan_start_date"),
        F.when(number == 6, "12,5").when(number == 5, None)
        .otherwise(F.col("l_extendedprice").cast(MONEY).cast("string")).alias("loan_amount"),
        (F.col("l_extendedprice").cast(MONEY) - F.col("l_quantity").cast(MONEY) + 20)
        .cast("string").alias("outstanding_balance"),
        F.lit(None).cast("string").alias("interest_rate"),
        F.col("l_shipdate").cast("date").cast("string").alias("start_date"),
        F.col("l_returnflag").alias("loan_type"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as an unchecked text drop; every row of one priority is sent twice."""
    amount = F.col("o_totalprice").cast(MONEY)
    once = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("transaction_date"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("transaction_type"),
        F.when(F.col("o_orderstatus") == "P", -amount).otherwise(amount)
        .cast("string").alias("transaction_amount"),
    )
    again = once.where(F.col("transaction_type") == "1-URGENT")
    return once.unionByName(again)


def full_transactions(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """Transactions as a drop that lacks nothing: every column of the registry, clean.

    With ``only`` those of its ``transaction_id`` (order keys), joined while rows are narrow.
    """
    rows, place = _PLACED["transactions"]
    rows = rows(spark, sf_dir)
    rows = located(rows if only is None else rows.join(only, "transaction_id"), sf_dir, *place)
    day = F.col("transaction_date").cast("string")
    customer = F.col("customer_id").cast("string")
    return rows.select(
        F.concat(F.lit("T"), F.col("transaction_id").cast("string")).alias("transaction_id"),
        F.concat(F.lit("A"), customer).alias("account_id"), F.concat(F.lit("C"), customer).alias("customer_id"),
        F.concat(F.lit("BR_"), F.col("region_code")).alias("branch_id"), day.alias("transaction_date"),
        "transaction_type", F.col("transaction_amount").cast("string").alias("transaction_amount"),
        "currency_code", "region_code", F.concat(F.lit("L"), customer).alias("loan_id"),
        day.alias("start_date"), day.alias("end_date"), F.lit("Base").alias("baseline"),
        F.when(F.col("transaction_amount") < 100000, "small").otherwise("large").alias("amount_bucket"),
    )
