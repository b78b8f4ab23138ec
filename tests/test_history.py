"""As-of rates and validities against plain loops, and their plans."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stresslake.operators import history
from stresslake.plans import catalog, domains
from stresslake.plans import history as registered

DAY = dt.date(2020, 1, 1)
RATE = "decimal(12,6)"


def day(n):
    return None if n is None else DAY + dt.timedelta(days=n)


def plain_asof(rows, past):
    out = []
    for i, code, when in rows:
        known = [(t, r) for c, t, r in past if c == code and None not in (code, when, t, r) and t <= when]
        t, r = max(known) if known else (None, Decimal(1))
        out.append((i, r, t))
    return sorted(out)


def asof(spark, rows, past, bucket="month"):
    facts = spark.createDataFrame(rows, "id int, currency_code string, business_date date")
    feed = spark.createDataFrame(past, f"currency_code string, as_of_timestamp date, fx_rate_to_usd {RATE}")
    found = history.asof_rates(facts, feed, "business_date", bucket)
    return sorted(tuple(r) for r in found.select("id", "rate_to_usd", "rate_as_of").collect())


@pytest.mark.parametrize("bucket", ["week", "month", "year"])
def test_asof_equals_plain_search(spark, bucket):
    rng = random.Random(1)
    codes = ["EUR", "EUR", "EUR", "JPY", "AED", None]
    rows = [(i, rng.choice(codes), day(rng.choice([None, *range(0, 400, 3)]))) for i in range(400)]
    # One currency on one day holds a third of all rows.
    rows += [(1000 + i, "EUR", day(77)) for i in range(200)]
    past = [(rng.choice(["EUR", "JPY", None]), day(rng.choice([None, *range(40, 380, 7)])),
             rng.choice([None, Decimal(rng.randint(1, 99))])) for _ in range(150)]
    past += [("EUR", day(61), Decimal(5)), ("EUR", day(61), Decimal(7)), ("EUR", day(61), Decimal(6))]
    assert asof(spark, rows, past, bucket) == plain_asof(rows, past)


def test_asof_of_empty_tables(spark):
    past = [("EUR", day(1), Decimal(2))]
    assert asof(spark, [], past) == []
    assert asof(spark, [(1, "EUR", day(5))], []) == [(1, Decimal(1), None)]


def test_asof_search_sees_each_pair_once(spark):
    """Copies of a (currency, day) pair are folded before the first exchange."""
    rows = spark.range(5000).select(
        F.lit("EUR").alias("currency_code"), F.lit(DAY).alias("business_date")
    )
    feed = spark.createDataFrame([("EUR", DAY, 1.5)], "currency_code string, as_of_timestamp date, fx_rate_to_usd double")
    found = history.asof_lookup(rows, feed.withColumnsRenamed(
        {"as_of_timestamp": "business_date", "fx_rate_to_usd": "rate"}), "currency_code", "business_date", "rate")
    assert [tuple(r) for r in found.collect()] == [("EUR", DAY, 1.5, DAY)]


def test_missing_currency_counts_as_base(spark):
    rows = spark.createDataFrame([(1, DAY, 5.0)], "loan_id int, business_date date, loan_amount double")
    feed = spark.createDataFrame([("USD", DAY, 1.0)], "currency_code string, as_of_timestamp date, fx_rate_to_usd double")
    usd = history.convert_amounts_asof(rows, "loans", feed).first()
    assert (usd.currency_code, usd.rate_to_usd, usd.loan_amount_usd) == ("USD", 1.0, 5.0)
    with pytest.raises(ValueError, match="business_date"):
        history.convert_amounts_asof(rows.drop("business_date"), "loans", feed)


ENTRIES = "scenario_id int, market_stress_factor double, effective_date date, expiry_date date"


def valid(spark, rows, entries):
    facts = spark.createDataFrame(rows, "id int, d date, month int, e int")
    found = history.expand_valid_scenarios(facts, spark.createDataFrame(entries, ENTRIES), "d")
    assert found.columns == ["id", "d", "month", "e", "scenario_id", "market_stress_factor"]
    return sorted(tuple(r) for r in found.select("id", "month", "e", "scenario_id").collect())


def plain_valid(rows, entries):
    return sorted(
        (i, m, e, s) for i, d, m, e in rows for s, _, a, b in entries
        if d is not None and (a is None or a <= d) and (b is None or d < b)
    )


def test_validities_equal_plain_search(spark):
    rng = random.Random(2)
    rows = [(i, day(rng.choice([None, *range(200)])), i, -i) for i in range(300)] + [(999, day(31), 0, 0)] * 100
    entries = [
        (1, 1.0, None, None), (2, 1.1, day(31), day(60)), (3, 1.2, day(59), None), (4, 1.3, None, day(31)),
        (5, 1.4, day(100), day(101)), (6, 1.5, day(90), day(80)), (2, 1.6, day(40), day(41)), (7, 1.7, day(5), day(5)),
    ]
    assert valid(spark, rows, entries) == plain_valid(rows, entries)
    assert valid(spark, [], entries) == [] and valid(spark, rows, []) == []


def test_clashing_columns_are_named(spark):
    facts = spark.createDataFrame([(1, DAY)], "scenario_id int, d date")
    with pytest.raises(ValueError, match="scenario_id"):
        history.expand_valid_scenarios(facts, spark.createDataFrame([], ENTRIES), "d")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_validity_join_has_no_nested_loop(spark, sf_dir):
    plan = plan_of(registered.scenario_valid_loans(spark, sf_dir))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("threshold", ["10485760", "102400"])
@pytest.mark.parametrize("name", ["fx_convert_loans", "fx_convert_transactions", "scenario_expand_loans"])
def test_facts_are_neither_broadcast_nor_exchanged(spark, name, threshold):
    """On data where the facts exceed each dimension by far."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = plan_of(catalog.QUERIES[name](spark, "/root/testdata/sf0.1"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and ("l_extendedprice" in line or "o_totalprice" in line))
    indent = lines[at].index("FileScan")
    above = []
    for line in reversed(lines[:at]):
        start = len(line) - len(line.lstrip(" :+-"))
        if start < indent:
            above.append(line.strip(" :+-"))
            indent = start
    assert not [line for line in above if "Exchange" in line.split(" ")[0]], above
    assert len([line for line in above if line.startswith("BroadcastHashJoin")]) >= 3


def test_star_order_keeps_unknown_places_out(spark, sf_dir):
    rows = domains.domain(spark, sf_dir, "loans")
    assert rows.where("region_code IS NULL").count() == 0
    assert set(rows.columns) >= {"region_code", "currency_code", "branch_id"}
