from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stresslake.operators import aggregates as agg
from stresslake.operators import fx, kpi, scenario
from stresslake.plans import catalog, domains
from stresslake.specs import SCENARIOS, TRANSFORMABLE


def test_levels_include_their_thresholds(spark):
    df = spark.createDataFrame([(1.19,), (1.2,), (1.49,), (1.5,), (None,)], "market_stress_factor double")
    got = [r["stress_level"] for r in scenario.add_stress(df, "loans").collect()]
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "LOW"]
    with pytest.raises(ValueError, match="market_stress_factor"):
        scenario.add_stress(df.drop("market_stress_factor").withColumn("a", F.lit(1)), "loans")


def test_stressed_column_needs_its_source(spark):
    df = spark.createDataFrame([(2.0, 1.5)], "outstanding_balance_usd double, market_stress_factor double")
    assert scenario.add_stress(df, "loans").first()["stressed_exposure"] == 3.0
    assert "stressed_liquidity" not in scenario.add_stress(df, "cash").columns


def test_scenario_limit_is_ordered(spark):
    table = spark.createDataFrame(
        [(i, float(i)) for i in (9, 3, 7, 1, 5, 2)], "scenario_id int, market_stress_factor double"
    )
    one = spark.range(1).select(F.lit("x").alias("k"))
    ids = lambda df: sorted(r["scenario_id"] for r in df.collect())
    assert ids(scenario.expand_scenarios(one, table)) == [1, 2, 3, 5, 7, 9]
    assert ids(scenario.expand_scenarios(one, table, 4)) == [1, 2, 3, 5]
    assert ids(scenario.expand_scenarios(one, scenario.DEFAULT_SET, 2)) == [1, 2]
    assert len(scenario.scenario_table(spark).collect()) == len(SCENARIOS)


def test_expansion_has_no_join_and_no_exchange(spark, sf_dir):
    rows = domains.loan_rows(spark, sf_dir)
    out = scenario.expand_scenarios(rows, scenario.DECIMAL_SET)
    assert out.count() == rows.count() * 5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert scenario.expand_scenarios(rows, ([], "double")).count() == 0


def test_many_scenarios_all_count(spark):
    table = spark.range(1500).select(
        F.col("id").cast("int").alias("scenario_id"), F.lit(1.0).alias("market_stress_factor")
    )
    assert scenario.expand_scenarios(spark.range(3), table).count() == 4500


def test_active_scenarios(spark):
    table = scenario.scenario_table(spark)
    assert scenario.active_scenarios(table, "2026-06-10").count() == 5
    assert scenario.active_scenarios(table, "2026-06-09").count() == 0
    assert scenario.active_scenarios(table, "2099-12-31").count() == 0


@pytest.mark.parametrize("name", TRANSFORMABLE)
def test_totals_are_linear_and_both_plans_agree(spark, sf_dir, name):
    factors = {row[0]: Decimal(row[-1]) for row in SCENARIOS}
    full = {tuple(r)[:2]: r[2] for r in agg.by_scenario_region(catalog.gold(spark, sf_dir, name), name).collect()}
    early = {tuple(r)[:2]: r[2] for r in catalog.regional_totals(spark, sf_dir, name).collect()}
    assert full == early and full
    for (number, region), value in full.items():
        assert value == full[(1, region)] * factors[number]


def test_stress_totals_on_doubles(spark):
    df = spark.createDataFrame(
        [("E", "EUR", 1.0), ("E", "USD", 2.0), ("A", None, 4.0)],
        "region_code string, currency_code string, available_liquidity double",
    )
    out = agg.stress_totals(df, "cash", {"EUR": 10.0}, ([(1, 1.0), (2, 2.0)], "double"), with_count=True)
    assert sorted(map(tuple, out.collect())) == [
        (1, "A", 4.0, 1), (1, "E", 12.0, 2), (2, "A", 8.0, 1), (2, "E", 24.0, 2)
    ]


def test_combining_fills_metrics_but_not_keys(spark):
    txn = spark.createDataFrame([(1, 5.0), (None, 7.0)], "scenario_id int, txn_total double")
    liq = spark.createDataFrame([(1, 1.0), (2, 2.0)], "scenario_id int, liq_total double")
    got = {tuple(r) for r in agg.combine({"transactions": txn, "cash": liq}).collect()}
    assert got == {(1, 5.0, 1.0), (2, 0.0, 2.0), (None, 7.0, 0.0)}
    zero = agg.combine({"transactions": txn, "cash": liq}, fill_key=True)
    assert (0, 7.0, 0.0) in {tuple(r) for r in zero.collect()}
    union = agg.combine_by_union({"transactions": txn, "cash": liq})
    assert {tuple(r) for r in union.collect()} == got


def test_impact_is_null_without_a_base(spark):
    combined = spark.createDataFrame([(1, 0.0, 10.0), (2, 5.0, 15.0)], "scenario_id int, a double, b double")
    got = {(r["scenario_id"], r["metric"]): r["impact_pct"] for r in kpi.stress_impact(combined).collect()}
    assert got[(2, "a")] is None and got[(2, "b")] == pytest.approx(50.0)


def test_expanded_conversion_keeps_every_row_with_a_dominant_currency(spark):
    """A third of the rows in one currency, and a hot customer."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "EUR").otherwise(F.col("id").cast("string")).alias("currency_code"),
        F.lit("E").alias("region_code"), F.lit(1.0).alias("transaction_amount"),
    )
    usd = fx.convert_amounts(rows, "transactions", {"EUR": 2.0})
    assert usd.count() == 3000
    assert usd.agg(F.sum("transaction_amount_usd")).first()[0] == 4000.0
