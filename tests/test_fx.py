from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stresslake.operators import fx


def rows(df):
    return {r["currency_code"]: r["rate_to_usd"] for r in df.collect()}


@pytest.fixture
def cash(spark):
    return spark.createDataFrame(
        [("a", "EUR", 100.0, 10.0), ("b", "eur", 100.0, 10.0), ("c", None, 100.0, 10.0),
         ("d", "XXX", 100.0, None)],
        "id string, currency_code string, closing_balance double, available_liquidity double",
    )


def test_unknown_null_and_lower_case_codes_keep_the_amount(cash):
    out = {r["id"]: r for r in fx.convert_amounts(cash, "cash", {"EUR": 1.09}).collect()}
    assert out["a"]["closing_balance_usd"] == pytest.approx(109.0)
    for key in "bcd":
        assert out[key]["rate_to_usd"] == 1.0 and out[key]["closing_balance_usd"] == 100.0
    assert out["d"]["available_liquidity_usd"] is None


def test_join_key_moves_to_the_front_and_missing_column_is_usd(cash):
    out = fx.convert_amounts(cash.drop("currency_code"), "cash", {"USD": 1.0})
    assert out.columns[0] == "currency_code"
    assert {r["currency_code"] for r in out.collect()} == {"USD"}


def test_null_rate_counts_as_one(cash):
    out = fx.convert_amounts(cash, "cash", {"EUR": None})
    assert {r["rate_to_usd"] for r in out.collect()} == {1.0}


def test_decimals_stay_exact(spark):
    df = spark.createDataFrame([("EUR", Decimal("0.10"))], "currency_code string, transaction_amount decimal(18,2)")
    out = fx.convert_amounts(df, "transactions", {"EUR": Decimal("1.09")})
    assert out.first()["transaction_amount_usd"] == Decimal("0.1090")


def test_repeated_codes_are_refused(spark, cash):
    twice = spark.createDataFrame([("EUR", 1.0), ("EUR", 2.0)], "currency_code string, rate_to_usd double")
    with pytest.raises(Exception, match="more than once"):
        fx.convert_amounts(cash, "cash", twice).collect()


def test_rate_tables_of_any_size_take_one_path(spark, cash):
    table = spark.createDataFrame(
        [("EUR", Decimal("2.00000001")), ("AAA", None), ("BBB", Decimal(4))],
        "currency_code string, rate_to_usd decimal(18,8)",
    )
    out = fx.convert_amounts(cash, "cash", table)
    assert out.schema["rate_to_usd"].dataType.simpleString() == "decimal(18,8)"
    found = {r["id"]: r["closing_balance_usd"] for r in out.collect()}
    assert found == pytest.approx({"a": 200.000001, "b": 100.0, "c": 100.0, "d": 100.0})
    nothing = fx.convert_amounts(cash, "cash", table.where("rate_to_usd IS NULL"))
    assert nothing.schema["rate_to_usd"].dataType.simpleString() == "decimal(18,8)"


def test_nan_is_no_rate(spark, cash):
    bad = {"EUR": float("nan"), "XXX": float("inf")}
    assert {r["rate_to_usd"] for r in fx.convert_amounts(cash, "cash", bad).collect()} == {1.0}
    table = spark.createDataFrame([("EUR", float("nan"))], "currency_code string, rate_to_usd double")
    assert {r["rate_to_usd"] for r in fx.convert_amounts(cash, "cash", table).collect()} == {1.0}
    static = fx.rates_frame(spark, {"EUR": 1.09})
    assert rows(fx.resolve_rates(table, static)) == {"EUR": 1.09}
    assert rows(fx.resolve_rates(table, static, "per_currency")) == {"EUR": 1.09, "USD": 1.0}


def test_live_rates_keep_their_digits_and_broken_ones_are_refused(spark):
    static = fx.rates_frame(spark, {"USD": Decimal(1), "IDR": Decimal("0.00006")})
    schema = "currency_code string, rate_to_usd decimal(18,10)"
    live = spark.createDataFrame([("idr", Decimal("0.0000237000"))], schema)
    assert rows(fx.resolve_rates(live, static))["IDR"] == Decimal("0.0000237")
    broken = spark.createDataFrame([("idr", None), ("eur", Decimal(1))], schema)
    assert rows(fx.resolve_rates(broken, static)) == rows(static)
    assert set(rows(fx.resolve_rates(broken, static, "per_currency"))) == {"IDR", "EUR", "USD"}
    clash = spark.createDataFrame([("eur", Decimal(1)), ("EUR", Decimal(2))], schema)
    with pytest.raises(Exception, match="live rates differ"):
        fx.resolve_rates(clash, static).collect()


def test_building_runs_no_job(spark, sf_dir):
    from stresslake.plans import catalog

    layered = {"ingest_latest_snapshot", "ingest_all_tables", "ingest_named_drop", "layer_roundtrip", "report_export", "run_report",
               "validate_layers", "quality_gate",
               # Runs that write tables too.
               "validate_observed", "stream_gated_bronze", "kpi_stored_slice"}
    for name, query in catalog.QUERIES.items():
        if name in layered:
            continue
        # Reading the footer of a Parquet file is a job of its own; it comes first.
        spark.sparkContext.setJobGroup(f"build {name}", name)
        query(spark, sf_dir)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {name}")
        for job in jobs:
            stages = spark.sparkContext.statusTracker().getJobInfo(job).stageIds
            names = {spark.sparkContext.statusTracker().getStageInfo(s).name for s in stages}
            assert all(n.startswith("parquet") for n in names), (name, names)
    spark.sparkContext.setJobGroup("tests", "tests")


def test_resolution_modes(spark):
    static = fx.rates_frame(spark, {"USD": 1.0, "EUR": 1.09, "GBP": 1.27})
    live = fx.rates_frame(spark, {"eur": 1.2, "usd": 7.0})
    assert rows(fx.resolve_rates(live, static)) == {"EUR": 1.2, "USD": 1.0}
    assert rows(fx.resolve_rates(live, static, "per_currency")) == {"EUR": 1.2, "USD": 1.0, "GBP": 1.27}
    assert rows(fx.resolve_rates(None, static)) == rows(static)
    assert rows(fx.resolve_rates(live, static, source="fallback")) == rows(static)
    with pytest.raises(ValueError):
        fx.resolve_rates(live, static, "sometimes")


def test_inverted_feed(spark):
    static = fx.rates_frame(spark, {"USD": 1.0, "JPY": 0.0068})
    live = fx.rates_frame(spark, {"JPY": 160.0, "ABC": 0.0})
    out = rows(fx.resolve_rates(live, static, direction="base_to_quote"))
    # A rate of 0 cannot be inverted, which spoils the whole answer.
    assert out == rows(static)
    out = rows(fx.resolve_rates(live, static, "per_currency", direction="base_to_quote"))
    assert out["JPY"] == pytest.approx(0.00625) and "ABC" not in out


def test_convert_to_base_accepts_any_case(spark):
    df = spark.createDataFrame([("eur",), ("EUR",), (None,), ("zzz",)], "c string")
    got = [r[0] for r in df.select(fx.convert_to_base(F.lit(10.0), F.col("c"))).collect()]
    assert got == pytest.approx([10.9, 10.9, 10.0, 10.0])


def test_silver_drops_copies_and_needs_a_measure(spark):
    df = spark.createDataFrame(
        [("T1", "EUR", 10.0, "E", "2024-01-01")] * 2,
        "`Transaction Id` string, currency_code string, transaction_amount double,"
        " region_code string, transaction_date string",
    )
    out = fx.to_silver(df, "transactions", {"EUR": 2.0})
    assert out.count() == 1 and out.first()["transaction_amount_usd"] == 20.0
    assert out.schema["transaction_date"].dataType.typeName() == "date"
    with pytest.raises(ValueError, match="no silver"):
        fx.to_silver(df, "scenario", {})


def test_latest_rate_per_currency(spark):
    feed = spark.createDataFrame(
        [("EUR", 1.0, "2024-01-01"), ("EUR", 1.5, "2024-02-01"), ("JPY", 0.1, "2023-01-01")],
        "currency_code string, fx_rate_to_usd double, as_of_timestamp string",
    ).withColumn("as_of_timestamp", F.to_timestamp("as_of_timestamp"))
    assert rows(fx.latest_rates(feed)) == {"EUR": 1.5, "JPY": 0.1}
    early = fx.latest_rates(feed, F.lit("2024-01-15").cast("timestamp"))
    assert rows(early) == {"EUR": 1.0, "JPY": 0.1}
