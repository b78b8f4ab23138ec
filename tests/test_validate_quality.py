import pytest
from pyspark.sql import functions as F

from stresslake.functions.columns import FRACTION, MIDNIGHT, TIMED, WHOLE, WORDS, text_kind
from stresslake.operators import quality, validate


def checks(df):
    return {r["check_name"]: (r["value"], r["status"]) for r in df.collect()}


def test_bronze(spark):
    df = spark.createDataFrame([], "loan_id string, customer_id string")
    assert checks(validate.validate_bronze(df, "loans")) == {
        "row_count": (0, "FAIL"), "missing_columns": (1, "FAIL")}


def test_silver_nulls_and_keys(spark):
    df = spark.createDataFrame(
        [("T1", None), ("T1", "x"), (None, "x"), (None, "x")], "transaction_id string, kind string")
    got = checks(validate.validate_silver(df, "transactions"))
    assert got["nulls:transaction_id"] == (2, "WARN") and got["nulls:kind"] == (1, "WARN")
    assert got["null_columns"] == (2, "WARN")
    assert got["duplicate_keys"] == (2, "WARN")
    rates = spark.createDataFrame([("F1", 0.0), ("F2", 1.0)], "fx_rate_id string, fx_rate_to_usd double")
    got = checks(validate.validate_silver(rates, "fx_rates"))
    assert got["non_positive_rate"] == (1, "FAIL") and got["duplicate_keys"] == (0, "PASS")


def test_gold_rules(spark):
    df = spark.createDataFrame(
        [(1.0, -5.0), (0.0, 5.0), (1.1, None)], "market_stress_factor double, stressed_liquidity double")
    got = checks(validate.validate(df, "gold", "cash"))
    assert got["non_positive_factor"] == (1, "FAIL") and got["negative_liquidity"] == (1, "WARN")
    with pytest.raises(ValueError):
        validate.validate(df, "platinum", "cash")


def test_surplus_rows_count_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a")], "k int, v string")
    assert tuple(quality.surplus_rows(df).first()) == (4, 2)
    assert tuple(quality.surplus_rows(df, "k").first()) == (4, 2)
    assert tuple(quality.surplus_rows(df.limit(0)).first()) == (0, 0)


def test_key_is_skipped_if_absent(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    row = quality.duplicate_metrics(df, "loans").first()
    assert (row["duplicate_rows"], row["duplicate_pct"], row["pk_duplicate_count"]) == (1, 50.0, 0)


@pytest.mark.parametrize("text, kind", [
    (["1", "22"], "int"), (["1", None], "float"), (["1.0", "2"], "float"), (["1e3", "-.5"], "float"),
    (["2024-01-01", "2024-02-01"], "date"), (["2024-01-01", "2024-01-01 10:00:00"], "datetime"),
    (["2024-01-01T00:00:00"], "date"), ([None, None], "float"), (["a", "1"], "string"),
    (["2024-01-01", "5"], "string"), (["5d"], "string"), (["inf", "1"], "float"), (["", "x"], "string"),
])
def test_semantic_type_of_text(spark, text, kind):
    df = spark.createDataFrame([(t,) for t in text], "c string")
    assert quality.semantic_types(df).first()["semantic_type"] == kind


def test_semantic_type_of_typed_and_empty(spark):
    df = spark.sql("SELECT 1 AS i, 1.5D AS d, DATE'2024-01-01' AS a, TIMESTAMP'2024-01-01 00:00:00' AS t, true AS b")
    got = dict(map(tuple, quality.semantic_types(df).collect()))
    assert got == {"i": "int", "d": "float", "a": "date", "t": "datetime", "b": "string"}
    empty = dict(map(tuple, quality.semantic_types(df.limit(0)).collect()))
    assert empty["a"] == "unknown" and empty["b"] == "float" and empty["i"] == "int"


def test_format_validity_skips_empty_columns(spark):
    df = spark.createDataFrame(
        [("x", None, "2024-13-01"), ("1", None, "2024-12-01")],
        "loan_amount string, interest_rate string, start_date string")
    got = {r["column_name"]: (r["check_name"], r["invalid_count"]) for r in quality.format_validity(df, "loans").collect()}
    assert got == {"loan_amount": ("Invalid numeric values", 1), "start_date": ("Invalid date format", 1)}


def test_rules_ignore_nulls_and_unreadable_values(spark):
    df = spark.createDataFrame([("5", "4"), (None, "4"), ("x", "4"), ("3", "4")],
                               "outstanding_balance string, loan_amount string")
    assert tuple(quality.business_rule_checks(df, "loans").first())[1:] == (1, "FAIL")
    net = spark.createDataFrame([("10.10", "3.05", "7.05"), ("10.10", "3.05", "7.06"), (None, "1", "1")],
                                "inflow_amount string, outflow_amount string, net_position string")
    assert quality.business_rule_checks(net, "intraday").first()["violations"] == 1
    day = spark.createDataFrame([("1", "2024-01-02"), ("-1", "2024-01-01")], "transaction_amount string, transaction_date string")
    assert [r["violations"] for r in quality.business_rule_checks(day, "transactions", "2024-01-01").collect()] == [1, 1]
    assert quality.business_rule_checks(df, "scenario").count() == 0


def test_record_count_tolerance(spark):
    df = spark.range(95)
    status = {n: quality.record_count_check(df, n).first()["status"] for n in (None, 100, 101, 90, 89)}
    assert status == {None: "PASS", 100: "PASS", 101: "FAIL", 90: "PASS", 89: "FAIL"}


@pytest.mark.parametrize("parts, grade", [
    ((95.0, 5.0, 0, 0, 100), "GOOD"), ((94.9, 5.1, 6, 0, 100), "NEEDS ATTENTION"),
    ((85.0, 15.0, 15, 0, 100), "NEEDS ATTENTION"), ((84.0, 15.0, 15, 2, 100), "POOR"), ((100.0, 0.0, 0, 0, 0), "GOOD"),
])
def test_grades(spark, parts, grade):
    score = quality.quality_score(*map(F.lit, parts))
    row = spark.range(1).select(*[c.alias(n) for n, c in score.items()]).first()
    assert row["grade"] == grade


def test_statistics_skip_empty_columns_and_break_ties(spark):
    df = spark.createDataFrame([(None, 1, "b", 2.5), (None, 3, "a", 2.5)], "e string, i int, s string, d double")
    got = {r["column_name"]: r for r in quality.column_statistics(df, 3).collect()}
    assert list(got) == ["i", "s", "d"]
    assert (got["i"]["min_value"], got["i"]["max_value"], got["i"]["mean_value"], got["i"]["distinct_count"]) == (1.0, 3.0, 2.0, 2)
    assert (got["s"]["top_value"], got["s"]["top_pct"]) == ("a", 50.0)
    assert got["d"]["distinct_count"] == 1


def test_statistics_cover_all_columns_and_count_values(spark):
    df = spark.createDataFrame([("1", None, 5), ("1.0", None, 6), ("01", None, 6), ("2", None, None)],
                               "t string, e string, n int")
    got = {r["column_name"]: r for r in quality.column_statistics(df).collect()}
    assert list(got) == ["t", "n"] and [r["position"] for r in got.values()] == [0, 1]
    assert (got["t"]["kind"], got["t"]["distinct_count"], got["t"]["mean_value"]) == ("numeric", 2, 1.25)
    assert got["n"]["distinct_count"] == 2
    assert quality.column_statistics(df.limit(0)).count() == 0
    assert quality.column_statistics(df.select("e")).count() == 0


def test_mean_of_wide_decimals(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(38,0)) AS w FROM VALUES ('1000000000000000000000000'), ('3000000000000000000000000') AS t(v)")
    assert quality.column_statistics(df).first()["mean_value"] == pytest.approx(2e24)


def test_report_of_a_clean_and_an_empty_table(spark):
    from stresslake.operators.scenario import scenario_table
    report = quality.quality_report(scenario_table(spark), "scenario", expected_rows=5).first()
    assert report["passed_checks"] == 9 and report["final_score"] == 100.0
    assert report["recommendation"] == quality.PROCEED and report["major_issues"] == quality.NO_ISSUES
    empty = quality.quality_report(scenario_table(spark).limit(0), "scenario").first()
    assert empty["completeness"] == 100.0 and empty["total_rows"] == 0


# --- digests and sketches -----------------------------------------------------------


def test_digests_tell_nulls_apart(spark):
    rows = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None)] * 2, "x string, y string")
    assert tuple(quality.surplus_rows(rows).first()) == (8, 4)
    assert tuple(quality.surplus_rows(rows.limit(0)).first()) == (0, 0)


def test_equal_digests_are_compared(spark, monkeypatch):
    """With digests that clash for all rows only real copies count."""
    monkeypatch.setattr(quality, "_digest", lambda columns, names: [F.lit(1).alias(n) for n in names])
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None)], "loan_id int, y string")
    assert tuple(quality.surplus_rows(rows).first()) == (4, 1)
    found = quality.duplicate_metrics(rows, "loans").first()
    assert (found.total_rows, found.duplicate_rows, found.pk_duplicate_count) == (4, 1, 2)


def test_one_row_copied_many_times(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, F.col("id")).otherwise(-1).alias("loan_id"))
    found = quality.duplicate_metrics(rows, "loans").first()
    assert (found.total_rows, found.duplicate_rows, found.pk_duplicate_count) == (3000, 1999, 1999)


def _exchanged(df):
    """Columns of each exchange of a plan."""
    plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    parts = plan.split("\n\n")
    return [p for p in parts if ") Exchange" in p or ") BroadcastExchange" in p]


def test_statistics_do_not_exchange_texts(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("near_unique"), F.md5(F.col("id").cast("string")).alias("t"))
    for exchange in _exchanged(quality.column_statistics(rows)):
        inputs = exchange.split("Input")[1].split("]")[0]
        assert " v#" not in inputs and "[v#" not in inputs, exchange


def test_sketched_distinct_counts(spark):
    rows = spark.range(20000).select("id", (F.col("id") % 700).cast("double").alias("x"),
                                     F.concat(F.lit("k"), F.col("id") % 9).alias("s"))
    exact = {r.column_name: r for r in quality.column_statistics(rows).collect()}
    near = {r.column_name: r for r in quality.column_statistics(rows, distinct="sketch").collect()}
    assert exact["id"].distinct_count == 20000 and exact["x"].distinct_count == 700
    for name in ("id", "x"):
        assert abs(near[name].distinct_count - exact[name].distinct_count) < 0.1 * exact[name].distinct_count
        assert near[name][:6] == exact[name][:6]
    assert near["s"] == exact["s"] and exact["s"].top_value == "k0"
    with pytest.raises(ValueError, match="distinct"):
        quality.column_statistics(rows, distinct="guess")


def test_top_value_ties_and_spellings(spark):
    rows = spark.createDataFrame(
        [("b", "1", None), ("a", "01", None), ("b", "1.0", None), ("a", "2", None), (None, None, None)],
        "s string, n string, gone string")
    found = {r.column_name: r for r in quality.column_statistics(rows).collect()}
    assert set(found) == {"s", "n"}
    assert (found["s"].top_value, found["s"].top_pct, found["s"].distinct_count) == ("a", 50.0, 2)
    assert (found["n"].kind, found["n"].distinct_count, found["n"].mean_value) == ("numeric", 2, 1.25)


# --- cost of the profile ------------------------------------------------------------


def test_profile_counts_rows_and_keys_in_one_chain(spark):
    """Row digests are exchanged once; copies of rows and of keys come out of it."""
    rows = spark.createDataFrame(
        [("1", "a"), ("1", "a"), ("1", "b"), ("2", None), (None, "c"), (None, "d")], "loan_id string, loan_type string")
    report = quality.quality_report(rows, "loans")
    assert len([e for e in _exchanged(report) if "_1#" in e]) == 1
    found = report.first()
    assert (found.total_rows, found.duplicate_rows, found.pk_duplicate_count) == (6, 1, 3)
    assert found.overall_nulls == 3 and found.major_issues.startswith("loan_id has nulls; duplicate loan_id found")


@pytest.mark.parametrize("text, kind", [
    ("2024-01-01", MIDNIGHT), (" 2024-01-01 ", MIDNIGHT), ("2024-13-45", WORDS), ("abcd-ef-gh", WORDS),
    ("1.2345e-10", FRACTION), ("1234567890", WHOLE), ("10000-1-01", MIDNIGHT), ("2024-1-1", MIDNIGHT),
    ("2024-01-01 00:00:00", MIDNIGHT), ("2024-01-01 00:00:01", TIMED), ("2024-01-01T10:00", TIMED),
    ("31/12/2024", WORDS), ("", WORDS), (None, None),
])
def test_kind_of_text(spark, text, kind):
    row = spark.createDataFrame([(text,)], "v string").select(text_kind(F.col("v")).alias("k"), F.col("v"))
    assert row.first().k == kind
