import datetime as dt

import pytest

from stresslake.operators import cleaning


def values(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_defaults_apply_to_missing_columns_only(spark):
    df = spark.createDataFrame([(1, None)], "id int, region_code string")
    assert values(cleaning.default_column(df, "region_code", "UNKNOWN"), "region_code") == [(None,)]
    assert values(cleaning.default_column(df, "other", "x"), "other") == [("x",)]


def test_bad_number_becomes_default_under_ansi(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,), ("5d",), (" 7 ",)], "v string")
    out = cleaning.ensure_numeric(df, "v", 0.0)
    assert values(out, "v") == [(0.0,), (0.0,), (0.0,), (1.5,), (7.0,)]
    assert values(cleaning.ensure_numeric(df, "w", 2.0), "w") == [(2.0,)] * 5


def test_ensure_string_and_date(spark):
    df = spark.createDataFrame([("2024-01-02",), ("2024-01-02T03:04:05",), ("5",), ("x-y",)], "d string")
    days = values(cleaning.ensure_date(df, "d"), "d")
    assert days.count((dt.date(2024, 1, 2),)) == 2 and days.count((None,)) == 2
    fixed = cleaning.ensure_date(df, "e", "2020-02-03")
    assert values(fixed, "e") == [(dt.date(2020, 2, 3),)] * 4
    nulls = spark.createDataFrame([(None,), (1,)], "v int")
    assert values(cleaning.ensure_string(nulls, "v"), "v") == [("1",), ("UNKNOWN",)]


def test_names_are_normalised_and_collisions_raise(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF(" Loan Id", "AMOUNT ")
    assert cleaning.normalize_names(df).columns == ["loan_id", "amount"]
    with pytest.raises(ValueError, match="loan_id"):
        cleaning.normalize_names(df.toDF("loan id", "LOAN_ID"))


def test_dedup_counts_nulls_as_equal_and_is_idempotent(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "k int, v string")
    once = cleaning.dedup_rows(df)
    assert once.count() == 2 and cleaning.dedup_rows(once).count() == 2


def test_bronze_region_and_dates(spark):
    loans = spark.createDataFrame([("L1",)], "loan_id string")
    out = cleaning.to_bronze(loans, "loans", "2024-05-06")
    assert values(out, "region_code", "business_date") == [("UNKNOWN", dt.date(2024, 5, 6))]
    moves = spark.createDataFrame([("I1", "2024-03-04 23:59:59")], "intraday_id string, as_of_timestamp string")
    out = cleaning.to_bronze(moves, "intraday")
    assert values(out, "as_of_timestamp_date") == [(dt.date(2024, 3, 4),)]
    bare = spark.createDataFrame([("I1",)], "intraday_id string")
    assert values(cleaning.to_bronze(bare, "intraday", "2024-01-01"), "as_of_timestamp_date") == [
        (dt.date(2024, 1, 1),)
    ]
    scen = spark.createDataFrame([(1,)], "scenario_id int")
    assert cleaning.to_bronze(scen, "scenario").columns == ["scenario_id"]


def test_missing_required_columns_raise_with_the_list(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="b"):
        cleaning.require_columns(df, ["a", "b"], "check")


def test_dates_hold_no_number(spark):
    df = spark.sql("SELECT DATE '2024-01-01' AS d, true AS b")
    out = cleaning.ensure_numeric(cleaning.ensure_numeric(df, "d", 7.0), "b", 1.0)
    assert out.first()[:] == (7.0, 1.0)


def test_dedup_moves_only_rows_of_repeated_hashes(spark):
    df = spark.sql("""SELECT * FROM VALUES (3, 'a', 0.0D, array(1, 1)), (1, NULL, double('NaN'), NULL), (3, 'a', -0.0D, array(1, 1)),
        (2, NULL, NULL, NULL), (1, NULL, double('NaN'), NULL), (5, NULL, NULL, array(1, 2)), (5, NULL, NULL, array(1, 3)),
        (4, 'b', 1.0D, NULL) AS t(id, `a.b`, v, m)""").coalesce(1)
    repeated = cleaning.repeated_rows(df)
    assert repeated.count() == 3  # a chance hit too: arrays take no part in the hash
    once = cleaning.dedup_rows(df, repeated)
    assert [r["id"] for r in once.collect()][:2] == [2, 4]  # in their place
    shown = [sorted(map(str, x.selectExpr("id", "`a.b`", "v + 0.0D", "m").collect())) for x in (once, df.dropDuplicates())]
    assert shown[0] == shown[1] and len(shown[0]) == 6
