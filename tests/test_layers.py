import datetime as dt
import os
from urllib.parse import unquote

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from stresslake.operators import scenario
from stresslake.plans import catalog, medallion
from stresslake.sources import readers, writers
from stresslake.specs import SPECS, TRANSFORMABLE, Layout, spec_for


def drop(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_newest_drop_wins_then_name(spark, tmp_path):
    folder = tmp_path / "cash"
    assert readers.latest_snapshot(spark, str(folder)) is None
    for name, mtime in (("cash_1.csv", 300), ("cash_2.csv", 200), ("cash_3.csv", 300), ("other_9.csv", 400)):
        os.utime(drop(folder / name, "a"), (mtime, mtime))
    assert readers.latest_snapshot(spark, str(folder), "cash").endswith("cash_3.csv")
    assert readers.latest_snapshot(spark, str(folder)).endswith("other_9.csv")
    assert readers.latest_snapshot(spark, str(folder), "loans") is None


def test_directory_drops(spark, tmp_path):
    first = writers.write_csv_drop(spark.range(3), str(tmp_path), "loans", "20240101")
    os.utime(tmp_path / "loans_20240101.csv" / "_SUCCESS", (100, 100))
    second = writers.write_csv_drop(spark.range(5), str(tmp_path), "loans", "20240102")
    assert readers.latest_snapshot(spark, str(tmp_path)) == second != first
    assert readers.read_raw_csv(spark, second).count() == 5


def test_nested_and_unfinished_drops_do_not_count(spark, tmp_path):
    good = drop(tmp_path / "loans_1.csv", "a")
    os.utime(good, (100, 100))
    (tmp_path / "archive").mkdir()
    drop(tmp_path / "archive" / "loans_9.csv", "a")
    (tmp_path / "loans_8.csv").mkdir()
    drop(tmp_path / "loans_8.csv" / "part-0.csv", "a")
    assert readers.latest_snapshot(spark, str(tmp_path)).endswith("/loans_1.csv")


def test_typed_read_survives_order_extra_and_bad_values(spark, tmp_path):
    path = drop(tmp_path / "x.csv", "loan_amount,note,loan_id,start_date", "12.5,hey,L1,2024-01-02", "abc,,L2,soon")
    df = readers.read_raw_csv(spark, path, "loans")
    assert [tuple(r) for r in df.collect()] == [(12.5, "hey", "L1", dt.date(2024, 1, 2)), (None, None, "L2", None)]


def test_profile_read_knows_null_words(spark, tmp_path):
    path = drop(tmp_path / "x.csv", "a,b", "NA,1", "null,", "x,n/a")
    rows = [tuple(r) for r in readers.read_text_columns(spark, path).collect()]
    assert rows == [(None, "1"), (None, None), ("x", None)]


def test_write_needs_its_partition_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="missing"):
        writers.write_partitioned(spark.range(1), str(tmp_path / "t"), ["region_code"])
    assert readers.read_if_exists(spark, str(tmp_path / "t")) is None


def test_rewrite_of_a_base_table_keeps_its_aggregates(spark, tmp_path):
    layout = Layout(str(tmp_path))
    gold = spark.sql(
        "SELECT 1 AS scenario_id, 'E' AS region_code, DATE'2024-01-01' AS business_date, 2.0D AS stressed_liquidity")
    for _ in range(2):
        writers.write_partitioned(gold, layout.gold("cash"), SPECS["cash"].gold_partitions)
        medallion.aggregate(spark, layout, ["cash"])
    writers.write_partitioned(gold, layout.gold("cash"), SPECS["cash"].gold_partitions)
    assert readers.read_table(spark, layout.aggregate("aggregates_cash")).count() == 1
    assert readers.read_table(spark, layout.gold("cash")).count() == 1


def test_numeric_looking_regions_stay_text(spark, tmp_path):
    rows = spark.sql("SELECT '01' AS region_code, DATE'2024-01-01' AS business_date, 1 AS v")
    writers.write_partitioned(rows, str(tmp_path / "t"), ["region_code", "business_date"])
    back = readers.read_table(spark, str(tmp_path / "t"))
    assert tuple(back.select("region_code", "business_date", "v").first()) == ("01", dt.date(2024, 1, 1), 1)


def raw_rows(spark, name, n):
    """``n`` rows in the registry schema, two regions and three days."""
    made = {"string": F.concat(F.lit("v"), F.col("id")), "float": F.col("id") * 1.0 + 10,
            "date": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")),
            "datetime": F.lit("2024-01-01 10:00:00")}
    special = {"region_code": F.when(F.col("id") % 2 == 0, "EU").otherwise("US"),
               "currency_code": F.when(F.col("id") % 2 == 0, "EUR").otherwise("USD")}
    cols = spec_for(name).columns
    return spark.range(n).select([special.get(c, made[k]).alias(c) for c, k in cols.items()])


def test_whole_run(spark, tmp_path):
    layout = Layout(str(tmp_path))
    for name in TRANSFORMABLE:
        rows = raw_rows(spark, name, 6)
        writers.write_csv_drop(rows.unionByName(rows.limit(1)), layout.raw(name), name, "20240105")
    writers.write_csv_drop(scenario.scenario_table(spark), layout.raw("scenario"), "scenario", "20240105")

    ingested = {s.table: s for s in medallion.ingest(spark, layout, as_of="2024-01-05")}
    assert ingested["fx_rates"].status == medallion.SKIPPED
    assert ingested["loans"].rows == 7 and ingested["scenario"].rows == 5

    steps = {(s.stage, s.table): s for s in medallion.run_pipeline(spark, layout)}
    for name in TRANSFORMABLE:
        assert steps["silver", name].rows == 6
        assert steps["gold", name].rows == 30
        assert steps["aggregates", f"aggregates_{name}"].rows == 10
    assert steps["aggregates", "aggregates_combined"].rows == 5

    combined = {r["scenario_id"]: r for r in readers.read_table(spark, layout.aggregate("aggregates_combined")).collect()}
    factors = dict(scenario.DEFAULT_SET[0])
    usd = (10 + 12 + 14) * 1.09 + 11 + 13 + 15
    for number, row in combined.items():
        assert row["txn_total"] == pytest.approx(usd * float(factors[number]))
        assert row["loan_total"] == pytest.approx(row["txn_total"])

    exported = {s.table: s.status for s in medallion.export(spark, layout)}
    assert set(exported.values()) == {medallion.WRITTEN} and len(exported) == 9
    checks = medallion.validate_layers(spark, layout)
    assert checks.where("status = 'FAIL'").count() == 0
    assert {r[0] for r in checks.select("layer").distinct().collect()} == {"bronze", "silver", "gold"}
    assert medallion.run_report(spark, steps.values()).count() == len(steps)


def test_missing_inputs_are_reported(spark, tmp_path):
    layout = Layout(str(tmp_path))
    assert {s.status for s in medallion.ingest(spark, layout)} == {medallion.SKIPPED}
    assert {s.status for s in medallion.convert(spark, layout)} == {medallion.SKIPPED}
    assert {s.status for s in medallion.export(spark, layout)} == {medallion.SKIPPED}
    assert medallion.validate_layers(spark, layout) is None


def test_gate_refuses_a_bad_drop(spark, tmp_path):
    layout = Layout(str(tmp_path))
    bad = raw_rows(spark, "cash", 4).withColumn("closing_balance", F.lit("oops"))
    writers.write_csv_drop(bad, layout.raw("cash"), "cash", "20240101")
    step = medallion.ingest_table(spark, layout, "cash", gate=True)
    assert step.status == medallion.REFUSED
    good = raw_rows(spark, "cash", 4).withColumn("closing_balance", F.lit(99.0))
    writers.write_csv_drop(good, layout.raw("cash"), "cash", "20240102")
    step = medallion.ingest_table(spark, layout, "cash", gate=True)
    assert (step.status, step.rows) == (medallion.WRITTEN, 4)


def test_scratch_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = writers.scratch_root(spark)
    assert root.startswith(named) if named else os.path.isdir(root)


def test_registry():
    assert spec_for("fx").name == "fx_rates" and spec_for(" Loans ").key == ("loan_id",)
    assert spec_for("scenario").partitions == []
    with pytest.raises(ValueError):
        spec_for("bonds")
    layout = Layout("/x/", undated=("loans",))
    assert layout.bronze("fx_rates") == "/x/bronze/fx"
    assert layout.partitions(SPECS["loans"], "gold") == ["scenario_id", "region_code"]


def test_few_directories_are_written_without_sort_or_exchange(spark, tmp_path, monkeypatch):
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    save = DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda w, *a: (seen.append(spark.conf.get(name)), save(w, *a))[1])
    rows = spark.range(0, 90, 1, 1).selectExpr("id % 3 AS k", "id")
    expected = sorted((i % 3, i) for i in range(90))
    before = spark.conf.get(name)
    writers.write_partitioned(rows, str(tmp_path / "t"), ["k"], rebalance=False)
    writers.write_partitioned(rows, str(tmp_path / "u"), ["k"])
    assert [int(n) for n in seen] == [writers.OPEN_FILES, 0] and spark.conf.get(name) == before
    back = readers.read_table(spark, str(tmp_path / "t"))
    assert sorted((r["k"], r["id"]) for r in back.collect()) == expected
    monkeypatch.setattr(writers, "OPEN_FILES", 2)  # further directories are sorted, none is lost
    writers.write_partitioned(rows, str(tmp_path / "t"), ["k"], rebalance=False)
    back = readers.read_table(spark, str(tmp_path / "t"))
    assert sorted((r["k"], r["id"]) for r in back.collect()) == expected


def test_silver_is_written_from_bronze_rows_in_place(spark, tmp_path):
    layout = Layout(str(tmp_path), undated=("loans",))
    assert not layout.many_directories(SPECS["loans"]) and layout.many_directories(SPECS["cash"])
    rows = raw_rows(spark, "loans", 40)
    writers.write_csv_drop(rows.unionByName(rows.limit(3)), layout.raw("loans"), "loans", "1")
    medallion.ingest(spark, layout, ["loans"], as_of="2024-01-05")
    assert medallion.convert(spark, layout, ["loans"])[0].rows == 40
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_ordered_rows_take_less_room(spark, tmp_path):
    """Amounts that rise together are written as small steps; extracts keep the order of what they read."""
    rows = spark.range(0, 60_000, 1, 1).selectExpr(
        "CAST(id % 3 AS INT) AS k", "CAST(pmod(xxhash64(id), 10000000) / 100 AS DECIMAL(18,2)) AS amount",
    ).withColumn("amount_usd", F.col("amount") * F.lit("1.09").cast("decimal(12,6)"))
    paths = [str(tmp_path / name) for name in ("plain", "ordered", "report", "nulls")]
    writers.write_partitioned(rows, paths[0], ["k"], "parquet", rebalance=False)
    writers.write_partitioned(rows, paths[1], ["k"], "parquet", rebalance=False, order=["amount_usd"])
    writers.export_report(spark.read.parquet(paths[1]), paths[2], True)

    def size(path):
        return sum(os.path.getsize(f.removeprefix("file://")) for f in spark.read.parquet(path).inputFiles())

    assert size(paths[1]) < 0.75 * size(paths[0]) and size(paths[2]) < 0.75 * size(paths[0])
    names, expected = ["k", "amount", "amount_usd"], sorted(map(tuple, rows.collect()))
    for path in paths[:3]:
        assert sorted(map(tuple, spark.read.parquet(path).select(names).collect())) == expected
    empty = rows.withColumn("amount_usd", F.lit(None).cast("decimal(31,8)"))
    writers.write_partitioned(empty, paths[3], ["k"], "parquet", rebalance=False, order=["amount_usd"])
    assert spark.read.parquet(paths[3]).where("amount_usd IS NULL").count() == 60_000


def test_report_export_orders_silver_by_amount(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "scratch_root", lambda _: str(tmp_path))
    catalog.report_export(spark, sf_dir)
    layout = Layout(str(tmp_path))
    for table, amount in (("loans", "outstanding_balance_usd"), ("transactions", "transaction_amount_usd")):
        for path in (layout.silver(table), layout.gold(table), layout.report(table)):
            falls = rises = 0
            for file in spark.read.parquet(path).inputFiles():
                values = [r[0] for r in spark.read.parquet(unquote(file)).select(amount).collect()]
                falls += sum(a > b for a, b in zip(values, values[1:], strict=False))
                rises += len(values)
            # A file may hold a few sorted runs after one another.
            assert falls < 0.05 * rises
