"""The gated stream: status of each drop, restarts, replays and unfinished drops."""

import pytest
from pyspark.sql import functions as F

from stresslake.plans import medallion
from stresslake.sources import writers
from stresslake.specs import SPECS, Layout
from stresslake.streaming import gated

DAY = "2026-06-01"


def cash(spark, first, n, **other):
    made = {"region_code": F.lit("ASIA"), "currency_code": F.lit("EUR"), "opening_balance": F.col("id") + 0.5,
            "closing_balance": F.col("id") + 2.5, "available_liquidity": F.col("id") + 1.5,
            "cash_position_id": F.concat(F.lit("P"), F.col("id"))}
    made |= {c: F.lit(DAY) for c in ("business_date", "start_date", "end_date")}
    made |= other
    return spark.range(first, first + n).select(*[made.get(c, F.lit("x")).alias(c) for c in SPECS["cash"].columns])


@pytest.fixture
def lake(tmp_path):
    return Layout(str(tmp_path), undated=("cash",))


def drop(layout, rows, stamp):
    return writers.write_csv_drop(rows, layout.raw("cash"), "cash", stamp)


def run(spark, layout, **options):
    gated.stream_gated(spark, layout, "cash", as_of="2026-12-31", **options).awaitTermination()
    log = gated.load_log(spark, layout, "cash").orderBy("load_id").collect()
    return {r.load_id.removeprefix("cash_").removesuffix(".csv"): (r.status, r.rows) for r in log}


def test_drops_are_judged_once(spark, lake):
    drop(lake, cash(spark, 0, 8), "1")
    assert run(spark, lake) == {"1": ("written", 8)}
    assert run(spark, lake) == {"1": ("written", 8)}
    twice = cash(spark, 20, 3)
    drop(lake, twice.unionByName(twice), "2")
    drop(lake, cash(spark, 30, 4), "3")
    assert run(spark, lake) == {"1": ("written", 8), "2": ("refused", 6), "3": ("written", 4)}
    bronze = gated.streamed_bronze(spark, lake, "cash")
    assert bronze.count() == 12 and bronze.schema["opening_balance"].dataType.typeName() == "double"
    assert {r[0] for r in gated.quarantined(spark, lake, "cash").select("load_id").distinct().collect()} == {"cash_2.csv"}
    note = gated.load_log(spark, lake, "cash").where("status = 'refused'").first()["note"]
    assert "duplicate cash_position_id found" in note


def test_faulty_columns_do_not_stop_the_stream(spark, lake):
    drop(lake, cash(spark, 0, 2).drop("branch_id").withColumn("more", F.lit("y")), "1")
    drop(lake, cash(spark, 5, 2), "2")
    assert run(spark, lake, max_files=1) == {"1": ("refused", 2), "2": ("written", 2)}


def test_unfinished_drops_wait(spark, lake, tmp_path):
    drop(lake, cash(spark, 0, 2), "1")
    done = tmp_path / "raw" / "cash" / "cash_1.csv" / "_SUCCESS"
    done.rename(tmp_path / "kept")
    assert run(spark, lake) == {"1": ("waiting", None)}
    (tmp_path / "kept").rename(done)
    drop(lake, cash(spark, 5, 2), "2")
    assert run(spark, lake) == {"1": ("written", 2), "2": ("written", 2)}


def test_a_batch_that_runs_again_changes_nothing(spark, lake):
    """As after a crash between data and checkpoint: the same batch number comes back."""
    drop(lake, cash(spark, 0, 5), "1")
    batch = spark.createDataFrame([("cash_1.csv",)], "drop string")
    for _ in range(3):
        gated._judge(batch, 4, lake, "cash", "2026-12-31", ())
    assert gated.streamed_bronze(spark, lake, "cash").count() == 5
    # A later batch that sees another file of the drop leaves it alone.
    gated._judge(batch, 5, lake, "cash", "2026-12-31", ())
    assert gated.streamed_bronze(spark, lake, "cash").count() == 5
    assert gated.load_log(spark, lake, "cash").collect()[0]["rows"] == 5


def test_arrivals_are_listed_and_not_read(spark, lake, tmp_path):
    """A file counts once, however many lines it has."""
    drop(lake, cash(spark, 0, 80).coalesce(2), "1")
    query = gated.stream_gated(spark, lake, "cash", as_of="2026-12-31")
    query.awaitTermination()
    files = list((tmp_path / "raw" / "cash" / "cash_1.csv").glob("*.csv"))
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(files) == 2
    assert gated.load_log(spark, lake, "cash").first()["rows"] == 80


def test_stream_equals_gated_batch(spark, lake):
    drop(lake, cash(spark, 0, 6), "1")
    run(spark, lake)
    step = medallion.ingest_table(spark, lake, "cash", "2026-12-31", gate=True, expected_rows=6)
    assert (step.status, step.rows) == ("written", 6)
    batch = spark.read.parquet(lake.bronze("cash"))
    streamed = gated.streamed_bronze(spark, lake, "cash").select(batch.columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_expected_rows_refuse_a_short_drop(spark, lake):
    drop(lake, cash(spark, 0, 6), "1")
    steps = medallion.ingest(spark, lake, ["cash"], "2026-12-31", gate=True, expected_rows={"cash": 60})
    assert [s.status for s in steps] == ["refused"]


def test_observed_checks_equal_scanned_ones(spark, lake):
    rows = cash(spark, 0, 6, currency_code=F.when(F.col("id") > 3, "EUR"), opening_balance=F.lit(None).cast("string"))
    drop(lake, rows, "1")
    drop_scenario = spark.createDataFrame([(1, 1.0), (2, -0.5)], "scenario_id int, market_stress_factor double")
    writers.write_unpartitioned(drop_scenario, lake.bronze("scenario"))
    steps = medallion.ingest(spark, lake, ["cash"], check=True)
    steps += medallion.run_pipeline(spark, lake, ["cash"], check=True)
    found = sorted(map(tuple, medallion.observed_checks(spark, lake, steps).collect()))
    scanned = sorted(map(tuple, medallion.validate_layers(spark, lake, ["cash"]).collect()))
    assert found == scanned
    assert ("gold", "cash", "non_positive_factor", 6, "FAIL") in found
    assert ("silver", "cash", "nulls:opening_balance", 6, "WARN") in found
