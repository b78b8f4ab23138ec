"""Slices of stored tables, the dashboard grid and the write options behind them."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from stresslake.operators import kpi
from stresslake.plans import stored
from stresslake.sources import readers, writers


@pytest.fixture
def gold(spark, tmp_path):
    """A table by scenario and region whose files outside the wanted slice are unreadable."""
    rows = spark.range(400).select(
        (F.col("id") % 4).cast("int").alias("scenario_id"),
        F.element_at(F.array(*map(F.lit, ["ASIA", "EUROPE", "AFRICA", "01"])), (F.col("id") % 5 % 4 + 1).cast("int"))
        .alias("region_code"), F.col("id").alias("v"),
    )
    path = str(tmp_path / "gold")
    writers.write_partitioned(rows, path, ["scenario_id", "region_code"], "parquet")
    return rows, path


def spoil(path, keep):
    for file in glob.glob(f"{path}/*/*/*.parquet"):
        if not keep(file):
            # Same length, so that the listing stays as it is.
            size = os.path.getsize(file)
            with open(file, "wb") as out:
                out.write(b"x" * size)
            crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
            if os.path.exists(crc):
                os.unlink(crc)


def test_named_slice_reads_its_directories_only(spark, gold):
    rows, path = gold
    table = readers.read_table(spark, path, "parquet", schema=rows.schema)
    spoil(path, lambda f: ("scenario_id=1/" in f or "scenario_id=3/" in f) and "region_code=ASIA" in f)
    part = kpi.select_slice(table, [1, 3], ["ASIA"])
    expected = kpi.select_slice(rows, [1, 3], ["ASIA"])
    assert sorted(map(tuple, part.select("v").collect())) == sorted(map(tuple, expected.select("v").collect()))
    assert "PartitionFilters: [" in part._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Exception):  # noqa: B017  (whatever the reader makes of such a file)
        kpi.select_slice(table, [1], ["EUROPE"]).collect()


def test_dimension_prunes_while_running(spark, gold, tmp_path):
    rows, path = gold
    spark.createDataFrame(
        [("ASIA", "x"), ("ASIA", "x"), ("01", "x"), ("EUROPE", "y"), (None, "x")], "region_code string, kind string"
    ).write.parquet(str(tmp_path / "regions"))
    wanted = spark.read.parquet(str(tmp_path / "regions")).where("kind = 'x'")
    table = readers.read_table(spark, path, "parquet", schema=rows.schema)
    spoil(path, lambda f: "region_code=ASIA" in f or "region_code=01" in f)
    part = kpi.select_by(table, wanted)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert part.count() == rows.where("region_code IN ('ASIA', '01')").count()


def test_touched_only_leaves_other_directories(spark, gold):
    _, path = gold
    one = spark.sql("SELECT 2 AS scenario_id, 'ASIA' AS region_code, 7L AS v")
    writers.write_partitioned(one, path, ["scenario_id", "region_code"], "parquet", touched_only=True)
    back = spark.read.parquet(path)
    assert [r.v for r in back.where("scenario_id = 2 AND region_code = 'ASIA'").collect()] == [7]
    assert back.where("scenario_id = 1").count() == 100


def test_grid_reads_each_table_once(spark, sf_dir):
    grid = stored.kpi_dashboard_grid(spark, sf_dir)
    plan = grid._jdf.queryExecution().executedPlan().toString()
    for column in ("o_totalprice", "l_extendedprice", "c_acctbal", "event_type"):
        scans = [line for line in plan.splitlines() if "FileScan" in line and column in line]
        assert len(scans) == 1, column
    assert plan.count("Expand") >= 1


def test_grid_levels(spark):
    rows = "scenario_id int, region_code string, business_date date, n bigint, total_stressed_liquidity double"
    daily = spark.createDataFrame([(1, "A", None, 2, 5.0), (1, "B", None, 1, 2.0), (2, None, None, 4, 8.0)], rows)
    found = {(r.level, r.scenario_id, r.region_code): (r.n, r.total) for r in kpi.dashboard_grid({"cash": daily}).collect()}
    assert found["", None, None] == (7, 15.0)
    assert found["scenario_id", 1, None] == (3, 7.0)
    # A NULL region is a region of its own, not the sum over regions.
    assert found["region_code", None, None] == (4, 8.0) and found["region_code", None, "A"] == (2, 5.0)
