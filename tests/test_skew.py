"""A third of all rows on one key: results stay whole, hot keys are split or folded."""

import pytest
from pyspark.sql import functions as F

from stresslake.plans import catalog, domains
from tests.oracle_check import connect, differences


@pytest.fixture(scope="module")
def skewed(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    for name in ("nation", "region", "customer"):
        domains.table(spark, sf_dir, name).write.parquet(f"{root}/{name}.parquet")
    made = spark.range(60_000).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 150).cast("bigint").alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        (F.col("id") % 1000 + 0.25).alias("o_totalprice"),
        F.lit("2000-01-01").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("5-LOW").alias("o_orderpriority"),
    )
    made.write.parquet(f"{root}/orders.parquet")
    con = connect(str(root))
    for name in ("nation", "region", "customer", "orders"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet/*.parquet'")
    yield str(root), con
    con.close()


@pytest.mark.parametrize(
    "name", ["agg_transaction_stress", "stress_totals_transactions", "fx_convert_transactions"])
def test_hot_key_results_are_whole(spark, skewed, name):
    root, con = skewed
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        assert differences(catalog.QUERIES[name](spark, root), con, catalog.ORACLE[name]) == []
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_places_without_region_or_nation(spark, tmp_path):
    """A nation without a region name keeps its customers; a NULL nation key is harmless."""
    spark.createDataFrame([(1, None), (2, "ASIA")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([(10, 1), (20, 2), (None, 2)], "n_nationkey int, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(100, 10), (200, 20), (300, None)], "c_custkey int, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    found = {tuple(r) for r in domains.customers(spark, str(tmp_path)).collect()}
    assert found == {(100, None, "ZAR"), (200, "ASIA", "JPY")}
    spark.createDataFrame([(1, "EUROPE"), (2, "ASIA")], "r_regionkey int, r_name string").write.mode("overwrite").parquet(f"{tmp_path}/region.parquet")
    found = {tuple(r) for r in domains.customers(spark, str(tmp_path)).collect()}
    assert found == {(100, "EUROPE", "EUR"), (200, "ASIA", "JPY")}
