from pyspark.sql import functions as F

from stresslake.sources import readers, writers
from stresslake.specs import SPECS, Layout
from stresslake.streaming.landing import stream_to_bronze


def test_stream_takes_each_file_once(spark, tmp_path):
    layout = Layout(str(tmp_path), undated=("cash",))
    for stamp, rows in (("20260601", 8), ("20260602", 12)):
        made = {"region_code": F.lit("ASIA"), "business_date": F.lit("2026-06-01"),
                "opening_balance": F.col("id") * 1.5, "cash_position_id": F.col("id")}
        drop = spark.range(rows).select(
            *[made.get(c, F.lit("1")).alias(c) for c in SPECS["cash"].columns]
        )
        writers.write_csv_drop(drop, layout.raw("cash"), "cash", stamp)
        stream_to_bronze(spark, layout, "cash").awaitTermination()
    bronze = readers.read_table(spark, layout.bronze("cash"))
    assert bronze.count() == 20
    assert bronze.schema["opening_balance"].dataType.typeName() == "double"
    stream_to_bronze(spark, layout, "cash").awaitTermination()
    assert readers.read_table(spark, layout.bronze("cash")).count() == 20
