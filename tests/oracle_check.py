"""Run registered queries in Spark and their SQL in DuckDB and compare all rows.

``python -m tests.oracle_check [sf_dir] [query ...]``
"""

from __future__ import annotations

import glob
import os
import sys
import time
import traceback
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

import __spark_entry__ as entry

INTEGERS = {"tinyint", "smallint", "int", "bigint"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if names, kinds of types and all rows agree."""
    names = sorted(df.columns)
    result = con.sql(sql)
    if names != sorted(result.columns):
        return [f"columns {names} != {sorted(result.columns)}"]
    order = ", ".join(f'"{n}"' for n in names)
    result = con.sql(f"SELECT {order} FROM ({sql})")
    out = []
    for field, duck in zip(df.select(*names).schema, result.types, strict=True):
        ours, theirs = field.dataType.simpleString(), str(duck).lower()
        same = {"string": "varchar", "double": "double", "int": "integer"}.get(ours, ours) == theirs
        if not same and not (ours in INTEGERS and theirs in ("integer", "bigint", "hugeint")):
            out.append(f"type of {field.name}: {ours} / {theirs}")
    spark_rows = Counter(tuple(r) for r in df.select(*names).collect())
    duck_rows = Counter(result.fetchall())
    only_spark, only_duck = spark_rows - duck_rows, duck_rows - spark_rows
    if only_spark or only_duck:
        out.append(f"rows {spark_rows.total()} / {duck_rows.total()}, differing "
                   f"{only_spark.total()} / {only_duck.total()}")
        out += [f"  spark {r}" for r in sorted(only_spark, key=repr)[:4]]
        out += [f"  duck  {r}" for r in sorted(only_duck, key=repr)[:4]]
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                found = differences(df, con, sql[name])
                note = "ok" if not found else "DIFF"
            else:
                found, note = [], f"rows only: {df.count()}"
        except Exception:
            found, note = [traceback.format_exc(limit=3)[-1500:]], "ERROR"
        bad += bool(found)
        print(f"{name:32s} {note} {time.time() - start:.2f}s", *found, sep="\n   " if found else " ")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
