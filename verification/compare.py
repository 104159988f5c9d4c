"""Compare every query with its reference SQL: ``python -m verification.compare <folder> [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from verification import oracle, registry

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.sql(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
            )
    return connection


def _kind(dtype: str) -> str:
    return {"long": "bigint", "integer": "int", "varchar": "string"}.get(dtype, dtype)


def _rows(frame: pd.DataFrame) -> list[tuple]:
    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(repr(v) for v in row) for row in ordered.astype(object).where(
        ordered.notna(), None).itertuples(index=False))


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """What differs, or None."""
    result = registry.queries()[name](spark, sf_dir)
    got = result.toPandas()
    relation = connection.sql(oracle.oracle_sql()[name])
    want = relation.df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    spark_types = {f.name: f.dataType.simpleString() for f in result.schema}
    duck_types = {
        column: _kind(str(kind).lower()) for column, kind in zip(relation.columns, relation.types)
    }
    aliases = {"timestamp": "timestamp_ntz", "integer": "int"}
    odd = {
        c: (spark_types[c], duck_types[c])
        for c in spark_types
        if spark_types[c] != aliases.get(duck_types[c], duck_types[c])
    }
    if odd:
        return f"types {odd}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for column in got.columns:  # the same Python types on both sides
        if str(got[column].dtype).startswith(("datetime", "date")):
            got[column] = got[column].astype("datetime64[us]")
            want[column] = want[column].astype("datetime64[us]")
        elif spark_types[column] == "date":
            got[column] = got[column].astype(str)
            want[column] = pd.to_datetime(want[column]).dt.strftime("%Y-%m-%d")
        elif spark_types[column] in ("bigint", "int"):
            got[column], want[column] = got[column].astype("Int64"), want[column].astype("Int64")
    left, right = _rows(got), _rows(want)
    if left != right:
        pairs = [(a, b) for a, b in zip(left, right) if a != b][:2]
        return f"values {pairs}"
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", "/tmp/clickloom-compare")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in names or registry.queries():
        start = time.time()
        if name in oracle.oracle_sql():
            found = difference(spark, connection, sf_dir, name)
            failures += found is not None
            outcome = "same" if found is None else f"DIFFERENT {found}"
        else:
            outcome = f"{registry.queries()[name](spark, sf_dir).count()} rows, no SQL"
        print(f"{name:32s} {time.time() - start:6.2f}s {outcome}", flush=True)
    return 1 if failures else 0


if __name__ == "__main__":
    raise SystemExit(main())
