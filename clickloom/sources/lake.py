"""Tables and summaries in the lake."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.session import shared_folder


def guard_raw(*paths: str) -> None:
    """Raw data is never written: refuse any output path with a part named ``raw``."""
    for path in paths:
        if "raw" in (part.casefold() for part in str(path).replace("\\", "/").split("/")):
            raise ValueError(f"refusing to write below a raw folder: {path}")


@contextmanager
def staged(frame: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """Write a table that several steps read to the shared folder, and read it from there.

    Its files outlive lost executors, and readers take only the columns they need. At the
    end the table is overwritten with no rows, which frees its space.
    """
    path = shared_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    try:
        yield read_back(frame, path)
    finally:
        frame.limit(0).write.mode("overwrite").parquet(path)


def write_months(table: DataFrame, path: str, *order: str) -> DataFrame:
    """Overwrite a table with a folder for each ``event_month``, rows in order in each file, so that
    readers skip months by folder and the rest by file statistics.

    Rebalancing by month keeps a task from writing a file for every month, and splits large
    months over many tasks."""
    guard_raw(path)
    dealt = table.hint("rebalance", "event_month")
    if order:
        dealt = dealt.sortWithinPartitions("event_month", *order)
    dealt.write.mode("overwrite").partitionBy("event_month").parquet(path)
    return read_back(table, path)


def write_silver(silver: DataFrame, path: str) -> DataFrame:
    return write_months(silver, path)


def rewrite_months(silver: DataFrame, path: str, months: Sequence[str]) -> DataFrame:
    """Replace some months of Silver and leave the files of all others as they are.

    Copies of a row have one event time, hence one month, but may lie in files of any month: the
    rows given have to come from all files that may hold events of these months, else a month loses
    what only other files had, and its kept file names change. A month without rows is refused,
    as the write would leave its old rows."""
    guard_raw(path)
    if not months:
        raise ValueError("no month to write again")
    chosen = silver.where(F.col("event_month").isin(*months))
    with staged(chosen, "months") as rows:
        found = {row["event_month"] for row in rows.select("event_month").distinct().collect()}
        if absent := sorted(set(months) - found):
            raise ValueError(f"no rows for {absent}")
        (
            rows.hint("rebalance", "event_month")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_month")
            .parquet(path)
        )
    return read_back(silver, path)


def read_back(table: DataFrame, path: str) -> DataFrame:
    """What was just written. The schema is known, and a table may have no rows to infer it."""
    return table.sparkSession.read.schema(table.schema).parquet(path)


def write_table(table: DataFrame, path: str) -> DataFrame:
    """Overwrite a result table: one file while it is small, more where it is not."""
    guard_raw(path)
    table.hint("rebalance").write.mode("overwrite").parquet(path)
    return read_back(table, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_summary(spark: SparkSession, summary: dict, path: str) -> None:
    """One JSON document, without NaN. Spark's commit makes it appear as a whole."""
    guard_raw(path)
    document = json.dumps(summary, ensure_ascii=False, allow_nan=False, default=str)
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def read_summary(spark: SparkSession, path: str) -> dict:
    """A document written above, or any JSON file."""
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])
