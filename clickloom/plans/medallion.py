"""Job: raw files to Silver events, Gold tables and an audit."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators.gold import funnel_base, gold_tables
from clickloom.operators.parse import parse_events
from clickloom.operators.purchases import purchase_cube
from clickloom.operators.quality import silver_audit
from clickloom.operators.silver import silver_events, silver_of_parsed
from clickloom.schema import GOLD_ORDER, GOLD_TABLES
from clickloom.session import use_utc
from clickloom.sources.events_csv import check_inputs, input_files, staged_events
from clickloom.sources.lake import (
    guard_raw,
    read_table,
    rewrite_months,
    staged,
    write_months,
    write_silver,
    write_summary,
    write_table,
)


def write_gold(silver: DataFrame, path: str) -> dict[str, DataFrame]:
    """The five tables, from one pass over sessions and one over purchases. All with a month have
    a folder for each."""

    def write(name: str, table: DataFrame) -> DataFrame:
        if name in GOLD_ORDER:
            return write_months(table, f"{path}/{name}", *GOLD_ORDER[name])
        return write_table(table, f"{path}/{name}")

    finest = "funnel_by_utc_weekday_hour"
    by_weekday_hour = write(finest, funnel_base(silver))
    with staged(purchase_cube(silver), "purchases") as cube:
        tables = gold_tables(by_weekday_hour, cube)
        return {
            name: table if name == finest else write(name, table) for name, table in tables.items()
        }


def read_gold(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables as a dashboard reads them, without a look at Silver."""
    return {name: read_table(spark, f"{path}/{name}") for name in GOLD_TABLES}


def rerun_months(
    spark: SparkSession,
    paths: Sequence[str],
    silver_path: str,
    gold_path: str,
    months: Sequence[str],
) -> DataFrame:
    """Write some months of Silver again from the files given (see :func:`rewrite_months`), and Gold
    from the whole of Silver, as sessions may go on over a month's end."""
    use_utc(spark)
    guard_raw(silver_path, gold_path)
    check_inputs(spark, paths)
    with staged_events(spark, paths) as bronze:
        silver = rewrite_months(silver_events(bronze), silver_path, months)
    write_gold(silver, gold_path)
    return silver


def run_medallion(
    spark: SparkSession,
    paths: Sequence[str],
    silver_path: str,
    gold_path: str,
    summary_path: str,
) -> dict:
    """Write Silver, Gold and the audit, and return the audit.

    The files are parsed once, into a staged table that both the audit and Silver read. The
    audit is a query over that table rather than counters inside the Silver job, since a
    stage that runs again after a lost executor would count its rows twice.
    """
    use_utc(spark)
    guard_raw(silver_path, gold_path, summary_path)
    check_inputs(spark, paths)
    # Names and sizes are a table, since there may be very many files.
    files_path = f"{summary_path}-files"
    files = write_table(input_files(spark, paths), files_path)
    inputs = files.agg(
        F.count(F.lit(1)).alias("input_files"), F.sum("file_bytes").alias("input_bytes")
    ).first()

    with staged_events(spark, paths, parse_events) as parsed:
        audit = silver_audit(parsed).first().asDict()
        silver = write_silver(silver_of_parsed(parsed), silver_path)
    silver_rows = silver.count()
    gold = write_gold(silver, gold_path)

    totals = ("source_rows", "valid_rows_before_dedup", "rejected_rows")
    summary = {
        "generated_at_utc": datetime.now(timezone.utc).isoformat(),
        "engine": {"name": "PySpark", "version": spark.version},
        "storage_format": "Parquet",
        "bronze": {
            **inputs.asDict(), "input_files_table": files_path, "raw_modified": False,
        },
        "silver": {"path": silver_path, "rows": silver_rows, "partition_column": "event_month"},
        "gold": {
            "path": gold_path,
            "outputs": {name: f"{gold_path}/{name}" for name in gold},
            "row_counts": {name: table.count() for name, table in gold.items()},
        },
        **{name: audit[name] for name in totals},
        "silver_rows": silver_rows,
        "duplicate_excess_rows_removed": audit["valid_rows_before_dedup"] - silver_rows,
        "quality_counts": {name: n for name, n in audit.items() if name not in totals},
    }
    write_summary(spark, summary, summary_path)
    return summary
