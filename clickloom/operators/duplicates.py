"""Repeated raw rows: fingerprint, groups and excess rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.schema import CORRUPT, RAW_COLUMNS


def row_fingerprint(*columns: str) -> Column:
    """SHA-256 of the row as JSON. NULL fields are kept, so NULL and empty text differ."""
    row = F.struct(*(columns or RAW_COLUMNS))
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def duplicate_summary(bronze: DataFrame) -> DataFrame:
    """Groups of equal rows, and the rows beyond the first of each group.

    Rows are equal if all nine columns and the corrupt text are. Grouping by the columns
    themselves needs no hash of every row and has no collisions.
    """
    copies = bronze.groupBy(*RAW_COLUMNS, CORRUPT).agg(F.count(F.lit(1)).alias("copies"))
    return copies.where(F.col("copies") > 1).agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_excess_rows"),
    )
