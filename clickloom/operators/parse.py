"""Typed helper columns next to the raw text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions import is_blank, to_amount, to_id, to_time
from clickloom.schema import CORRUPT, FUNNEL_TYPES, RAW_COLUMNS, SEMANTIC_TYPES


def parse_events(bronze: DataFrame) -> DataFrame:
    """Add ``kind, ts, product, category, user, amount``; what cannot be read becomes NULL."""
    return bronze.withColumns(
        {
            "kind": F.trim("event_type"),
            "ts": to_time(F.col("event_time")),
            "product": to_id(F.col("product_id")),
            "category": to_id(F.col("category_id")),
            "user": to_id(F.col("user_id")),
            "amount": to_amount(F.col("price")),
        }
    )


def intact(parsed: DataFrame) -> DataFrame:
    """Rows that the CSV reader could split into their columns."""
    return parsed.where(F.col(CORRUPT).isNull())


def session_events(events: DataFrame) -> DataFrame:
    """Narrow rows the funnel needs, from ``user_session, event_time, event_type``."""
    return events.where(
        F.col("event_type").isin(*FUNNEL_TYPES)
        & F.col("event_time").isNotNull()
        & ~is_blank(F.col("user_session"))
    ).select(F.trim("user_session").alias("user_session"), "event_time", "event_type")


def profile_session_events(parsed: DataFrame) -> DataFrame:
    """The same rows from parsed raw events, where other columns may still be bad."""
    return session_events(
        intact(parsed).select(
            "user_session",
            F.col("ts").alias("event_time"),
            F.col("kind").alias("event_type"),
        )
    )


def column_catalogue(spark) -> DataFrame:
    return spark.createDataFrame(
        [(name, "string", SEMANTIC_TYPES[name]) for name in RAW_COLUMNS],
        "name string, csv_storage_type string, analysis_type string",
    )
