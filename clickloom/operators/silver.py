"""Valid, typed and deduplicated events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import blank_to_null, is_blank, is_finite, month_of, price_quality
from clickloom.operators.parse import parse_events
from clickloom.schema import CORRUPT, EVENT_TYPES, RAW_COLUMNS


def is_valid() -> Column:
    """A parsed row that may enter Silver: readable time, known type, product, and the other
    numbers readable where given. NULL counts as no, as in a filter."""
    return (
        F.col(CORRUPT).isNull()
        & F.col("kind").isin(*EVENT_TYPES)
        & F.col("product").isNotNull()
        & (F.col("category").isNotNull() | is_blank(F.col("category_id")))
        & (F.col("user").isNotNull() | is_blank(F.col("user_id")))
        & (is_finite(F.col("amount")) | is_blank(F.col("price")))
        & F.col("ts").isNotNull()
    )


def is_rejected() -> Column:
    """The complement. Never NULL itself."""
    return ~F.coalesce(is_valid(), F.lit(False))


def rejected_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(is_rejected())


def deduplicate(rows: DataFrame) -> DataFrame:
    """One row per distinct raw text of the nine columns, with the first file name by text.

    Copies meet by the whole row, and each task first merges its own, so a row with very
    many copies costs its reducer one entry per task. A query that does not use the file name
    aggregates by hash alone.
    """
    return rows.groupBy(*RAW_COLUMNS).agg(F.min("source_file").alias("source_file"))


def silver_events(bronze: DataFrame) -> DataFrame:
    return silver_of_parsed(parse_events(bronze))


def silver_of_parsed(parsed: DataFrame) -> DataFrame:
    """Silver from parsed events. Copies meet by their raw columns alone, and what is left of them
    is parsed again, which is less work than to carry numbers and times through the shuffle."""
    return parse_events(deduplicate(parsed.where(is_valid()))).select(
        F.col("ts").alias("event_time"),
        F.col("kind").alias("event_type"),
        F.col("product").alias("product_id"),
        F.col("category").alias("category_id"),
        blank_to_null(F.col("category_code")).alias("category_code"),
        blank_to_null(F.col("brand")).alias("brand"),
        F.col("amount").alias("price"),
        F.col("user").alias("user_id"),
        blank_to_null(F.col("user_session")).alias("user_session"),
        "source_file",
        month_of(F.col("ts")).alias("event_month"),
        price_quality(F.col("amount")).alias("price_quality"),
    )
