"""Purchase counts and price sums. A price sum is an estimate per event, not revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.functions import category_key, is_finite, weekday_name
from clickloom.operators.parse import intact
from clickloom.schema import NO_CATEGORY


# --- profile, from parsed raw events ---------------------------------------
def profile_purchases(parsed: DataFrame) -> DataFrame:
    return intact(parsed).where(F.col("kind") == "purchase")


def top_purchase_categories(parsed: DataFrame, k: int = 20, label: str = NO_CATEGORY) -> DataFrame:
    """The k categories with most purchase events; ties go by name."""
    amount = F.col("amount")
    return (
        profile_purchases(parsed)
        .groupBy(category_key(F.col("category_code"), label).alias("category_code"))
        .agg(
            F.count(F.lit(1)).alias("purchase_event_count"),
            F.sum(F.when(is_finite(amount), amount)).alias("estimated_value_sum_price"),
            F.count_if(~is_finite(amount)).alias("purchase_events_without_valid_price"),
        )
        .orderBy(F.desc("purchase_event_count"), "category_code")
        .limit(k)
    )


def purchases_by_weekday_hour(parsed: DataFrame) -> DataFrame:
    return (
        profile_purchases(parsed)
        .where(F.col("ts").isNotNull())
        .groupBy(F.dayofweek("ts").alias("weekday_number"), F.hour("ts").alias("hour"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


def purchases_by_hour(by_weekday_hour: DataFrame) -> DataFrame:
    return by_weekday_hour.groupBy("hour").agg(F.sum("events").alias("events"))


def purchases_by_weekday(by_weekday_hour: DataFrame) -> DataFrame:
    return (
        by_weekday_hour.groupBy("weekday_number")
        .agg(F.sum("events").alias("events"))
        .withColumn("weekday_name_es", weekday_name(F.col("weekday_number")))
    )


# --- Gold, from Silver -----------------------------------------------------
def purchase_cube(silver: DataFrame, label: str = NO_CATEGORY) -> DataFrame:
    """Purchases by month, date, hour and category: the one pass behind the Gold tables."""
    return (
        silver.where(F.col("event_type") == "purchase")
        .groupBy(
            "event_month",
            F.to_date("event_time").alias("purchase_date_utc"),
            F.hour("event_time").alias("utc_hour"),
            category_key(F.col("category_code"), label).alias("category_code"),
        )
        .agg(
            F.count(F.lit(1)).alias("purchase_event_count"),
            F.sum("price").alias("estimated_value_sum_price"),
            F.count_if(F.col("price_quality") == "nonpositive").alias("nonpositive_price_events"),
        )
    )


def _roll_up(cube: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return cube.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures])


_COUNT_AND_VALUE = ["purchase_event_count", "estimated_value_sum_price"]
_ALL_MEASURES = [*_COUNT_AND_VALUE, "nonpositive_price_events"]


def purchases_by_category_day(cube: DataFrame) -> DataFrame:
    return _roll_up(cube, ["event_month", "purchase_date_utc", "category_code"], _ALL_MEASURES)


def purchases_by_category(cube: DataFrame) -> DataFrame:
    return _roll_up(cube, ["category_code"], _ALL_MEASURES)


def purchases_by_utc_time(cube: DataFrame) -> DataFrame:
    return _roll_up(cube, ["event_month", "purchase_date_utc", "utc_hour"], _COUNT_AND_VALUE)
