"""How many events arrive when. The hourly counts are small; the rest rolls them up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.operators.parse import intact


def activity_cube(parsed: DataFrame) -> DataFrame:
    """Intact events by file, type and UTC hour: one pass for all counts of a profile."""
    return (
        intact(parsed)
        .groupBy(
            "source_file",
            F.col("kind").alias("event_type"),
            F.date_trunc("hour", "ts").alias("hour_utc"),
        )
        .agg(F.count(F.lit(1)).alias("events"))
    )


def cube_events_per_hour(cube: DataFrame) -> DataFrame:
    known_time = cube.where(F.col("hour_utc").isNotNull())
    return known_time.groupBy("hour_utc").agg(F.sum("events").alias("events"))


def cube_event_counts(cube: DataFrame, *keys: str) -> DataFrame:
    known_type = cube.where(F.col("event_type") != "")
    return known_type.groupBy(*keys, "event_type").agg(F.sum("events").alias("events"))


def cube_purchases_by_weekday_hour(cube: DataFrame) -> DataFrame:
    bought = cube.where((F.col("event_type") == "purchase") & F.col("hour_utc").isNotNull())
    return bought.groupBy(
        F.dayofweek("hour_utc").alias("weekday_number"), F.hour("hour_utc").alias("hour")
    ).agg(F.sum("events").alias("events"))


def events_per_hour(parsed: DataFrame) -> DataFrame:
    """Intact events with a valid time by UTC hour."""
    return (
        intact(parsed)
        .where(F.col("ts").isNotNull())
        .groupBy(F.date_trunc("hour", "ts").alias("hour_utc"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


def events_per_hour_of_day(per_hour: DataFrame) -> DataFrame:
    return per_hour.groupBy(F.hour("hour_utc").alias("hour")).agg(F.sum("events").alias("events"))


def events_per_day(per_hour: DataFrame) -> DataFrame:
    return per_hour.groupBy(F.to_date("hour_utc").alias("date_utc")).agg(
        F.sum("events").alias("events")
    )


def frequency_stats(per_hour: DataFrame) -> DataFrame:
    """Totals over observed hours only; hours without events do not count."""
    return per_hour.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("valid_timestamp_events"),
        F.count(F.lit(1)).alias("observed_utc_hours"),
        F.avg("events").alias("mean_events_per_observed_utc_hour"),
        F.coalesce(F.max("events"), F.lit(0)).alias("max_events_in_observed_utc_hour"),
    )
