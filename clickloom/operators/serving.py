"""Filtered slices of the Gold tables, as a dashboard asks for them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.functions import rate
from clickloom.operators.funnel import STAGES


@dataclass(frozen=True)
class Slice:
    """What the reader picked. No months, no category or no dates mean all."""

    months: Sequence[str] = field(default_factory=tuple)
    category: str | None = None
    start: date | None = None
    end: date | None = None

    def _months(self, table: DataFrame) -> DataFrame:
        return table.where(F.col("event_month").isin(*self.months)) if self.months else table

    def _dates(self, table: DataFrame) -> DataFrame:
        day = F.col("purchase_date_utc")
        if self.start is not None:
            table = table.where(day >= F.lit(self.start))
        if self.end is not None:
            table = table.where(day <= F.lit(self.end))
        return table

    def purchases_by_time(self, table: DataFrame) -> DataFrame:
        """Purchases by hour know no category, so that choice does not apply."""
        return self._dates(self._months(table))

    def purchases_by_category_day(self, table: DataFrame) -> DataFrame:
        picked = self._dates(self._months(table))
        if self.category is None:
            return picked
        return picked.where(F.col("category_code") == self.category)

    def funnel(self, table: DataFrame) -> DataFrame:
        return self._months(table)


def filter_domains(gold: dict[str, DataFrame]) -> DataFrame:
    """What there is to pick from: months, categories, first and last purchase date."""
    by_time = gold["purchases_by_utc_time"]

    def values(table: DataFrame, domain: str, column: str) -> DataFrame:
        return table.select(F.lit(domain).alias("domain"), F.col(column).alias("value")).distinct()

    edges = [
        F.struct(F.lit(domain).alias("domain"), F.col(domain).cast("string").alias("value"))
        for domain in ("first_date", "last_date")
    ]
    dates = by_time.agg(
        F.min("purchase_date_utc").alias("first_date"), F.max("purchase_date_utc").alias("last_date")
    ).select(F.inline(F.array(*edges)))

    return (
        values(gold["funnel_by_month"], "month", "event_month")
        .unionByName(values(gold["purchases_by_category"], "category", "category_code"))
        .unionByName(dates)
        .orderBy("domain", "value")
    )


def slice_kpis(gold: dict[str, DataFrame], picked: Slice) -> DataFrame:
    """Purchase events, price sum, view sessions and view-to-purchase rate in one row."""
    sessions = picked.funnel(gold["funnel_by_month"]).agg(
        F.struct(
            F.coalesce(F.sum("view_sessions"), F.lit(0)).alias("views"),
            F.coalesce(F.sum("purchase_after_cart_sessions"), F.lit(0)).alias("purchases"),
        ).alias("sessions")
    )
    return (
        picked.purchases_by_category_day(gold["purchases_by_category_day"])
        .agg(
            F.coalesce(F.sum("purchase_event_count"), F.lit(0)).alias("purchase_events"),
            F.coalesce(F.sum("estimated_value_sum_price"), F.lit(0.0)).alias("estimated_value"),
        )
        .withColumn("sessions", sessions.scalar())
        .select(
            "purchase_events",
            "estimated_value",
            F.col("sessions.views").alias("view_sessions"),
            rate(F.col("sessions.purchases"), F.col("sessions.views")).alias(
                "view_to_purchase_rate"
            ),
        )
    )


def funnel_stages(funnel_by_month: DataFrame, picked: Slice) -> DataFrame:
    """Long form: month, stage, sessions."""
    return picked.funnel(funnel_by_month).unpivot("event_month", list(STAGES), "stage", "sessions")


def slice_purchases_by_date(by_category_day: DataFrame, picked: Slice) -> DataFrame:
    return (
        picked.purchases_by_category_day(by_category_day)
        .groupBy("purchase_date_utc")
        .agg(F.sum("purchase_event_count").alias("purchase_events"))
        .orderBy("purchase_date_utc")
    )


def slice_top_categories(by_category_day: DataFrame, picked: Slice, k: int = 15) -> DataFrame:
    return (
        picked.purchases_by_category_day(by_category_day)
        .groupBy("category_code")
        .agg(
            F.sum("purchase_event_count").alias("purchase_event_count"),
            F.coalesce(F.sum("estimated_value_sum_price"), F.lit(0.0)).alias(
                "estimated_value_sum_price"
            ),
        )
        .orderBy(F.desc("purchase_event_count"), "category_code")
        .limit(k)
    )


def conversion_grid(spark: SparkSession, by_weekday_hour: DataFrame, picked: Slice) -> DataFrame:
    """All 7 x 24 weekday hours; the rate is NULL where no session began."""
    cell = F.col("id")
    grid = spark.range(7 * 24).select(
        (F.floor(cell / 24) + 1).cast("int").alias("weekday_number"),
        (cell % 24).cast("int").alias("utc_hour"),
    )
    found = (
        picked.funnel(by_weekday_hour)
        .groupBy(F.col("spark_weekday_sunday_1").alias("weekday_number"), "utc_hour")
        .agg(
            F.sum("view_sessions").alias("view_sessions"),
            F.sum("purchase_after_cart_sessions").alias("purchase_sessions"),
        )
    )
    return (
        grid.join(found, ["weekday_number", "utc_hour"], "left")
        .fillna(0, ["view_sessions", "purchase_sessions"])
        .withColumn("conversion_rate", rate(F.col("purchase_sessions"), F.col("view_sessions")))
    )


def slice_purchases_by_hour(spark: SparkSession, by_time: DataFrame, picked: Slice) -> DataFrame:
    """All 24 hours, zero where nothing was bought."""
    hours = spark.range(24).select(F.col("id").cast("int").alias("utc_hour"))
    found = (
        picked.purchases_by_time(by_time)
        .groupBy("utc_hour")
        .agg(F.sum("purchase_event_count").alias("purchase_events"))
    )
    return hours.join(found, "utc_hour", "left").fillna(0, ["purchase_events"])
