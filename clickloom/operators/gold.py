"""The five Gold tables, from two aggregations of Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom.operators import funnel, purchases
from clickloom.operators.parse import session_events


def funnel_base(silver: DataFrame) -> DataFrame:
    return funnel.funnel_by_utc_weekday_hour(funnel.funnel_sessions(session_events(silver)))


def gold_tables(by_weekday_hour: DataFrame, cube: DataFrame) -> dict[str, DataFrame]:
    """``by_weekday_hour`` is a Gold table itself; the others roll up it and the cube."""
    return {
        "funnel_by_month": funnel.funnel_by_month(by_weekday_hour),
        "funnel_by_utc_weekday_hour": by_weekday_hour,
        "purchases_by_category": purchases.purchases_by_category(cube),
        "purchases_by_category_day": purchases.purchases_by_category_day(cube),
        "purchases_by_utc_time": purchases.purchases_by_utc_time(cube),
    }


def gold_metrics(silver: DataFrame) -> dict[str, DataFrame]:
    """All five straight from Silver, lazily."""
    return gold_tables(funnel_base(silver), purchases.purchase_cube(silver))
