"""Session examples for the purchase model: features before a cutoff, label from after it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import is_blank, month_of
from clickloom.schema import FEATURES


def sample_sessions(silver: DataFrame, percent: int) -> DataFrame:
    """Whole sessions, chosen by a hash of their id: the same ones on every run."""
    if not 1 <= percent <= 100:
        raise ValueError("percent has to be from 1 to 100")
    return silver.where(~is_blank(F.col("user_session")) & in_sample(percent))


def in_sample(percent: int) -> Column:
    """By 32 bits of the id's md5, which any engine works out alike."""
    bits = F.conv(F.substring(F.md5("user_session"), 1, 8), 16, 10).cast("bigint")
    return bits % 100 < percent


def session_eligibility(
    events: DataFrame, period_start: Column, period_end: Column, minutes: int = 5
) -> DataFrame:
    """Sessions that can be examples: not cut off by the period or by a month's end, and
    without a purchase before the cutoff. The label says whether one follows."""
    if minutes <= 0:
        raise ValueError("minutes has to be positive")
    wait = F.make_dt_interval(mins=F.lit(minutes))
    start, cutoff, bought = (
        F.col(name) for name in ("session_start", "cutoff_time", "first_purchase_time")
    )
    at = F.col("event_time")
    return (
        events.where(~is_blank(F.col("user_session")) & at.isNotNull())
        .groupBy("user_session")
        .agg(
            F.min(at).alias("session_start"),
            F.min(F.when(F.col("event_type") == "purchase", at)).alias("first_purchase_time"),
        )
        .withColumns({"cutoff_time": start + wait, "event_month": month_of(start), "label": _label()})
        .where(
            (start >= period_start + wait)
            & (start <= period_end - wait)
            & (month_of(cutoff) == F.col("event_month"))
            & (bought.isNull() | (bought >= cutoff))
        )
    )


def _label() -> Column:
    return F.when(F.col("first_purchase_time").isNull(), 0.0).otherwise(1.0)


def session_examples(
    events: DataFrame, period_start: Column, period_end: Column, minutes: int = 5
) -> DataFrame:
    """One example per eligible session, with features from events before its cutoff.

    A session may hold a large share of all events, so events meet their session by session
    and time slice. With slices as long as the cutoff, the two from the session's start on
    cover all that counts; the other events of a long session spread over other tasks and
    find no partner. The event that starts a session always finds it, so no eligible session
    is lost to the inner join, and counts that find nothing are zero.
    """
    sessions = session_eligibility(events, period_start, period_end, minutes)
    width = 60 * minutes

    def slice_of(time: Column) -> Column:
        seconds = F.unix_seconds(time)
        return seconds - F.pmod(seconds, F.lit(width))

    first = slice_of(F.col("session_start"))
    awaited = sessions.select(
        "user_session",
        "session_start",
        "cutoff_time",
        "first_purchase_time",
        F.explode(F.array(first, first + width)).alias("slice"),
    )
    activity = events.where(~F.col("event_type").eqNullSafe("purchase")).select(
        "user_session",
        slice_of(F.col("event_time")).alias("slice"),
        "event_time",
        "event_type",
        "product_id",
        "category_code",
        F.when(F.col("price_quality") == "positive", F.col("price")).alias("price"),
    )
    view = F.col("event_type") == "view"
    measured = (
        activity.join(awaited, ["user_session", "slice"])
        .where(F.col("event_time") < F.col("cutoff_time"))
        .groupBy("user_session")
        .agg(
            F.min("session_start").alias("session_start"),
            F.min("first_purchase_time").alias("first_purchase_time"),
            F.count_if(view).alias("views"),
            F.count_if(F.col("event_type") == "cart").alias("carts"),
            F.count_if(F.col("event_type") == "remove_from_cart").alias("removals"),
            F.count_distinct(F.when(view, F.col("product_id"))).alias("products"),
            F.count_distinct(F.when(view, F.col("category_code"))).alias("categories"),
            F.avg(F.when(view, F.col("price"))).alias("view_price"),
        )
    )
    return with_features(measured)


def with_features(measured: DataFrame) -> DataFrame:
    """Scale the counts and put the start time on two circles."""
    hour_angle = F.hour("session_start") * (2 * math.pi / 24)
    weekday_angle = (F.dayofweek("session_start") - 1) * (2 * math.pi / 7)
    features = (
        F.log1p("views"),
        F.log1p("carts"),
        F.log1p("removals"),
        F.log1p("products"),
        F.log1p("categories"),
        F.coalesce("view_price", F.lit(0.0)),
        F.sin(hour_angle),
        F.cos(hour_angle),
        F.sin(weekday_angle),
        F.cos(weekday_angle),
    )
    return measured.select(
        "user_session",
        month_of(F.col("session_start")).alias("event_month"),
        "session_start",
        "first_purchase_time",
        _label().alias("label"),
        *[value.alias(name) for name, value in zip(FEATURES, features)],
    )
