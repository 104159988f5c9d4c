"""Sequential session funnel: first view, first cart from then on, first purchase from then on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import month_of, rate, weekday_name

STAGES = ("view_sessions", "cart_after_view_sessions", "purchase_after_cart_sessions")


def _days(since: str) -> Column:
    """The days on which a session's next stage may come."""
    return F.explode(F.sequence(F.to_date(since), F.to_date("last"))).alias("day")


def _next_stage(events: DataFrame, kind: str, reached: DataFrame, since: str, name: str) -> DataFrame:
    """The first event of a kind from the moment of the stage before on, per session.

    Events meet their session by session and day, so one of very many events spreads over the days
    of its life; and as minima per session need a shuffle after that anyway, adaptive skew handling
    may also split what one day holds. Only minima leave a task.
    """
    at = F.col("event_time")
    awaited = reached.select("user_session", since, "last", _days(since))
    return (
        events.where(F.col("event_type") == kind)
        .withColumn("day", F.to_date(at))
        .join(awaited, ["user_session", "day"])
        .where(at >= F.col(since))
        .groupBy("user_session")
        .agg(F.min(at).alias(name), F.max("last").alias("last"))
    )


def funnel_sessions(events: DataFrame) -> DataFrame:
    """One row per session that has a view, from ``user_session, event_time, event_type``.

    A chain of minima: the first view of each session, the first cart from then on, the first
    purchase from then on. Tasks merge their own rows before each shuffle, and no session is
    gathered.
    """
    kind, at = F.col("event_type"), F.col("event_time")
    viewed = (
        events.groupBy("user_session")
        .agg(F.min(F.when(kind == "view", at)).alias("view_time"), F.max(at).alias("last"))
        .where(F.col("view_time").isNotNull())
    )
    carted = _next_stage(events, "cart", viewed, "view_time", "cart_time")
    bought = _next_stage(events, "purchase", carted, "cart_time", "purchase_time")
    return (
        viewed.drop("last")
        .join(carted.drop("last"), "user_session", "left")
        .join(bought.drop("last"), "user_session", "left")
        .withColumn("event_month", month_of(F.col("view_time")))
    )


def _with_rates(counts: DataFrame) -> DataFrame:
    views, carts, purchases = (F.col(stage) for stage in STAGES)
    return counts.withColumns(
        {
            "view_to_cart_rate": rate(carts, views),
            "view_to_purchase_rate": rate(purchases, views),
            "cart_to_purchase_rate": rate(purchases, carts),
        }
    )


def funnel_by(sessions: DataFrame, *dimensions: Column | str) -> DataFrame:
    """Sessions that reached each stage, and the rates between stages."""
    times = ("view_time", "cart_time", "purchase_time")
    counts = [F.count(time).alias(stage) for time, stage in zip(times, STAGES)]
    return _with_rates(sessions.groupBy(*dimensions).agg(*counts))


def roll_up_funnel(counts: DataFrame, *dimensions: Column | str) -> DataFrame:
    """Coarser counts from finer ones. Counts add up, rates are worked out anew."""
    return _with_rates(
        counts.groupBy(*dimensions).agg(
            *[F.coalesce(F.sum(stage), F.lit(0)).alias(stage) for stage in STAGES]
        )
    )


def funnel_by_utc_weekday_hour(sessions: DataFrame) -> DataFrame:
    return funnel_by(
        sessions,
        "event_month",
        F.dayofweek("view_time").alias("spark_weekday_sunday_1"),
        F.hour("view_time").alias("utc_hour"),
    )


def funnel_by_month(by_weekday_hour: DataFrame) -> DataFrame:
    return roll_up_funnel(by_weekday_hour, "event_month")


def funnel_totals(by_weekday_hour: DataFrame) -> DataFrame:
    return roll_up_funnel(by_weekday_hour)


def _brief(counts: DataFrame, *dimensions: str) -> DataFrame:
    return counts.select(
        *dimensions,
        "view_sessions",
        F.col("cart_after_view_sessions").alias("cart_sessions"),
        F.col("purchase_after_cart_sessions").alias("purchase_sessions"),
        "view_to_purchase_rate",
    )


def funnel_by_hour(by_weekday_hour: DataFrame) -> DataFrame:
    return _brief(roll_up_funnel(by_weekday_hour, "utc_hour"), "utc_hour")


def funnel_by_weekday(by_weekday_hour: DataFrame) -> DataFrame:
    day = F.col("spark_weekday_sunday_1")
    named = roll_up_funnel(by_weekday_hour, day.alias("weekday_number")).withColumn(
        "weekday_name_es", weekday_name(F.col("weekday_number"))
    )
    return _brief(named, "weekday_number", "weekday_name_es")
