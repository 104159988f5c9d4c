"""Column builders. All of them are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from clickloom.schema import NO_CATEGORY, TIME_FORMAT, WEEKDAY_NAMES_ES


def is_blank(text: Column) -> Column:
    """NULL, empty or only spaces. Never NULL itself."""
    return F.coalesce(F.trim(text) == "", F.lit(True))


def is_padded(text: Column) -> Column:
    """Has a value with spaces around it. Never NULL itself."""
    return F.coalesce((text != F.trim(text)) & (F.trim(text) != ""), F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def to_time(text: Column) -> Column:
    return F.try_to_timestamp(F.trim(text), F.lit(TIME_FORMAT))


def to_id(text: Column) -> Column:
    return F.trim(text).try_cast("bigint")


def to_amount(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def is_finite(number: Column) -> Column:
    """A real number: not NULL, infinite or NaN, which Spark sorts above infinity. Never NULL."""
    return F.coalesce(F.abs(number) < float("inf"), F.lit(False))


def price_quality(price: Column) -> Column:
    return (
        F.when(price.isNull(), "missing").when(price <= 0, "nonpositive").otherwise("positive")
    )


def category_key(category: Column, label: str = NO_CATEGORY) -> Column:
    return F.coalesce(blank_to_null(category), F.lit(label))


def month_of(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


def rate(part: Column, whole: Column) -> Column:
    """``part / whole``, NULL where there is nothing to divide by."""
    return F.try_divide(part, whole)


def weekday_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in WEEKDAY_NAMES_ES]), day)
