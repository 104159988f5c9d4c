from clickloom.functions.columns import (
    blank_to_null,
    category_key,
    is_blank,
    is_finite,
    is_padded,
    month_of,
    price_quality,
    rate,
    to_amount,
    to_id,
    to_time,
    weekday_name,
)

__all__ = [
    "blank_to_null",
    "category_key",
    "is_blank",
    "is_finite",
    "is_padded",
    "month_of",
    "price_quality",
    "rate",
    "to_amount",
    "to_id",
    "to_time",
    "weekday_name",
]
