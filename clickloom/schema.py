"""Schemas and fixed values of the clickstream data model."""

from __future__ import annotations

# --- fixed values ----------------------------------------------------------
# Raw columns, in file order. All are read as text, so that bad values can be counted.
RAW_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)
CORRUPT = "_corrupt_record"
EVENT_TYPES = ("view", "cart", "remove_from_cart", "purchase")
FUNNEL_TYPES = ("view", "cart", "purchase")
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"
NO_CATEGORY = "[sin categoría]"
# Names by Spark's day of week (Sunday = 1).
WEEKDAY_NAMES_ES = ("domingo", "lunes", "martes", "miércoles", "jueves", "viernes", "sábado")
SEMANTIC_TYPES = {
    "event_time": "timestamp (UTC)",
    "event_type": "categorical string",
    "product_id": "nullable 64-bit integer",
    "category_id": "nullable 64-bit integer",
    "category_code": "nullable hierarchical string",
    "brand": "nullable string",
    "price": "nullable numeric value",
    "user_id": "nullable 64-bit integer",
    "user_session": "nullable session identifier string",
}
FEATURES = (
    "log_views_5m",
    "log_carts_5m",
    "log_removals_5m",
    "log_unique_products_5m",
    "log_unique_categories_5m",
    "mean_view_price_5m",
    "hour_sin",
    "hour_cos",
    "weekday_sin",
    "weekday_cos",
)
# ---------------------------------------------------------------------------

RAW_SCHEMA = ", ".join(f"{name} string" for name in (*RAW_COLUMNS, CORRUPT))
BRONZE_COLUMNS = (*RAW_COLUMNS, CORRUPT, "source_file")
# Gold tables, and what their rows are sorted by within a month; those without month are one table.
GOLD_ORDER = {
    "funnel_by_month": (),
    "funnel_by_utc_weekday_hour": ("spark_weekday_sunday_1", "utc_hour"),
    "purchases_by_category_day": ("category_code", "purchase_date_utc"),
    "purchases_by_utc_time": ("purchase_date_utc", "utc_hour"),
}
GOLD_TABLES = (
    "funnel_by_month",
    "funnel_by_utc_weekday_hour",
    "purchases_by_category",
    "purchases_by_category_day",
    "purchases_by_utc_time",
)
