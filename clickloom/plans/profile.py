"""Job: profile raw events. Tables go to the lake, one JSON overview beside them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators import frequency, funnel, prices, purchases, quality, reports
from clickloom.operators.duplicates import duplicate_summary
from clickloom.operators.parse import column_catalogue, parse_events, profile_session_events
from clickloom.schema import EVENT_TYPES, RAW_COLUMNS
from clickloom.session import use_utc
from clickloom.sources.events_csv import check_inputs, input_files, staged_events
from clickloom.sources.lake import guard_raw, write_summary, write_table


def profile_tables(
    parsed: DataFrame, output: str, sizes: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Write the profile of parsed events below ``output`` and return its tables.

    Each pass over the rows ends in a small written table; what can be rolled up from it is,
    so that no other pass is needed.
    """
    tables: dict[str, DataFrame] = {}

    def keep(name: str, table: DataFrame) -> DataFrame:
        tables[name] = write_table(table, f"{output}/{name}")
        return tables[name]

    per_file = keep(
        "quality_by_file",
        quality.quality(
            parsed,
            "source_file",
            measures={**quality.all_measures(), **quality.type_measures()},
        ),
    )
    keep("quality", quality.combine_quality(per_file))
    keep("file_overview", per_file.select("source_file", *quality.file_measures()))
    cube = keep("activity", frequency.activity_cube(parsed))
    by_file = keep("event_counts_by_file", frequency.cube_event_counts(cube, "source_file"))
    keep("file_inventory", reports.file_inventory(per_file, by_file, sizes))
    keep("event_counts", frequency.cube_event_counts(cube))
    per_hour = keep("events_per_hour", frequency.cube_events_per_hour(cube))
    keep("events_per_hour_of_day", frequency.events_per_hour_of_day(per_hour))
    keep("events_per_day", frequency.events_per_day(per_hour))
    keep("frequency", frequency.frequency_stats(per_hour))

    sessions = funnel.funnel_sessions(profile_session_events(parsed))
    grid = keep("funnel_by_weekday_hour", funnel.funnel_by_utc_weekday_hour(sessions))
    keep("funnel", funnel.funnel_totals(grid))
    keep("funnel_by_hour", funnel.funnel_by_hour(grid))
    keep("funnel_by_weekday", funnel.funnel_by_weekday(grid))

    keep("duplicates", duplicate_summary(parsed))

    amounts = prices.valid_prices(parsed)
    sketches = keep("price_sketches", prices.price_sketches(parsed, "source_file"))
    quartiles = keep("price_quartiles", prices.sketch_quantiles(sketches))
    keep("prices", prices.price_summary(amounts, quartiles))

    keep("top_categories", purchases.top_purchase_categories(parsed))
    bought = keep("purchases_by_weekday_hour", frequency.cube_purchases_by_weekday_hour(cube))
    keep("purchases_by_hour", purchases.purchases_by_hour(bought))
    keep("purchases_by_weekday", purchases.purchases_by_weekday(bought))
    return tables


def _iso(time: datetime | None) -> str | None:
    """Rows hold local naive times; summaries hold UTC."""
    return None if time is None else time.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _one(table: DataFrame) -> dict:
    return table.first().asDict()


def _few(table: DataFrame, *order: str) -> list[dict]:
    """Rows of a table with a fixed small size: hours of a day, weekdays or a top list."""
    return [row.asDict() for row in table.orderBy(*order).collect()]


def overview(tables: dict[str, DataFrame]) -> dict:
    """The one-row results and short lists of a profile as one document. Lists that grow
    with the data (files, days, hours, event types) stay in the tables."""
    q = _one(tables["quality"])
    price = _one(tables["prices"])
    rows, with_session = q["record_count"], q["rows_with_session"]
    is_known = F.col("event_type").isin(*EVENT_TYPES)
    known = tables["event_counts"].where(is_known)
    return {
        "record_count": rows,
        "columns": [row.asDict() for row in column_catalogue(tables["quality"].sparkSession).collect()],
        "expected_event_types": list(EVENT_TYPES),
        "event_counts": {row["event_type"]: row["events"] for row in known.collect()},
        "unexpected_event_count": q["unexpected_events"],
        "unexpected_event_types": tables["event_counts"].where(~is_known).count(),
        "period_utc": {"min": _iso(q["period_min"]), "max": _iso(q["period_max"])},
        "invalid_timestamp_count": q["invalid_timestamps"],
        "corrupt_record_count": q["corrupt_records"],
        "null_counts": {name: q[f"missing_{name}"] for name in RAW_COLUMNS},
        "whitespace_inconsistency_counts": {name: q[f"whitespace_{name}"] for name in RAW_COLUMNS},
        "invalid_numeric_counts": {
            name: q[f"invalid_{name}"] for name in ("product_id", "category_id", "user_id", "price")
        },
        "nonpositive_id_counts": {
            name: q[f"nonpositive_{name}"] for name in ("product_id", "category_id", "user_id")
        },
        **_one(tables["duplicates"]),
        "session_row_coverage": {
            "rows_with_nonblank_user_session": with_session,
            "fraction_of_all_rows": with_session / rows if rows else None,
        },
        "price": {
            **{name: value for name, value in price.items() if value is not None},
            "invalid_count": q["invalid_price"],
            "nonpositive_count": q["nonpositive_price"],
            "quantile_relative_error": 0.01,
            "outliers_removed": False,
        },
        "frequency": {
            **_one(tables["frequency"]),
            "by_hour_of_day_utc": _few(tables["events_per_hour_of_day"], "hour"),
        },
        "funnel": {
            **_one(tables["funnel"]),
            "by_utc_hour_of_first_view": _few(tables["funnel_by_hour"], "utc_hour"),
            "by_spark_weekday_sunday_1": _few(tables["funnel_by_weekday"], "weekday_number"),
        },
        "purchases": {
            "purchase_event_count": q["purchase_events"],
            "estimated_value_sum_price": q["purchase_price_sum"],
            "top_categories": [
                row.asDict() for row in reports.top_categories(tables["top_categories"], 20).collect()
            ],
            "purchase_events_by_utc_hour_of_day": _few(
                tables["purchases_by_hour"], "hour"
            ),
            "purchase_events_by_spark_weekday_sunday_1": _few(
                tables["purchases_by_weekday"], "weekday_number"
            ),
        },
    }


def profile(spark: SparkSession, paths: Sequence[str], output: str) -> dict:
    """Profile CSV files: tables below ``output``, the document in ``output/overview``."""
    use_utc(spark)
    guard_raw(output)
    check_inputs(spark, paths)
    sizes = input_files(spark, paths)
    with staged_events(spark, paths, parse_events) as parsed:
        tables = profile_tables(parsed, output, sizes)
    document = {
        "generated_at_utc": datetime.now(timezone.utc).isoformat(),
        "engine": {"name": "PySpark", "version": spark.version},
        "timezone": "UTC",
        # Lists that grow with the data are tables: input files, hours, days, all event types.
        "tables": {name: f"{output}/{name}" for name in tables},
        "combined": {
            "file_bytes": sizes.agg(F.sum("file_bytes")).first()[0],
            **overview(tables),
        },
    }
    write_summary(spark, document, f"{output}/overview")
    return document
