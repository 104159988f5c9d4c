"""Report tables over the profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from clickloom.operators.quality import (
    Measures,
    event_counts,
    period_measures,
    type_measures,
)
from clickloom.schema import EVENT_TYPES, RAW_COLUMNS


def inventory_measures() -> Measures:
    rows = {"record_count": F.count(F.lit(1))}
    return {**rows, **period_measures(), **type_measures()}


def file_inventory(
    per_file: DataFrame, counts: DataFrame, sizes: DataFrame | None = None
) -> DataFrame:
    """Rows, period, events by known type, and ``events_by_type``, a map of all types, per file.

    ``per_file`` has the measures above per ``source_file``, ``counts`` the events by
    ``source_file, event_type``; ``sizes`` adds ``file_bytes``."""
    entries = F.array_sort(F.collect_list(F.struct("event_type", "events")))
    by_type = counts.groupBy("source_file").agg(F.map_from_entries(entries).alias("events_by_type"))
    none = F.create_map().cast("map<string,bigint>")
    inventory = per_file.select(
        "source_file",
        "record_count",
        F.col("period_min").alias("from_utc"),
        F.col("period_max").alias("to_utc"),
        *type_measures(),
    ).join(by_type, "source_file", "left")
    inventory = inventory.withColumn("events_by_type", F.coalesce("events_by_type", none))
    return inventory if sizes is None else inventory.join(sizes, "source_file", "left")


def file_event_matrix(parsed: DataFrame) -> DataFrame:
    """Events of each file by known type, and all others together; zero where there are none.
    What the others are, :func:`event_counts` by file tells."""
    kind = F.when(F.col("event_type").isin(*EVENT_TYPES), F.col("event_type")).otherwise("other")
    counts = event_counts(parsed, "source_file").withColumn("event_type", kind)
    return (
        counts.groupBy("source_file")
        .pivot("event_type", [*EVENT_TYPES, "other"])
        .agg(F.sum("events"))
        .fillna(0)
    )


def five_v_report(
    measures: DataFrame,
    frequency: DataFrame,
    duplicates: DataFrame,
    funnel_totals: DataFrame,
    total_bytes: int | None = None,
) -> DataFrame:
    """Volume, velocity, variety, veracity, value: (v, metric, value) rows from one-row tables."""
    measured = {"record_count": "Volume", "columns": "Variety", "missing_category_code": "Veracity"}
    measures = measures.withColumn("columns", F.lit(len(RAW_COLUMNS)))
    if total_bytes is not None:
        measures = measures.withColumn("gib", F.lit(total_bytes / 1024**3))
        measured["gib"] = "Volume"
    parts = (
        (measures, measured),
        (
            frequency,
            {"observed_utc_hours": "Velocity", "mean_events_per_observed_utc_hour": "Velocity"},
        ),
        (duplicates, {"duplicate_excess_rows": "Veracity"}),
        (funnel_totals, {"view_to_purchase_rate": "Value"}),
    )

    def rows(table: DataFrame, metrics: dict[str, str]) -> DataFrame:
        lines = [
            F.struct(
                F.lit(v).alias("v"),
                F.lit(name).alias("metric"),
                F.col(name).cast("double").alias("value"),
            )
            for name, v in metrics.items()
        ]
        return table.select(F.inline(F.array(*lines)))

    return reduce(DataFrame.unionByName, [rows(*part) for part in parts])


def top_categories(top: DataFrame, k: int = 10) -> DataFrame:
    return top.orderBy(F.desc("purchase_event_count"), "category_code").limit(k)

