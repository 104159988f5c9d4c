"""Data-quality counts: any selection of them is one aggregation over one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import is_blank, is_finite, is_padded, rate
from clickloom.operators.parse import intact
from clickloom.operators.silver import is_rejected
from clickloom.schema import CORRUPT, EVENT_TYPES, RAW_COLUMNS

_IDS = {"product_id": "product", "category_id": "category", "user_id": "user"}


def _unreadable(raw: str, typed: str) -> Column:
    return ~is_blank(F.col(raw)) & F.col(typed).isNull()


Measures = dict[str, Column]


def missing_measures() -> Measures:
    return {f"missing_{name}": F.count_if(is_blank(F.col(name))) for name in RAW_COLUMNS}


def whitespace_measures() -> Measures:
    return {f"whitespace_{name}": F.count_if(is_padded(F.col(name))) for name in RAW_COLUMNS}


def validity_measures() -> Measures:
    """Defects over all rows; valid prices and purchases over intact rows."""
    kind, amount = F.col("kind"), F.col("amount")
    whole, finite = F.col(CORRUPT).isNull(), is_finite(amount)
    purchase = whole & (kind == "purchase")
    return {
        "record_count": F.count(F.lit(1)),
        "corrupt_records": F.count_if(~whole),
        "invalid_timestamps": F.count_if(_unreadable("event_time", "ts")),
        "unexpected_events": F.count_if(
            ~is_blank(F.col("event_type")) & ~kind.isin(*EVENT_TYPES)
        ),
        **{f"invalid_{raw}": F.count_if(_unreadable(raw, typed)) for raw, typed in _IDS.items()},
        "invalid_price": F.count_if(~is_blank(F.col("price")) & ~finite),
        "valid_price_count": F.count_if(whole & finite),
        "purchase_events": F.count_if(purchase),
        "purchase_price_sum": F.sum(F.when(purchase & finite, amount)),
    }


def nonpositive_measures() -> Measures:
    amount = F.col("amount")
    return {
        **{f"nonpositive_{raw}": F.count_if(F.col(typed) <= 0) for raw, typed in _IDS.items()},
        "nonpositive_price": F.count_if(is_finite(amount) & (amount <= 0)),
    }


def session_measures() -> Measures:
    return {
        "record_count": F.count(F.lit(1)),
        "rows_with_session": F.count_if(~is_blank(F.col("user_session"))),
    }


def period_measures() -> Measures:
    """First and last time among intact rows."""
    time = F.when(F.col(CORRUPT).isNull(), F.col("ts"))
    return {"period_min": F.min(time), "period_max": F.max(time)}


def type_measures() -> Measures:
    """Intact rows by known event type, and those of any other type."""
    whole, kind = F.col(CORRUPT).isNull(), F.col("kind")
    known = {f"{name}_events": F.count_if(whole & (kind == name)) for name in EVENT_TYPES}
    return {**known, "other_events": F.count_if(whole & (kind != "") & ~kind.isin(*EVENT_TYPES))}


def file_measures() -> Measures:
    """What the overview of a file shows."""
    defects = validity_measures()
    shown = ("record_count", "corrupt_records", "invalid_timestamps")
    return {**{name: defects[name] for name in shown}, **period_measures(), **missing_measures()}


def all_measures() -> Measures:
    return {
        **missing_measures(),
        **whitespace_measures(),
        **validity_measures(),
        **nonpositive_measures(),
        **session_measures(),
        **period_measures(),
    }


def quality(parsed: DataFrame, *keys: str, measures: Measures | None = None) -> DataFrame:
    """Measures, all if not chosen, for the whole input or per key (as ``source_file``)."""
    chosen = all_measures() if measures is None else measures
    return parsed.groupBy(*keys).agg(*[value.alias(name) for name, value in chosen.items()])


def combine_quality(per_file: DataFrame) -> DataFrame:
    """The measures of the whole input, from those per ``source_file``. Counts of no files are
    zero, other measures NULL."""
    special = {"period_min": F.min, "period_max": F.max, "purchase_price_sum": F.sum}
    return per_file.agg(
        *[
            special[name](name).alias(name)
            if name in special
            else F.coalesce(F.sum(name), F.lit(0)).alias(name)
            for name in per_file.columns
            if name != "source_file"
        ]
    )


def session_coverage(measures: DataFrame) -> DataFrame:
    return measures.select(
        "rows_with_session",
        rate(F.col("rows_with_session"), F.col("record_count")).alias("session_fraction"),
    )


def event_counts(parsed: DataFrame, *keys: str) -> DataFrame:
    """Intact rows by event type, unknown types included."""
    return (
        intact(parsed)
        .where(~is_blank(F.col("event_type")))
        .groupBy(*keys, F.col("kind").alias("event_type"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


def file_overview(parsed: DataFrame) -> DataFrame:
    """Rows, period, defects and missing counts per file."""
    return quality(parsed, "source_file", measures=file_measures())


def silver_audit(parsed: DataFrame) -> DataFrame:
    """Counts behind the typed table. Unlike the profile, a missing time or type is bad here."""
    ts, kind, amount = F.col("ts"), F.col("kind"), F.col("amount")
    rejected = F.count_if(is_rejected())
    return parsed.agg(
        F.count(F.lit(1)).alias("source_rows"),
        rejected.alias("rejected_rows"),
        (F.count(F.lit(1)) - rejected).alias("valid_rows_before_dedup"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt_rows"),
        F.count_if(ts.isNull()).alias("invalid_timestamp_rows"),
        F.count_if(is_blank(F.col("event_type")) | ~kind.isin(*EVENT_TYPES)).alias(
            "unexpected_event_type_rows"
        ),
        F.count_if(~is_blank(F.col("price")) & ~is_finite(amount)).alias("invalid_price_rows"),
        F.count_if(is_finite(amount) & (amount <= 0)).alias("nonpositive_price_rows"),
        *[
            F.count_if(is_blank(F.col(name))).alias(f"missing_{name}_rows")
            for name in ("category_code", "brand", "user_session")
        ],
        *[
            F.count_if(_unreadable(raw, typed)).alias(f"invalid_{raw}_rows")
            for raw, typed in _IDS.items()
        ],
    )
